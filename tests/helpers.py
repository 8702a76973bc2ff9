"""What several tests use."""

from vacantia.schema import POSTING_COLUMNS, POSTING_SCHEMA


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def postings(spark, rows):
    """Postings from dictionaries; the rest is NULL."""
    base = dict.fromkeys(POSTING_COLUMNS)
    return spark.createDataFrame([{**base, "offre_id": str(i), "titre": "Titre", **r} for i, r in enumerate(rows)], POSTING_SCHEMA)
