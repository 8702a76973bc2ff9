"""Null rates and field profiles in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from vacantia.functions.measures import count_null, percent


def null_rates(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Per column: number and percentage of NULLs. ``columns`` may map the shown name to the tested column.

    All columns are counted in one aggregate, then turned into rows.
    """
    tested = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    counted = df.agg(F.count("*").alias("_n"),
                     *[count_null(F.col(c)).alias(f"_{i}") for i, c in enumerate(tested.values())])
    lines = F.array(*[F.struct(F.lit(name).alias("colonne"), F.col(f"_{i}").alias("nb_nulls"))
                      for i, name in enumerate(tested)])
    return counted.select("_n", F.explode(lines).alias("l")).select(
        "l.colonne", "l.nb_nulls", percent(F.col("l.nb_nulls"), F.col("_n")).alias("pct_nulls"))


def quality_report(df: DataFrame, columns: Sequence[str], threshold: float = 10.0) -> DataFrame:
    """Null rates with a verdict: fine below the threshold. An empty table counts as 0 percent."""
    rate = F.coalesce("pct_nulls", F.lit(0.0))
    return null_rates(df, columns).select("colonne", "nb_nulls", rate.alias("pct_nulls"),
                                          (rate < threshold).alias("ok"))


def field_profile(df: DataFrame, json_column: str) -> DataFrame:
    """Fields of raw JSON records over the whole table: name, merged type, records with it, fill rate.

    ``nb_lignes`` counts records that are objects; text that is not JSON is left out.
    """
    objects = df.filter(F.col(json_column).rlike(r"^\s*\{"))
    parsed = objects.select(F.try_parse_json(json_column).alias("v")).filter("v IS NOT NULL")
    total = parsed.agg(F.count("*").alias("n")).scalar()
    spark = df.sparkSession
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    present = ~F.is_variant_null(F.col("value"))
    return fields.groupBy(F.col("key").alias("champ")).agg(
        F.count("*").alias("nb_lignes"), F.count_if(present).alias("nb_remplis"),
        F.schema_of_variant_agg("value").alias("type"),
    ).withColumn("pct_remplis", percent(F.col("nb_remplis"), total))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once. No rows for a table that is unique by the key."""
    return df.groupBy(key).agg(F.count("*").alias("nb")).filter("nb > 1")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One line per table with its number of rows."""
    out: DataFrame | None = None
    for name, df in tables.items():
        line = df.agg(F.count("*").alias("nb_lignes")).select(F.lit(name).alias("table_name"), "nb_lignes")
        out = line if out is None else out.unionByName(line)
    if out is None:
        raise ValueError("no tables to count")
    return out
