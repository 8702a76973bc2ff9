from pyspark.sql import functions as F

from helpers import postings
from vacantia.plans.marts import weekly_trend
from vacantia.schema import POSTING_SCHEMA
from vacantia.streaming import landing


def dated(spark, *pairs):
    df = postings(spark, [dict(offre_id=i, source="s", rome_libelle="m", salaire_min=n) for n, (i, _) in enumerate(pairs)])
    days = spark.createDataFrame([(n, d) for n, (_, d) in enumerate(pairs)], "salaire_min INT, d STRING")
    return df.drop("date_creation").join(days, "salaire_min").withColumn("date_creation", F.to_timestamp("d")).select(*POSTING_SCHEMA.names)


def test_landing_twice_adds_new_ids_only(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    dated(spark, ("1", "2024-01-01"), ("1", "2024-01-02"), ("2", "2024-01-01")).write.parquet(source)
    for _ in range(2):
        landing.land_new_postings(landing.stream_table(spark, source, POSTING_SCHEMA), target, state).awaitTermination(120)
    assert sorted((r.offre_id, r.date_creation.day) for r in spark.read.parquet(target).collect()) == [("1", 2), ("2", 1)]
    dated(spark, ("2", "2024-01-05"), ("3", "2024-01-05")).write.mode("append").parquet(source)
    landing.land_new_postings(landing.stream_table(spark, source, POSTING_SCHEMA), target, state).awaitTermination(120)
    # A lost checkpoint means every file is read again; the table still holds each id once.
    landing.land_new_postings(landing.stream_table(spark, source, POSTING_SCHEMA), target, state + "2").awaitTermination(120)
    assert sorted(r.offre_id for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]


def test_weeks_start_on_monday_as_in_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = dated(spark, ("1", "2024-01-07 23:59:59"), ("2", "2024-01-08"), ("3", "2024-01-14"), ("4", "2024-01-15"))
    rows.write.parquet(path)
    trend = landing.weekly_trend_stream(landing.stream_table(spark, path, POSTING_SCHEMA))
    query = trend.writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = sorted((r.semaine, r.nb_offres) for r in spark.sql("SELECT CAST(semaine AS TIMESTAMP_NTZ) AS semaine, nb_offres FROM weeks").collect())
    batch = weekly_trend(rows.withColumn("salaire_predit_eur", F.lit(None).cast("double")), F.to_date(F.lit("2024-02-01")))
    assert got == sorted((r.semaine, r.nb_offres) for r in batch.collect()) and len(got) == 3
