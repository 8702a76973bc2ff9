"""Structured Streaming forms of two batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vacantia.functions.measures import rounded_mean
from vacantia.operators.merge import new_rows
from vacantia.sources.tables import publish, try_read


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


PART = "_part"


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The postings of a landing table."""
    return spark.read.parquet(target).drop(PART)


def land_new_postings(postings: DataFrame, target: str, checkpoint: str, key: str = "offre_id", parts: int = 256) -> StreamingQuery:
    """Append postings with unseen ids to a table, for all files present, then stop.

    The table is partitioned by a hash of the id, and a batch looks for its ids only in the ``parts`` it falls into.
    A batch that is run again after a failure finds its ids in the table and adds nothing.
    """
    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        dealt = batch.withColumn(PART, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        known = try_read(spark, target)
        if known is None:
            known = dealt.limit(0)
        else:  # at most ``parts`` numbers
            known = known.filter(F.col(PART).isin([r[0] for r in dealt.select(PART).distinct().collect()]))
        fresh = new_rows(known, dealt, key, (F.col("date_creation").desc_nulls_last(),))
        fresh.write.mode("append").partitionBy(PART).parquet(target)

    return (postings.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def weekly_trend_stream(postings: DataFrame, late: str = "14 days") -> DataFrame:
    """Postings and mean salaries per week (from Monday), source and occupation; late rows up to ``late``.

    Weeks are windows of seven days moved by four, because the epoch began on a Thursday.
    """
    week = F.window("date_creation", "7 days", "7 days", "4 days")
    return (
        postings.withWatermark("date_creation", late)
        .groupBy(week, "source", "rome_libelle")
        .agg(F.count("*").alias("nb_offres"), rounded_mean(F.col("salaire_min")).alias("salaire_moyen_min"),
             rounded_mean(F.col("salaire_max")).alias("salaire_moyen_max"))
        .select(F.col("window.start").alias("semaine"), "source", F.col("rome_libelle").alias("metier"), "nb_offres",
                "salaire_moyen_min", "salaire_moyen_max")
    )


def keep_weekly_trend(postings: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Keep the weekly trend as a table, for all files present, then stop.

    The sums stay in the stream's state, so a run after a restart reads new files only. Each batch replaces the table in one step; it
    has a row for each week, source and occupation. Late postings count in their week.
    """
    def replace(trend: DataFrame, _: int) -> None:
        publish(trend, table)

    return (weekly_trend_stream(postings).writeStream.outputMode("complete").foreachBatch(replace)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
