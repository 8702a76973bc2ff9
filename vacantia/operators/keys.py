"""Surrogate keys: hashes of the natural key, or dense numbers 1..n in sort order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.functions.text import NULL_MARK
from vacantia.session import staged

BUCKETS = 64
SAMPLE_PER_BUCKET = 32


def hash_key(*parts: Column) -> Column:
    """64-bit key computed from the natural key alone: the same in every run and without a join."""
    return F.xxhash64(*[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts])


def family_key(attempt: int, parts: Sequence[Column], bits: int = 64) -> Column:
    """The key that a natural key gets at an attempt: ``hash_key`` at first, then further hashes of the same parts."""
    named = [F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]
    key = hash_key(*parts) if attempt == 0 else F.xxhash64(F.lit(attempt), *named)
    return key if bits == 64 else F.shiftrightunsigned(key, 64 - bits)


def settle_keys(rows: DataFrame, key: Sequence[str], id_name: str, known: DataFrame | None = None, bits: int = 64,
                attempts: int = 100) -> DataFrame:
    """``id_name``, the columns of the natural ``key`` and ``essai`` for distinct new rows, no id twice and none of ``known``.

    Rows whose hash is taken get the next hash of the family, and so on. Of rows that meet, the first in order has the key, and
    what is known keeps its own, so keys are the same in every later run. Only rows that lost go into a further round; with 64
    bits there is hardly ever one. Rows with ``essai`` above 0 are the exceptions that a fact table has to look up.
    """
    taken = None if known is None else known.select(id_name)
    settled, open_ = [], rows.select(*key)
    for attempt in range(attempts):
        tried = open_.select(family_key(attempt, [F.col(k) for k in key], bits).alias(id_name), *key)
        placed = tried.withColumn("_place", F.row_number().over(Window.partitionBy(id_name).orderBy(*key)))
        if taken is not None:
            placed = placed.join(taken.select(id_name, F.lit(True).alias("_taken")), id_name, "left")
        else:
            placed = placed.withColumn("_taken", F.lit(None).cast("boolean"))
        wins = (F.col("_place") == 1) & F.col("_taken").isNull()
        placed = staged(placed.select(id_name, *key, wins.alias("_wins")), "keys")
        won = placed.filter("_wins").select(id_name, *key, F.lit(attempt).alias("essai"))
        settled.append(won)
        open_ = placed.filter("NOT _wins").select(*key)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        taken = won.select(id_name) if taken is None else taken.unionByName(won.select(id_name))
    raise ValueError(f"no free {id_name} after {attempts} attempts")


def exact_keys(df: DataFrame, id_name: str, parts: dict[str, Column], exceptions: DataFrame) -> DataFrame:
    """The rows with ``id_name`` replaced where their natural key is among the exceptions, which are few; Spark broadcasts them by
    their size."""
    listed = exceptions.select(F.col(id_name).alias("_id"), F.struct(*parts).alias("_k"))
    matched = df.withColumn("_k", F.struct(*[c.alias(n) for n, c in parts.items()])).join(listed, "_k", "left")
    return matched.withColumn(id_name, F.coalesce("_id", id_name)).drop("_k", "_id")


def dense_ids(df: DataFrame, order: Sequence[str], id_name: str, buckets: int = BUCKETS) -> DataFrame:
    """Number distinct rows 1..n in ascending order (NULL first) without sorting them in one task.

    A small fixed-size sample of the sort keys (the ones with the lowest hash, so the same in every run)
    gives bucket limits. Rows are numbered inside their bucket, and the number of rows in the buckets
    before is added. Sample and counts are scalar subqueries of bounded size; ``df`` must be distinct
    on ``order``, which keeps the buckets even.
    """
    key = F.struct(*order)
    sample = df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(buckets * SAMPLE_PER_BUCKET)
    limits = sample.agg(F.sort_array(F.collect_list("k")).alias("k")).select(
        F.filter("k", lambda _, i: i % SAMPLE_PER_BUCKET == SAMPLE_PER_BUCKET - 1)).scalar()
    below = F.size(F.filter("_limits", lambda limit: limit <= key))
    bucketed = df.withColumn("_limits", limits).withColumn("_bucket", below).drop("_limits")

    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("n"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    offsets = before.agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "before"))).alias("m")).scalar()

    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    numbered = F.element_at(offsets, F.col("_bucket")) + inside
    return bucketed.select(numbered.cast("bigint").alias(id_name), *df.columns)
