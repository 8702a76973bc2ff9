"""Shards by rendezvous hashing.

Each shard scores a record by a hash of the record's key and the shard's number, and the highest score wins. With
u = hash / 2**64 and a shard's weight w, the score is -w / ln(u), so that a shard wins in proportion to its weight. A record's
shard depends on its key, the shard numbers and the weights only. One more shard takes a record if it scores highest, and no
record moves between the shards there were; on average 1/n of the records move.

Records get slots in their shard, from 0 without gaps. They are numbered inside buckets of a shard, and the counts of
the buckets before are added, so that no task holds a whole shard.

Null keys share one hash. Records of equal key share a shard, and get slots of their own, equal ones in any order; however many
they are, they are numbered in pieces of bounded size. Null texts have no bytes. Of a text only its size and checksum are
carried, so a very long one weighs no more than another. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm.common import staged

OVERHEAD = 16  # bytes of a record beside its text


def score(key: Column, shard: int, weight: float) -> Column:
    """A double, greater for likelier; the hash's upper 52 bits, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 12)
    unit = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.lit(float(weight)) / -F.log(unit)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard of highest score; of equal scores the last."""
    return F.array_max(F.array(*[F.struct(score(key, i, w).alias("score"), F.lit(i).alias("shard"))
                                 for i, w in enumerate(weights)]))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], grown_by: float | None = None) -> DataFrame:
    """The table with ``shard`` and, for one more shard of weight ``grown_by``, ``grown_shard``."""
    out = df.withColumn("shard", rendezvous(F.col(key), weights))
    if grown_by is None:
        return out
    best = F.greatest(*[score(F.col(key), i, w) for i, w in enumerate(weights)]) if len(weights) > 1 else score(F.col(key), 0, weights[0])
    more = score(F.col(key), len(weights), grown_by)
    return out.withColumn("grown_shard", F.when(more >= best, F.lit(len(weights))).otherwise(F.col("shard")))


def dealt(rows: DataFrame, order: Sequence[str], bucket_rows: int) -> DataFrame:
    """The rows, written to the shared folder once, with ``__bucket``, ``__heavy`` and ``__piece``: groups of a shard that
    hold some ``bucket_rows`` rows each, whatever the size of the table.

    Buckets follow a hash of ``order``. Where one holds far more than its share, rows equal in ``order`` are counted, and those
    more than ``bucket_rows`` are dealt out by their place in the written rows.
    """
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "sharded")
    shards = max(rows.select("shard").distinct().count(), 1)
    buckets = max(1, -(-rows.count() // (bucket_rows * shards)))
    out = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    full = out.groupBy("shard", "__bucket").agg(F.count("*").alias("__n")).where(F.col("__n") > 2 * bucket_rows)
    equal = out.join(full, ["shard", "__bucket"], "left_semi").groupBy("shard", *order).agg(F.count("*").alias("__n"))
    heavy = equal.where(F.col("__n") > bucket_rows).select(
        *[F.col(c).alias(f"__of_{c}") for c in ("shard", *order)], F.xxhash64(*order).alias("__heavy"),
        F.ceil(F.col("__n") / bucket_rows).cast("long").alias("__pieces"))
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in ("shard", *order)]
    return out.join(staged(heavy, "heavy"), same, "left").select(
        *out.columns, F.coalesce("__heavy", F.lit(0)).alias("__heavy"),
        F.coalesce(F.pmod(F.xxhash64("__row"), F.col("__pieces")), F.lit(0)).alias("__piece")).drop("__row")


def with_slots(rows: DataFrame, order: Sequence[str], bucket_rows: int = 20_000) -> DataFrame:
    """The rows, narrow ones, with ``slot``: gapless in each shard. Rows equal in ``order`` may change places."""
    groups = ["__bucket", "__heavy", "__piece"]
    parts = dealt(rows, order, bucket_rows)
    before = Window.partitionBy("shard").orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("shard", *groups).agg(F.count("*").alias("__n"))
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.row_number().over(Window.partitionBy("shard", *groups).orderBy(*order))
    numbered = parts.withColumn("__number", number - 1)
    return numbered.join(offsets, ["shard", *groups]).withColumn(
        "slot", (F.col("__number") + F.col("__before")).cast("long")).drop(*groups, "__number", "__before")


def shard_manifest(docs: DataFrame, weights: Sequence[float], grown_by: float = 1.0, doc: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each document."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(F.col(doc).alias("doc_id"), (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
                         F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"))
    placed = assign_shards(narrow, "doc_id", weights, grown_by)
    return with_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Write a table as one folder for each shard. Large shards are several files, each of one task."""
    assign_shards(df, key, weights).hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
