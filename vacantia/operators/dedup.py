"""Keep one row per key.

Both operators filter ``row_number() = 1``. Spark plans a group limit before the shuffle, so each input
partition sends at most one row per key and a key holding a third of all rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.functions.text import key_md5, normalise_title
from vacantia.schema import SOURCE_PRIORITY


def first_per_key(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Remaining ties are broken by a hash of the row, so a rerun keeps the same row."""
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    window = Window.partitionBy(*key).orderBy(*order, row)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str = "offre_id", at: str = "date_creation",
                   tiebreak: Sequence[Column] = ()) -> DataFrame:
    """The most recent row per key; rows without a date come last."""
    return first_per_key(df, [key], [F.col(at).desc_nulls_last(), *tiebreak])


def posting_key() -> Column:
    """Key under which postings of different sources count as the same."""
    return key_md5(normalise_title(F.col("titre")), F.col("entreprise"), F.col("ville"))


def best_source_per_posting(df: DataFrame, priority: Sequence[str] = SOURCE_PRIORITY) -> DataFrame:
    """One row per normalised title, company and city: the one from the best source, then lowest id."""
    rank = F.lit(len(priority))
    for position, source in reversed(list(enumerate(priority))):
        rank = F.when(F.col("source") == source, position).otherwise(rank)
    return first_per_key(df, [posting_key()], [rank, F.col("offre_id")])
