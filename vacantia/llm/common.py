"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.memory import give_back
from vacantia.session import staging_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts lineage and keeps costly rows for several uses. The files survive lost executors, and their size is known
    to the optimiser, which broadcasts them only below its threshold.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, gone: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """The rows whose ``keys`` are not among those of ``gone``, whose columns have the suffix. Nulls are equal.

    A bitmap of fixed size tells most rows that stay; they are not moved. Only rows that it can't tell, the ones that go among them,
    meet ``gone`` in a join. A fuller bitmap sends more rows there and changes nothing else.
    """
    def slot(hash_: Column) -> Column:
        return F.shiftrightunsigned(hash_, 48).cast("int")

    def bit(hash_: Column) -> Column:
        return hash_.bitwiseAND(63).cast("int")

    hashed = gone.select(F.xxhash64(*[f"{k}{suffix}" for k in keys]).alias("__h"))
    bits = hashed.groupBy(slot(F.col("__h")).alias("__slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(F.col("__h")))).alias("__bits"))
    marked = docs.withColumn("__h", F.xxhash64(*keys)).withColumn("__slot", slot(F.col("__h"))).join(
        F.broadcast(bits), "__slot", "left")  # 65,536 rows at most
    may_go = F.coalesce(F.call_function("getbit", "__bits", bit(F.col("__h"))) == 1, F.lit(False))
    same = [F.col(k).eqNullSafe(F.col(f"{k}{suffix}")) for k in keys]
    stay = marked.where(~may_go).select(*docs.columns)
    return stay.unionByName(marked.where(may_go).join(gone, same, "left_anti").select(*docs.columns))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def sha256_hex(data: Column) -> Column:
    return F.sha2(data, 256)


def in_parts(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes, nulls as empty texts; a longer text is in a run with few others."""
    texts = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(sizes // most)) + 1).tolist(), len(texts)]
    yield from (texts[a:b] for a, b in zip(cuts, cuts[1:]) if a < b)


def lean(of_batch: Callable) -> Callable:
    """The same function of one batch, which gives memory back after each."""
    @wraps(of_batch)
    def run(*columns):
        out = of_batch(*columns)
        give_back()
        return out

    return run


_HELD: dict = {}


def held(key: tuple, make: Callable):
    """What ``make`` gives, kept in this worker until another key is asked for: a worker holds one table, not one of each stage."""
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = make()
    return _HELD[key]


class SlotTables:
    """Whole numbers to values, looked up side by side: tables of one key a slot; keys that meet go on to the next table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        self.missing, self.kind, self.tables = missing, values.dtype, []
        random = np.random.default_rng(0)
        while len(keys):
            bits = int(len(keys)).bit_length() + 2
            factor, shift = np.uint64(random.integers(1 << 62, 1 << 63) | 1), np.uint64(64 - bits)
            at = (keys.view(np.uint64) * factor >> shift).view(np.int64)
            _, first = np.unique(at, return_index=True)
            slots, held = np.zeros(1 << bits, np.int64), np.full(1 << bits, missing, values.dtype)
            full = np.zeros(1 << bits, bool)
            slots[at[first]], held[at[first]], full[at[first]] = keys[first], values[first], True
            self.tables.append((factor, shift, slots, held, full))
            keys, values = np.delete(keys, first), np.delete(values, first)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.missing, self.kind)
        for factor, shift, slots, held, full in self.tables:
            at = (keys.view(np.uint64) * factor >> shift).view(np.int64)
            hit = (slots[at] == keys) & full[at]
            out[hit] = held[at[hit]]
        return out
