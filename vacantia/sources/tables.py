"""Parquet tables: partitioned posting tables, keyed tables with versions, named aggregates."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia.operators.merge import delete_insert_kinds, known_keys, sync_schema
from vacantia.schema import POSTING_SCHEMA
from vacantia.sources import commits

log = logging.getLogger(__name__)

HASHED_KEYS = 1 << 22  # fixed value: rows of a batch beyond which its keys, too large for a broadcast, are hashed and not ordered


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Write by partition columns. The rebalance gives few, even files and splits a partition value that
    holds much of the table over several tasks.

    Overwriting replaces the whole table, also partitions that have no rows any more, whatever the session's overwrite mode.
    """
    writer = df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).parquet(path)


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None when there is none. The table root is read, so partition columns stay."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("no table at %s", path)
        return None


def align(df: DataFrame, schema: T.StructType = POSTING_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of a schema, in order and type, and those to keep; absent ones are NULL."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields], *keep)


def read_sources(spark: SparkSession, paths: Mapping[str, str], schema: T.StructType = POSTING_SCHEMA) -> DataFrame:
    """Union of the tables that exist, aligned to one schema. Fails only when none exists."""
    found = [align(df, schema) for df in (try_read(spark, p) for p in paths.values()) if df is not None]
    if not found:
        raise ValueError("none of the sources has a table")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The rows of a table at its latest version, or at one given, or None. Later writes don't change them."""
    found = commits.read_version(spark, path, version)
    return commits.read_table(spark, path, found) if found else None


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the latest version of a table, 0 if there is none."""
    return (commits.version_numbers(spark, path) or [0])[-1]


def append_current(df: DataFrame, path: str, partition_by: Sequence[str] = (), write: str | None = None) -> None:
    """Add rows to a table, or start it, in one step: readers see all of them or none. A ``write`` of a name is taken once.

    Rows with other columns than the table has replace it by old and new rows under their columns: new ones are NULL in
    old rows, vanished ones go.
    """
    spark = df.sparkSession
    now = commits.read_version(spark, path)
    if now is not None and set(now.columns.names) != set(df.columns):
        commits.overwrite(sync_schema(commits.read_table(spark, path, now), df), path, partition_by, now.number)
    else:
        commits.append(df, path, partition_by, write)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 3, based_on: int | None = None) -> DataFrame:
    """Replace the rows of a table in one step and return them; the latest ``keep`` versions stay.

    The old version stays readable, so the new content may be computed from it. ``based_on`` is the version it was computed
    from: if another writer has made the next one meanwhile, the write fails and changes nothing.
    """
    spark = df.sparkSession
    version = commits.overwrite(df, path, partition_by, based_on)
    commits.forget(spark, path, keep)
    return commits.read_table(spark, path, version)


def reload_if_any(df: DataFrame, path: str) -> bool:
    """Replace a table by the rows given; no rows leave it unchanged. Says whether it was replaced."""
    if df.isEmpty():
        log.warning("nothing to load, %s stays unchanged", path)
        return False
    publish(df, path)
    return True


def write_named(tables: Mapping[str, DataFrame], root: str, skip_empty: Sequence[str] = ()) -> list[str]:
    """Write one table per name below a root; names in ``skip_empty`` are left out when they have no rows."""
    written = []
    for name, df in tables.items():
        if name in skip_empty and df.isEmpty():
            log.warning("no rows for %s, skipped", name)
            continue
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        written.append(name)
    return written


def append_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Append to a catalog table bucketed and sorted by its key.

    Looking for known keys in such a table, as insert-ignore does every day, does not shuffle it again.
    """
    df.write.mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def replace_in_partitions(batch: DataFrame, path: str, key: str, by: str) -> int:
    """Delete-then-insert by key that reads and rewrites only the partitions concerned, in one step.

    These are the partitions of the batch and those holding an older row of one of its keys. The latter are found from the key and
    partition columns alone, and only in partitions that the batch does not name: where it covers the table, nothing is looked up.
    Readers see the table before or after. Another writer's rows are not lost: if one was faster, the new content is computed again
    from what it left. Returns the number of partitions rewritten.
    """
    spark, done = batch.sparkSession, []
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    counted = batch.groupBy(by).count().collect()  # one row per partition
    named, hashed = {r[0] for r in counted}, sum(r[1] for r in counted) > HASHED_KEYS

    def among(values: set) -> Column:
        listed = F.col(by).isin([v for v in values if v is not None])
        return F.coalesce(listed, F.lit(False)) | (F.col(by).isNull() if None in values else F.lit(False))

    def changed(stored: DataFrame) -> tuple[DataFrame, set[str]]:
        elsewhere = stored.filter(~among(named)).select(key, by)
        older = elsewhere.join(known_keys(batch, key), key, "left_semi").select(by).distinct()
        values = named | {r[0] for r in older.collect()}  # one per partition
        done[:] = values
        kinds = (commits.KEPT, commits.NEW, commits.GONE)
        rows = delete_insert_kinds(stored.filter(among(values)), batch.select(stored.columns), key, commits.KIND, kinds, hashed)
        return rows, {names.getPartitionPathString(by, None if v is None else str(v)) for v in values}

    commits.change(spark, path, changed)
    return len(done)
