"""Landed files to postings, each file once: later runs read what is new or has changed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.plans.conform import CONFORMERS, clean_source, unify
from vacantia.schema import RECORD_SCHEMAS
from vacantia.session import staging_path
from vacantia.sources import envelopes, ledger
from vacantia.sources.tables import append_current, current_version, read_current

PROVENANCE = ("fichier", "lot")


def ledger_path(root: str) -> str:
    return f"{root}/fichiers_lus"


def rows_path(root: str, source: str) -> str:
    return f"{root}/postes_{source}"


def read_new_files(spark: SparkSession, source: str, files: str, root: str) -> tuple[DataFrame, str, int] | None:
    """Write the postings of the files that are new or have changed, with where they come from. They don't count yet.

    Returns the changes, the name of the landing and its number, or None if there are no files. Only the files' names and sizes go
    through the driver, which hands them to the reader.
    """
    found = ledger.changes(spark, source, files, ledger_path(root))
    if found is None:
        return None
    listed = staging_path(spark, "listed")  # what is read is what is entered, whatever lands meanwhile
    found.write.parquet(listed)
    found = spark.read.schema(found.schema).parquet(listed)
    names = [r[0] for r in found.filter("octets IS NOT NULL").select("fichier").collect()]
    lot, number = uuid.uuid4().hex, current_version(spark, ledger_path(root)) + 1
    if names:
        landed = envelopes.records(envelopes.read_envelopes(spark, names), RECORD_SCHEMAS[source], keep=("fichier",))
        append_current(CONFORMERS[source](landed).withColumn("lot", F.lit(lot)), rows_path(root, source))
    return found, lot, number


def land(spark: SparkSession, landed: Mapping[str, str], root: str) -> dict[str, int]:
    """Read the new and changed files of each source that has any; the number of changes by source, files that are gone among
    them. A run that stops is made good by the next."""
    done = {}
    for source, files in landed.items():
        read = read_new_files(spark, source, files, root)
        if read is None:
            continue
        found, lot, number = read
        done[source] = found.count()
        if done[source]:
            ledger.enter(found, source, lot, number, ledger_path(root))
    return done


def landed_postings(spark: SparkSession, source: str, root: str) -> DataFrame | None:
    """The postings of a source as its files are now, with fichier and lot."""
    rows = read_current(spark, rows_path(root, source))
    return None if rows is None else ledger.counted(rows, ledger.read_ledger(spark, ledger_path(root)).filter(F.col("source") == source))


def clean_postings(spark: SparkSession, source: str, root: str) -> DataFrame | None:
    """The valid postings of a source, the latest row of each id."""
    rows = landed_postings(spark, source, root)
    return None if rows is None else clean_source(rows.drop(*PROVENANCE))


def unified_postings(spark: SparkSession, sources: Mapping[str, str] | list[str], root: str) -> DataFrame:
    """The postings of all sources without copies across them."""
    found = [df for df in (clean_postings(spark, s, root) for s in sources) if df is not None]
    if not found:
        raise ValueError("none of the sources has landed")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return unify(out)
