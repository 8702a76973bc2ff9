"""Which landed files have been read: a table of (source, fichier, octets, modifie, lot), to which each landing adds the files it has read.

A file is new if the ledger has no row of its path, length and change time. Rows read from a file carry its path and the landing's
number; they count only if the ledger names that landing as the last that read the file. So the ledger's one commit makes a
landing count: rows of a landing that stopped before it are never seen, and rows of a file's older content go when it is read again.
A file that is gone from the landing folder is entered without a length, and its rows go too: the outcome is that of reading everything
there is anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.operators.dedup import first_per_key
from vacantia.sources.tables import append_current, read_current

LEDGER = "source string, fichier string, octets bigint, modifie timestamp, lot string, numero bigint"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(fichier, octets, modifie) of the files under a path or glob that are not empty. Their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("fichier"), F.col("length").alias("octets"), F.col("modificationTime").alias("modifie"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    found = read_current(spark, path)
    return spark.createDataFrame([], LEDGER) if found is None else found


def changes(spark: SparkSession, source: str, files: str, ledger: str) -> DataFrame | None:
    """The files of a source that no landing has read as they are now, and without a length those read once that are gone; None
    if there are no files at all."""
    try:
        listed = list_files(spark, files)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    known = latest(read_ledger(spark, ledger).filter(F.col("source") == source)).filter("octets IS NOT NULL").select("fichier", "octets", "modifie")
    new = listed.join(known, ["fichier", "octets", "modifie"], "left_anti")
    gone = known.join(listed, "fichier", "left_anti").select("fichier", F.lit(None).cast("bigint").alias("octets"), "modifie")
    return new.select("fichier", "octets", "modifie").unionByName(gone)


def enter(files: DataFrame, source: str, lot: str, number: int, ledger: str) -> None:
    """Make a landing count. A landing of a name is entered once."""
    rows = files.select(F.lit(source).alias("source"), "fichier", "octets", "modifie", F.lit(lot).alias("lot"),
                        F.lit(number).cast("bigint").alias("numero"))
    append_current(rows, ledger, write=lot)


def latest(ledger: DataFrame) -> DataFrame:
    """The last row of each file."""
    return first_per_key(ledger, ["source", "fichier"], [F.col("numero").desc(), F.col("lot").desc()])


def counted(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows, with fichier and lot, that count."""
    return rows.join(latest(ledger).select("fichier", "lot"), ["fichier", "lot"], "left_semi").select(rows.columns)
