"""Landed JSON: one document per source, keyword and run, holding an array of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from vacantia.schema import ENVELOPE

CORRUPT = "_corrupt"
NO_LINE = "\0" * 8
RECORDS_PER_ENVELOPE = 50_000
BYTES_PER_ENVELOPE = 64 << 20


def read_envelopes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Documents under a path, a glob or some paths: header fields, ``offres`` (JSON text of each record) and ``fichier``.

    The schema is given, so no pass over the data is needed to infer it, and an absent field is NULL. Records stay text
    here, so a record that does not fit its schema costs neither its document nor its neighbours. A file without a
    readable list of records gives a row whose ``offres`` is NULL, or no row. A file is read as one line, by a separator that no JSON
    text can hold in any of its encodings: in ``multiLine`` mode the text of each record costs a seek in the file.
    """
    return (
        spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("lineSep", NO_LINE).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path if isinstance(path, str) else list(path)).withColumn("fichier", F.col("_metadata.file_path")).drop(CORRUPT)
    )


def _is_object(text: Column) -> Column:
    return F.coalesce(F.startswith(F.ltrim(text), F.lit("{")), F.lit(False))


def records(envelopes: DataFrame, record: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record with its fields, the source of the envelope and its columns to keep. Empty envelopes give none.

    A value that does not fit its field is NULL, the record's other values stay. What is not an object gives no row.
    """
    raw = envelopes.select("source", *keep, F.explode("offres").alias("_raw")).filter(_is_object(F.col("_raw")))
    parsed = raw.select(F.from_json("_raw", record, {"mode": "PERMISSIVE"}).alias("_o"), "source", *keep)
    return parsed.select(*[F.col("_o")[f].alias(f) for f in record.names if f not in ("source", *keep)], "source", *keep)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(fichier) of every file under a path or glob, as the scan lists them; files without a byte too, which it leaves out.

    The list goes from the scan's own listing to a table inside the JVM: no file costs a call of its own.
    """
    found = spark.read.format("binaryFile").load(path)._jdf.inputFiles()
    jvm, n = spark._jvm, len(found)
    held = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, n)
    jvm.java.lang.System.arraycopy(found, 0, held, 0, n)
    names = DataFrame(spark._jsparkSession.createDataset(jvm.java.util.Arrays.asList(held), jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    return names.select(F.regexp_replace("value", "^file:///", "file:/").alias("fichier"))  # as scans name them


def landing_report(spark: SparkSession, path: str) -> DataFrame:
    """Every file: its size, whether a list of records could be read, and how many records were read and rejected."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("fichier"), F.col("_metadata.file_size").alias("octets"))
    empty = listed_files(spark, path).join(files.select("fichier"), "fichier", "left_anti")  # scans leave them out
    files = files.unionByName(empty.withColumn("octets", F.lit(0).cast("bigint")))
    good = F.size(F.filter("offres", _is_object))
    seen = read_envelopes(spark, path).filter("offres IS NOT NULL").groupBy("fichier").agg(
        F.sum(good).alias("nb_lues"), F.sum(F.size("offres") - good).alias("nb_rejetees"))
    zero = F.lit(0).cast("bigint")
    return files.join(seen, "fichier", "left").select(
        "fichier", "octets", F.col("nb_lues").isNotNull().alias("lisible"),
        F.coalesce("nb_lues", zero).alias("nb_lues"), F.coalesce("nb_rejetees", zero).alias("nb_rejetees"))


def rejected(report: DataFrame) -> DataFrame:
    """Files that could not be read, or not all of whose records could."""
    return report.filter(~F.col("lisible") | (F.col("nb_rejetees") > 0))


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects as columns with dotted names; arrays stay arrays."""

    def walk(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            at = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, at)
            else:
                yield F.col(".".join(f"`{p}`" for p in at)).alias(".".join(at))

    return df.select(*walk(df.schema, ()))


def to_envelopes(df: DataFrame, collected_at: str, source: str = "source", keyword: str = "keyword",
                 records_per_envelope: int = RECORDS_PER_ENVELOPE, bytes_per_envelope: int = BYTES_PER_ENVELOPE) -> DataFrame:
    """Pack records into envelopes of bounded size, in records and in bytes.

    A source and keyword may hold most of the table. Its records are dealt into as many chunks as keep the bounds on
    average, by a hash of the record, and each chunk is cut again where it holds more; so no task holds a group, and
    there are no more envelopes than the bounds ask for. Readers treat several envelopes of a keyword as one.
    """
    fields = [c for c in df.columns if c not in (source, keyword)]
    sized = df.withColumn("_size", F.length(F.to_json(F.struct(*fields))))
    chunks = F.ceil(F.greatest(F.count("*") / records_per_envelope, F.sum("_size") / bytes_per_envelope)).alias("_chunks")
    totals = sized.groupBy(source, keyword).agg(chunks).select(F.struct(source, keyword).alias("_group"), "_chunks")
    dealt = sized.withColumn("_group", F.struct(source, keyword)).join(totals, "_group").drop("_group").withColumn(
        "_chunk", F.pmod(F.xxhash64(*fields), F.col("_chunks")))
    order = Window.partitionBy(source, keyword, "_chunk").orderBy(F.xxhash64(*fields)).rowsBetween(Window.unboundedPreceding, -1)
    cut = dealt.withColumn("_cut", F.greatest(
        F.floor(F.count("*").over(order) / records_per_envelope),
        F.floor(F.coalesce(F.sum("_size").over(order), F.lit(0)) / bytes_per_envelope)))
    return (
        cut.groupBy(source, keyword, "_chunk", "_cut")
        .agg(F.count("*").alias("nb_offres"), F.collect_list(F.struct(*fields)).alias("offres"))
        .select(F.col(source).alias("source"), F.col(keyword).alias("keyword"),
                F.lit(collected_at).alias("date_collecte"), "nb_offres", "offres")
    )


def write_envelopes(envelopes: DataFrame, path: str) -> None:
    """One JSON document per file, in one folder per source."""
    (
        envelopes.withColumn("dossier", F.col("source"))
        .write.mode("append").option("maxRecordsPerFile", 1).partitionBy("dossier").json(path)
    )
