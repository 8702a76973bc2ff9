"""WARC archives: a writer of response and revisit records, and a reader that salvages what it can.

Payloads that are equal, by SHA-1, and of ``least_revisit`` bytes or more are stored once, as the response of the largest
page_id; the others are revisits that refer to it. Archives are plain WARC 1.1 files of about ``archive_bytes``, written by
Spark's text writer with the record separator as its line separator, so that lost tasks are repeated and leave no halves.

The reader takes each archive as a whole (their size is bounded) and walks it member by member. A record counts if
its version line, headers, length, separator and block digest are right. After a failed check it looks for the next version line
or gzip member that starts a valid record, goes on there, and logs the bytes between as a quarantined gap with the
reason. A member of gzip may hold many records. One that is cut or damaged is inflated as far as it goes and its whole records
count; if it is damaged and not just cut, only those that a block digest confirms, and they are marked ``doubtful``, for nothing
confirms their headers. Members are fed in slices, so the time is linear in the bytes. What lies in a member has the member's place in ``at`` and ``length`` and its own in the inflated content
in ``inner_at`` and ``inner_length``.

Null html is an empty payload, null urls are left out. Equal rows give a record each; if several have the largest
page_id, all of them are responses. Pages without an id are responses unless an equal payload has one. A very long page is a record
like any other, in an archive with few others. Further columns are not stored. An empty table gives no archives, and a folder without archives no records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia.llm.common import staged
from vacantia.session import staging_path

END = "\r\n\r\n"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
SLICE = 1 << 16  # bytes given to zlib at a time
OVERHEAD = 600  # bytes of a record beside its payload, roughly
SPREAD = 16
RECORD = ("archive string, at bigint, length bigint, type string, id string, refers_to string, uri string, "
          "payload_digest string, payload binary, gap string, inner_at bigint, inner_length bigint, doubtful boolean")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, least_revisit: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, refers_to.

    Only digests and ids are grouped; payloads are not shuffled unless the table of repeated digests is too large to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    page = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    long = F.octet_length("payload") >= least_revisit
    repeated = staged(page.where(long).groupBy("payload_digest").agg(
        F.count("*").alias("n"), F.max("page_id").alias("response")).where("n > 1").drop("n"), "repeated")
    joined = page.join(repeated.withColumnRenamed("payload_digest", "digest"), long & (F.col("payload_digest") == F.col("digest")), "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("response")).alias("refers_to"))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, none for a null. Control characters can't break the line."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", ""), F.lit("\r\n")), F.lit(""))


def record(date: str) -> Column:
    """The bytes of a record without the separator, as string."""
    revisit = F.col("record_type") == "revisit"
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(revisit, http.cast("binary")).otherwise(F.concat(http.cast("binary"), F.col("payload")))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return F.concat(headers.cast("binary"), block).cast("string")


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 16 << 20, least_revisit: int = 1000,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each page. Tasks write what they read; payloads are not dealt out anew.

    Ordinary pages, of at most ``SPREAD`` times the mean, go to files of so many records as make ``archive_bytes`` on
    average. Longer ones are written by classes of length with fewer to a file, so that no archive passes
    ``SPREAD * archive_bytes`` unless one record alone does. A class costs a scan of the pages, and there are at most seven.
    """
    long = F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint") + OVERHEAD
    n, total = pages.agg(F.count("*"), F.sum(long)).first()
    mean = max(OVERHEAD, -(-(total or 0) // max(n, 1)))
    tops = [mean * SPREAD]
    while tops[-1] < 1 << 31:
        tops.append(tops[-1] * SPREAD)
    inside = [(long > low) & (long <= top) for low, top in zip([0, *tops], tops)]
    counts = pages.agg(*[F.count(F.when(c, 1)) for c in inside]).first()
    records = with_revisits(pages, least_revisit).select(record(date).alias("value"), (F.octet_length("payload").cast("bigint") + OVERHEAD).alias("size"))
    for i, (low, top) in enumerate(zip([0, *tops], tops)):
        if i and not counts[i]:
            continue
        per_file = max(1, archive_bytes // mean if i == 0 else SPREAD * archive_bytes // top)
        some = records.where((F.col("size") > low) & (F.col("size") <= top)) if i or counts[0] < n else records
        some.select("value").write.mode("append").option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def _parse(data: bytes, at: int) -> tuple[dict | None, int | str]:
    """A record and where the next one starts, or None and what is wrong."""
    version = VERSION.match(data, at)
    if not version:
        return None, "no version line"
    stop = data.find(b"\r\n\r\n", version.end() - 2)
    if stop < 0:
        return None, "headers without end"
    headers = {}
    for line in data[version.end():stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None, "bad header"
        headers[name.strip().lower()] = value.strip()
    size = headers.get(b"content-length", b"")
    if not size.isdigit():
        return None, "no length"
    start, end = stop + 4, stop + 4 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        return None, "length and separator disagree"
    block = data[start:end]
    digest = headers.get(b"warc-block-digest", b"")
    confirmed = digest.startswith(b"sha1:")
    if confirmed and digest[5:].decode("latin-1").lower() != hashlib.sha1(block).hexdigest():
        return None, "block digest differs"
    if headers.get(b"content-type", b"").startswith(b"application/http"):
        _, found, body = block.partition(b"\r\n\r\n")
        block = body if found else block
    text = {k.decode("latin-1"): v.decode("utf-8", "replace") for k, v in headers.items()}
    return {"type": text.get("warc-type"), "id": text.get("warc-record-id"), "refers_to": text.get("warc-refers-to"),
            "uri": text.get("warc-target-uri"), "payload_digest": text.get("warc-payload-digest"), "payload": block,
            "confirmed": confirmed}, end + 4


def _feed(stream, piece: memoryview, out: bytearray) -> tuple[object, int | None]:
    """Inflate a piece. The stream to go on with, and the byte of the piece at which it broke, or None."""
    before = stream.copy()
    try:
        out += stream.decompress(piece)
        return stream, None
    except zlib.error:
        if len(piece) == 1:
            return before, 0
    half = len(piece) // 2
    stream, broke = _feed(before, piece[:half], out)
    if broke is not None:
        return stream, broke
    stream, broke = _feed(stream, piece[half:], out)
    return stream, half + broke if broke is not None else None


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """What a gzip member holds, as far as it can be inflated; where that ends; what is wrong with the rest, if anything."""
    stream, out, step = zlib.decompressobj(31), bytearray(), 1 << 12
    while at < len(data):
        piece = data[at:at + step]
        stream, broke = _feed(stream, piece, out)
        if broke is not None:
            return bytes(out), at + broke, "broken gzip member"
        at += len(piece)
        if stream.eof:
            return bytes(out), at - len(stream.unused_data), ""
        step = min(2 * step, SLICE)
    return bytes(out), at, "gzip member cut"


def _walk(data: bytes, members: bool, confirmed: bool = False) -> Iterator[dict]:
    """Valid records and gaps of some bytes. ``members``: gzip members are opened. ``confirmed``: records need a block digest."""
    at, bad, reason = 0, None, ""
    candidate = re.compile(rb"WARC/1\.[01]\r\n" + (b"|" + re.escape(GZIP) if members else b""))
    view = memoryview(data)
    while at < len(data):
        rows, wrong, since = [], "", at
        if members and data.startswith(GZIP, at):
            content, end, wrong = _inflate(view, at)
            found = list(_walk(content, False, wrong.startswith("broken")))
            if any("id" in r for r in found):
                rows = [r | {"at": at, "length": end - at, "inner_at": r["at"], "inner_length": r["length"]} for r in found]
                since = end
            else:
                wrong = wrong or "member without records"
        else:
            one, end = _parse(data, at)
            if one is None:
                wrong = end
            elif confirmed and not one["confirmed"]:
                wrong = "no digest in a broken member"
            else:
                rows = [{k: v for k, v in one.items() if k != "confirmed"} | {"at": at, "length": end - at}
                        | ({"doubtful": True} if confirmed else {})]
        if rows and bad is not None:
            yield {"at": bad, "length": at - bad, "gap": reason}
            bad = None
        yield from rows
        if not wrong:
            at = end
            continue
        if bad is None:
            bad, reason = since, wrong
        hit = candidate.search(data, at + 1)
        at = hit.start() if hit else len(data)
        if bad >= at:  # the member was inflated up to where the next one starts
            bad = None
    if bad is not None:
        yield {"at": bad, "length": len(data) - bad, "gap": reason}


def salvage(data: bytes) -> Iterator[dict]:
    """Valid records, each with where it starts and its length, and gaps: the bytes between them and what was wrong.

    For what lies inside a gzip member, ``at`` and ``length`` are those of the member, or of the part of it that could be
    inflated, and ``inner_at`` and ``inner_length`` say where it lies in the inflated content.
    """
    return _walk(data, True)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record, and one with ``gap`` for each stretch of bytes that holds no valid record."""
    names = ["archive", "at", "length", "type", "id", "refers_to", "uri", "payload_digest", "payload", "gap", "inner_at", "inner_length", "doubtful"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(n, pa.int64() if n.endswith(("at", "length")) else pa.binary() if n == "payload" else pa.bool_() if n == "doubtful" else pa.string()) for n in names])
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for row in salvage(content.as_py()):
                    rows.append(row | {"archive": name, "doubtful": row.get("doubtful", False)})
                    size += len(row.get("payload") or b"") + 200
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, kind)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,warc,gz}").load(path)
    return files.select("path", "content").mapInArrow(records, RECORD)


def page_of(record_id_: Column) -> Column:
    return F.regexp_extract(record_id_, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records read; a revisit has the bytes of its response.

    The digest is that of the bytes read; a revisit's is the one it names. Doubtful records are left out.
    """
    found = read_archives(spark, path).where("gap IS NULL AND NOT doubtful")
    rows = staged(found.select(
        page_of(F.col("id")).alias("page_id"), F.col("type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.when(F.col("type") == "revisit", F.regexp_replace("payload_digest", "^sha1:", "")).otherwise(F.sha1("payload")).alias("payload_digest")), "records")
    responses = rows.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("own_bytes").alias("full_bytes"))
    responses = responses.select(F.col("page_id").alias("of"), F.col("payload_digest").alias("of_digest"), "full_bytes")
    match = (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("of_digest"))
    bytes_ = F.when(F.col("record_type") == "revisit", F.col("full_bytes")).otherwise(F.col("own_bytes"))
    return rows.join(responses, match, "left").select("page_id", bytes_.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = staging_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_pages(pages.sparkSession, path)
