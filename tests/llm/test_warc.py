import gzip
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from vacantia.llm import warc as W

LONG, OTHER = "<p>é</p>" * 200, "x" * 1000
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, "http://a/9\r\nInjected: yes", LONG), (3, "http://a/3", "short"), (4, "http://a/4", "short"),
        (5, None, None), (6, "", ""), (7, "http://a/7", OTHER), (8, "http://a/8", OTHER + "y"), (10, "http://a/10", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40),
        (11, "http://a/11", "x" * 999), (12, "http://a/12", "x" * 999), (13, "http://a/13", "\r\n\r\n\x00\x1f" * 300), (None, "http://n", LONG),
        (None, "http://n", "lonely " * 300), (9, "http://a/9", LONG), (20, "http://a/20", "z" * 300_000)]


def want(rows):
    digest = {i: hashlib.sha1((h or "").encode()).hexdigest() for i, (_, _, h) in enumerate(rows)}
    top = {}
    for i, (page, _, html) in enumerate(rows):
        if page is not None and len((html or "").encode()) >= 1000:
            top[digest[i]] = max(page, top.get(digest[i], page))
    out = []
    for i, (page, _, html) in enumerate(rows):
        response = top.get(digest[i])
        revisit = response is not None and page != response
        out.append((page, len((html or "").encode()), digest[i], "revisit" if revisit else "response", response if revisit else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id bigint, url string, html string").withColumn("record_type", F.lit("clash"))


def test_round_trip(pages):
    assert sorted((tuple(r) for r in W.round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == want(ROWS)


def test_empty_table(pages):
    assert W.round_trip(pages.limit(0)).count() == 0


def archives(folder):
    return sorted(f for f in os.listdir(folder) if f.endswith(".txt"))


def test_archives_are_bounded_and_plain(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    W.write_archives(pages.coalesce(1), path, archive_bytes=40_000)
    names = archives(path)
    assert len(names) > 3
    data = b"".join(open(f"{path}/{n}", "rb").read() for n in names)
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    assert b"\r\nInjected: yes" not in data
    found = list(W.salvage(data))
    assert len(found) == len(ROWS) and not any("gap" in r for r in found)


def test_salvage_of_damaged_archives(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    W.write_archives(pages.coalesce(1), path)
    data = open(f"{path}/{archives(path)[0]}", "rb").read()
    whole = list(W.salvage(data))
    for i, r in enumerate(whole):
        at, end = r["at"], r["at"] + r["length"]
        others = [x["id"] for j, x in enumerate(whole) if j != i]
        changed = data[:end - 10] + b"#" + data[end - 9:]  # a byte of the block
        for damaged, gap in ((changed, (at, end - at)), (data[:at] + b"JUNK" + data[at + 4:], (at, end - at))):
            found = list(W.salvage(damaged))
            assert [x["id"] for x in found if "id" in x] == others
            assert [(x["at"], x["length"]) for x in found if "gap" in x] == [gap]
            covered = sum(x["length"] for x in found)
            assert covered == len(damaged)
    cut = list(W.salvage(data[:-7]))
    assert [x["id"] for x in cut if "id" in x] == [x["id"] for x in whole[:-1]] and cut[-1]["gap"]
    assert list(W.salvage(b"")) == [] and list(W.salvage(b"noise")) == [{"at": 0, "length": 5, "gap": "no version line"}]


def test_gzip_members(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    W.write_archives(pages.coalesce(1), path)
    data = open(f"{path}/{archives(path)[0]}", "rb").read()
    whole = list(W.salvage(data))
    members = [gzip.compress(data[r["at"]:r["at"] + r["length"]]) for r in whole]
    folder = tmp_path / "gz"
    folder.mkdir()
    broken = bytearray(members[3])
    broken[len(broken) // 2] ^= 0xFF
    joined = b"".join(members[:3]) + bytes(broken) + b"".join(members[4:])
    (folder / "a.warc.gz").write_bytes(joined)
    (folder / "b.warc").write_bytes(data)
    rows = W.read_archives(spark, str(folder)).collect()
    a = [r for r in rows if r.archive.endswith("a.warc.gz")]
    assert [r.id for r in a if r.gap is None] == [r["id"] for j, r in enumerate(whole) if j != 3]
    gaps = [(r["at"], r.length) for r in a if r.gap]
    assert gaps == [(sum(map(len, members[:3])), len(broken))]
    assert sum(r.archive.endswith("b.warc") for r in rows) == len(ROWS)


def plain(n, digest=True, size=300):
    """Records made by hand."""
    out = []
    for i in range(n):
        block = (f"page {i} " * size)[:size].encode()
        line = f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}\r\n" if digest else ""
        out.append(f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n{line}Content-Length: {size}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return out


def ids(found):
    return [int(r["id"][10:-1]) for r in found if "id" in r]


def gaps_of(found):
    return [(r["at"], r["length"], r.get("inner_at"), r.get("inner_length")) for r in found if "gap" in r]


@pytest.mark.parametrize("digest", [True, False])
def test_a_cut_member_gives_its_whole_records(digest):
    records = plain(500, digest)
    member = gzip.compress(b"".join(records))
    cut = member[:len(member) * 9 // 10]
    found = list(W.salvage(cut))
    n = len(ids(found))
    assert ids(found) == list(range(n)) and 400 < n < 500
    inner = sum(len(r) for r in records[:n])
    assert gaps_of(found)[0][2] == inner  # inflated bytes of the record that was cut
    after = gzip.compress(b"".join(plain(3)))
    found = list(W.salvage(cut + after))
    assert ids(found)[-3:] == [0, 1, 2] and set(range(n)) <= set(ids(found)[:-3])


def test_a_damaged_member_gives_what_digests_confirm():
    first, second = gzip.compress(b"".join(plain(500))), gzip.compress(b"".join(plain(5)))
    for at in range(len(first) // 10, len(first), len(first) // 7):
        damaged = bytearray(first)
        damaged[at] ^= 0x55
        found = list(W.salvage(bytes(damaged) + second))
        right = {(f"page {i} " * 300)[:300].encode() for i in range(500)}
        got = [r for r in found if "id" in r]
        assert ids(got[-5:]) == list(range(5)) and not any("doubtful" in r for r in got[-5:])
        assert all(r["doubtful"] and r["payload"] in right for r in got[:-5]) and len(got) <= 505
        assert gaps_of(found)
    unsure = bytearray(gzip.compress(b"".join(plain(50, digest=False))))
    unsure[-6] ^= 1  # the check sum
    assert ids(W.salvage(bytes(unsure))) == []
    sure = bytearray(gzip.compress(b"".join(plain(50))))
    sure[-6] ^= 1
    assert ids(W.salvage(bytes(sure))) == list(range(50))


def test_gaps_inside_a_member_have_their_own_place():
    records = plain(6)
    content = b"".join(records[:2]) + b"#" * 90 + b"".join(records[2:])
    member = gzip.compress(content)
    found = list(W.salvage(b"noise" + member))
    assert ids(found) == list(range(6))
    assert gaps_of(found) == [(0, 5, None, None), (5, len(member), sum(map(len, records[:2])), 90)]


def test_many_members_take_linear_time():
    members = b"".join(gzip.compress(r) for r in plain(10_000, size=2000))
    start = time.time()
    assert sum("id" in r for r in W.salvage(members)) == 10_000
    assert time.time() - start < 4


def test_long_pages_have_archives_with_few_others(spark, tmp_path):
    rows = [(i, "u", f"{i} " * 20) for i in range(400)] + [(1000 + i, "u", f"{i} " * 40_000) for i in range(4)] + [(2000, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    W.write_archives(pages, path, archive_bytes=20_000)
    sizes = [os.path.getsize(f"{path}/{n}") for n in archives(path)]
    assert max(sizes) < 16 * 20_000
    assert sorted((tuple(r) for r in W.read_pages(spark, path).collect()), key=str) == want(rows)
