import zlib
from collections import Counter

from pyspark.sql import functions as F

from vacantia.llm import sharding as H

ROWS = [(i, "text " * (i % 9)) for i in range(4000)] + [(5, "text " * 5), (None, "x"), (None, None), (9001, ""), (9002, "é")]


def manifest(docs, shards=40, **more):
    return H.shard_manifest(docs, [1.0] * shards, **more)


def test_manifest(spark, documents):
    df = documents(ROWS).withColumn("shard", F.lit("clash"))
    rows = manifest(df).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS), key=str)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert set(by_shard) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) < 2 * len(ROWS) / 40


def test_one_more_shard_takes_rows_only_into_itself(spark, documents):
    docs = documents(ROWS)
    old = manifest(docs).collect()
    grown = Counter((r.doc_id, r.shard) for r in manifest(docs, 41).collect())
    assert all(r.grown_shard in (r.shard, 40) for r in old)
    assert Counter((r.doc_id, r.grown_shard) for r in old) == grown
    moved = sum(r.grown_shard == 40 for r in old)
    assert 0.5 * len(old) / 41 < moved < 2 * len(old) / 41


def test_shard_depends_on_the_key_alone(spark, documents):
    docs = documents(ROWS)
    whole = {r.doc_id: r.shard for r in manifest(docs).collect()}
    part = manifest(docs.where("doc_id % 3 = 0").repartition(5).withColumn("text", F.lit("other"))).collect()
    assert all(whole[r.doc_id] == r.shard for r in part)


def test_weights(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"))
    counts = Counter(r.shard for r in H.assign_shards(df, "k", [1.0, 2.0, 5.0]).collect())
    assert abs(counts[2] / 20_000 - 5 / 8) < 0.02 and abs(counts[0] / 20_000 - 1 / 8) < 0.02


def test_slots_in_buckets(spark, documents):
    placed = H.assign_shards(documents(ROWS).select("doc_id"), "doc_id", [1.0] * 3)
    slots = {}
    for r in H.with_slots(placed, ["doc_id"], bucket_rows=50).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_rows_are_numbered_in_pieces(spark, documents):
    hot = [(None, "")] * 900 + [(7, "x")] * 700 + [(i, "y") for i in range(8, 900)]
    placed = H.assign_shards(documents(hot).select("doc_id"), "doc_id", [1.0] * 3)
    groups = H.dealt(placed, ["doc_id"], 50).groupBy("shard", "__bucket", "__heavy", "__piece").count().collect()
    assert sum(r["count"] for r in groups) == len(hot) and max(r["count"] for r in groups) <= 150
    assert sum(r["__heavy"] != 0 for r in groups) >= 30
    out = H.with_slots(placed, ["doc_id"], bucket_rows=50)
    assert sorted(out.columns) == ["doc_id", "shard", "slot"]
    slots, kinds = {}, Counter()
    for r in out.collect():
        slots.setdefault(r.shard, []).append(r.slot)
        kinds[r.doc_id] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kinds == Counter(i for i, _ in hot)


def plain_shard(key, weights):
    """The scores by the library's own hash of (shard, key), their logarithm in plain Python."""
    import math

    import xxhash

    def hash64(shard):
        h = xxhash.xxh64(shard.to_bytes(4, "little", signed=True), seed=42).intdigest()
        return h if key is None else xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=h).intdigest()

    return max(((w / -math.log(((hash64(i) >> 12) + 0.5) / 2**52)), i) for i, w in enumerate(weights))[1]


def test_shards_by_brute_force(spark, documents):
    weights = [1.0, 2.0, 0.5, 1.0, 3.0]
    df = documents([(i, "") for i in range(2000)] + [(None, "")])
    got = H.assign_shards(df.select("doc_id"), "doc_id", weights, grown_by=2.0).collect()
    assert [(r.doc_id, r.shard, r.grown_shard) for r in got] == [
        (r.doc_id, plain_shard(r.doc_id, weights), plain_shard(r.doc_id, [*weights, 2.0])) for r in got]


def test_empty_table_and_files(spark, documents, tmp_path):
    assert manifest(documents(ROWS).limit(0)).count() == 0
    H.write_shards(documents(ROWS), "doc_id", [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and back.select("shard").distinct().count() == 4
