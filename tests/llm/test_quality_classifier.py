import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.llm import quality_classifier as C

SMALL = C.Boosting(fit_rows=300, rounds=15, pair_rounds=8, bags=2)


def test_small_tree_is_the_best_first_cut():
    rng = np.random.default_rng(0)
    g, h = rng.normal(size=12), rng.random(12) + 0.1
    tree = C.small_tree(g, h, 2, 1.0)
    worth = {c: g[:c].sum() ** 2 / (h[:c].sum() + 1) + g[c:].sum() ** 2 / (h[c:].sum() + 1) for c in range(1, 12)}
    c = max(worth, key=worth.get)
    assert np.allclose(tree, [g[:c].sum() / (h[:c].sum() + 1)] * c + [g[c:].sum() / (h[c:].sum() + 1)] * (12 - c))


def test_pairs_find_an_interaction():
    """y depends on the product of two features alone: tables of single features can't tell, the pair's table can."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, len(C.FEATURES)))
    y = (x[:, 2] * x[:, 5] > 0).astype(float)
    edges = [C.bin_edges(c, 16) for c in x.T]
    s = C.Boosting(rounds=5, pair_rounds=20, pairs=2)
    model = C.fit(x, y, edges, edges, s)
    assert (2, 5) in model.pairs
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    alone = C.fit(x, y, edges, edges, C.Boosting(rounds=5, pair_rounds=0))
    assert ((alone.score(x) >= 0.5) == y).mean() < 0.7


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, len(C.FEATURES)))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    edges = [C.bin_edges(c, 8) for c in x.T]
    model = C.fit(x, y, edges, edges, C.Boosting(rounds=4, pair_rounds=2))
    for row, got in zip(x[:20], model.score(x[:20])):
        total = model.intercept + sum(t[int((e <= v).sum())] for e, t, v in zip(model.edges, model.tables, row))
        total += sum(t[int((edges[a] <= row[a]).sum()), int((edges[b] <= row[b]).sum())] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert np.isclose(got, 1 / (1 + np.exp(-total)))


def test_features_do_not_depend_on_neighbours():
    texts = ["Plain words here.", "", "AAA!! BBB!!\nAAA!! BBB!!", "a | b | c", "é" * 100, "1 2 3 $$$ %%%"]
    whole = C.features_of(pa.array(texts))
    assert np.isfinite(whole).all()
    for t, row in zip(texts, whole):
        assert np.allclose(C.features_of(pa.array([t]))[0], row)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    good, bad = [], []
    for i in range(200):
        w = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(60)]
        good.append((2 * i, " ".join(w) + "."))
        bad.append((2 * i + 1, " ".join(x.upper() + "!!" if i % 2 else x + "%%" for x in w)))
    return good + bad


def test_held_out_accuracy(spark, documents, rows):
    docs = documents(rows + [(1000, None), (1001, ""), (None, "no id"), (1000, None), (1002, "long " * 50_000)]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 2 == 0), None) for i, _ in rows] + [(0, 1, 0), (None, 1, 0), (1002, None, 1), (7, 5, 0)],
                                   "doc_id bigint, quality int, toxic int")
    out = C.score_quality(docs, labels, SMALL).collect()
    assert len(out) == len(rows) + 5
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    unseen = [r for r in out if r.held_out and r.doc_id < 1000]
    assert len(unseen) > 50 and sum(r.predicted == (r.doc_id % 2 == 0) for r in unseen) / len(unseen) > 0.97


def test_held_out_labels_are_not_read(spark, documents, rows):
    docs = documents(rows)
    true = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows], "doc_id bigint, quality int")
    false = true.withColumn("quality", F.when(C.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in C.score_quality(docs, labels, SMALL).collect()} for labels in (true, false))
    assert a == b


def test_without_labels(spark, documents, rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in C.score_quality(documents(rows[:5]), none, SMALL).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id bigint, quality int")
    assert all(r.predicted == 1 for r in C.score_quality(documents(rows[:5]), one, SMALL).collect())
    assert C.score_quality(documents(rows[:5]).limit(0), one, SMALL).count() == 0


def test_sample_is_the_rows_of_least_hash(spark):
    known = spark.range(20_000).select(F.col("id").alias("doc_id"))
    hashed = sorted((r.h, r.doc_id) for r in known.select("doc_id", F.xxhash64("doc_id").alias("h")).collect())
    for n in (1, 100, 19_990, 30_000):
        sample = C.least_hashes(known, n)
        assert sorted(r.doc_id for r in sample.collect()) == sorted(d for _, d in hashed[:n])
    assert C.least_hashes(known.limit(0), 5).count() == 0


def test_of_several_texts_under_one_id_the_same_is_used(spark):
    docs = [(i % 50, f"word{i} " * (i + 1) + "." * (i % 7)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int")
    models = [C.fit_on(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), labels, SMALL) for rows in (docs, docs[::-1])]
    assert models[0].intercept == models[1].intercept
    assert all((a == b).all() for a, b in zip(models[0].tables, models[1].tables))
