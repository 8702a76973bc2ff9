import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """docs, items: (id, text). Rows (item_id, rank, doc_id, score)."""
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    N, L = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c, n in counted:
            m = 25 + 75 * n * N // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, settings=R.Searching()):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit(1), "term": F.lit("x"), "part": F.lit(2)})
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"item": F.lit(1), "times": F.lit(2)})
    got = R.rank_documents(d.repartition(3), i, settings=settings)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)] + ["Ünï", "É", "日本"]
    docs = [(i * 7 % 1009, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    docs += [(2000 + i, docs[5][1]) for i in range(50)]  # copies
    docs += [(None, docs[5][1]), (None, "w3 w3"), (3000, None), (3001, ""), (3002, "!? --"), docs[0], docs[1]]
    docs += [(3003, "w1," * 3000 + "W2;w9" * 40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(20)]
    items += [(50, None), (51, "nowhere"), (None, "w1 w2"), (3, "w7"), (3, "w8 W8 w8"), items[0], (60, docs[5][1]), (61, "")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("settings", [R.Searching(), R.Searching(shard_docs=40, items_at_once=4, splits=3)])
def test_as_brute_force(spark, settings):
    docs, items = corpus(1)
    want = plain(docs, items)
    assert found(spark, docs, items, settings) == want and len(want) > 150


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, "a"), (2, "b")], [(1, "a b")]) == plain([(1, "a"), (2, "b")], [(1, "a b")])


def test_long_texts_in_pieces(monkeypatch):
    text = ("Ab1 é-" * 5000) + "x" * 3000 + " end"
    want = Counter(t.encode() for t in terms(text))
    assert R.count_terms(text) == want
    monkeypatch.setattr(R, "PIECE", 7)
    assert R.count_terms(text) == want
    assert R.count_terms("x" * 5_000_000) == {b"x" * 5_000_000: 1}


def test_sparse_table_and_early_end():
    rng = np.random.default_rng(3)
    docs, lists = 4000, 12
    held = [np.sort(rng.choice(docs, rng.integers(1, 2500), replace=False)) for _ in range(lists)]
    term, doc = np.concatenate([np.full(len(h), i) for i, h in enumerate(held)]), np.concatenate(held)
    impact = (rng.pareto(1.2, len(doc)) * 1000).astype(np.int64) + 1
    shard = R.Shard(term, doc, impact, docs, lists)
    dense = np.zeros((lists, docs), np.int64)
    dense[term, doc] = impact
    for _ in range(50):
        a, b = sorted(rng.integers(0, docs + 1, 2).tolist())
        value, at = shard.largest(np.arange(lists), np.array([a]), np.array([b]))
        assert value[:, 0].tolist() == [int(x[a:b].max(initial=0)) for x in dense]
    times = rng.integers(1, 3, lists)
    best, made = shard.search(np.arange(lists), times, 10, 8)
    scores = (dense * times[:, None]).sum(axis=0)
    want = sorted(zip((-scores).tolist(), range(docs)))[:10]
    assert best == [(-s, d) for s, d in want] and made < docs / 4


def test_ties_end_early():
    """Thousands of equal documents: the first ids are found without scoring all."""
    docs = 5000
    shard = R.Shard(np.zeros(docs, np.int64), np.arange(docs), np.full(docs, 9, np.int64), docs, 1)
    best, made = shard.search(np.array([0]), np.array([2]), 10, 64)
    assert best == [(18, d) for d in range(10)] and made < 300
