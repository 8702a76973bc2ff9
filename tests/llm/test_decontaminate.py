import re

import pytest
from pyspark.sql import functions as F

from vacantia.llm import decontaminate as D


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, span=10):
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(len(v), span)
            windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item))
        out[doc_id] = (len(w), len(hit), sorted(found))
    return out


PASSAGE = "the quick brown Fox jumps over a lazy dog while Émile watches it from the old stone wall"
ITEMS = [(7, PASSAGE), (12, PASSAGE + " and smiles"), (3, "only three words"), (4, ""), (5, None), (6, "one"),
         (8, "a b a b a b a b a b a b a b"), (9, "seven words make this a short item"), (10, PASSAGE)]
DOCS = [(1, f"intro text {PASSAGE.upper().replace('É', 'é')} outro"), (2, PASSAGE.replace("É", "é")), (3, PASSAGE), (4, None), (5, ""),
        (6, "  ...  "), (7, "There are ONLY, three; words here"), (8, " ".join("a b".split() * 40)),
        (9, " ".join(PASSAGE.split()[:10]) + " x " + " ".join(PASSAGE.split()[5:15])), (10, " ".join(PASSAGE.split()[:9])),
        (11, "one " * 500), (12, PASSAGE + " " + PASSAGE), (13, "seven words make this a short item"), (14, "x " * 3000 + PASSAGE),
        (None, PASSAGE), (15, "a b c")]


def collected(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.items) for r in df.collect()}


@pytest.fixture
def tables(spark, documents):
    return documents(DOCS), spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("settings", [D.Winnowing(), D.Winnowing(1, 10), D.Winnowing(10, 1), D.Winnowing(6, 5)])
def test_as_brute_force(tables, settings):
    assert collected(D.decontaminate(*tables, settings)) == plain(DOCS, ITEMS)


def test_spans(tables):
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in D.decontaminate(*tables).collect()}
    assert spans[14] == [(3001, 18)] and spans[3] == [(1, 18)] and spans[5] == []
    n = len(PASSAGE.split())
    assert spans[12] == [(1, 2 * n)]


def test_report_and_ids(tables):
    docs, items = tables
    report = {r.doc_id: r for r in D.contamination_report(docs.withColumn("n_words", F.lit("clash")), items).collect()}
    assert report[3].contaminated and report[3].n_items == 3 and not report[4].contaminated
    want = {d for d, (_, hit, _) in plain(DOCS, ITEMS).items() if hit}
    assert {r.doc_id for r in D.contaminated_ids(docs, items).collect()} == want


def test_repeated_and_empty_tables(tables):
    docs, items = tables
    assert collected(D.decontaminate(docs.union(docs), items.union(items))) == plain(DOCS, ITEMS)
    assert D.decontaminate(docs.limit(0), items).count() == 0
    assert all(r.n_hit == 0 for r in D.decontaminate(docs, items.limit(0)).collect())


def test_hot_passage_and_random_texts(spark, documents):
    import random
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)]
    def text(n): return " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 30))) for i in range(25)]
    docs = [(i, text(rng.randrange(0, 200)) + (" " + items[0][1] if i % 3 == 0 else "")) for i in range(60)]
    got = collected(D.decontaminate(documents(docs), spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == plain(docs, items)


def test_main_path_has_no_python(tables):
    plan = D.contamination_report(*tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_winnowing_keeps_a_hash_of_every_shared_span(spark):
    df = spark.createDataFrame([(list(range(40)),), (list(range(13, 23)),)], "h array<bigint>")
    rows = [set(r[0]) for r in df.select(D.winnowed(D.gram_hashes(F.col("h"), 4), 7)).collect()]
    assert rows[0] & rows[1]
