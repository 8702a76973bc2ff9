import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vacantia.llm import quality_rules as Q


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def plain_bucket(x):
    drop = max(x.bit_length() - 6, 0)
    return x >> drop << drop


def plain_kept(rows, rules=Q.Rules()):
    """kept for each (text, lang, source)."""
    counted, measured = [plain_counts(t) for t, _, _ in rows], []
    for c in counted:
        n, lines = c["n_words"], c["n_lines"]
        failed = n < rules.least_words or 100 * c["n_repeat_words"] > rules.most_repeats * n
        measured.append((failed, {} if not n else {
            "symbols": 1000 * c["n_symbols"] // n, "repeats": 1000 * c["n_repeat_words"] // n,
            "dup_lines": 1000 * c["n_dup_lines"] // lines, "word_length": 100 * c["word_chars"] // n}))
    groups = defaultdict(list)
    for (failed, m), (_, lang, source) in zip(measured, rows):
        if not failed:
            for key in ((lang, source), (lang,), ()):
                groups[key].append(m)

    def limits(key):
        return {k: (sorted(plain_bucket(m[k]) for m in groups[key])) for k in Q.MEASURES}

    out = []
    for (failed, m), (_, lang, source) in zip(measured, rows):
        key = next((k for k in ((lang, source), (lang,)) if len(groups[k]) >= rules.least_rows), ())
        ok = not failed
        if ok:
            for k, values in limits(key).items():
                n = len(values)
                q1, q3 = values[-(-n // 4) - 1], values[-(-3 * n // 4) - 1]
                reach = rules.reach * max(q3 - q1, getattr(rules, f"floor_{k}"))
                ok = ok and m[k] <= q3 + reach and (k != "word_length" or m[k] >= q1 - reach)
        out.append(ok)
    return out


EDGES = ["", None, " \n\t ", "a", "a b c a b c", "x\n\nx\n x\nx", "\x1fa \x85b\x0bc é中", "a a a a", "# | <b>\n# | <b>", "a b\nc a b c\n", "\n" * 50]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(300):
        w = [rng.choice("abcdefghij") * rng.randrange(1, 9) + str(rng.randrange(99)) for _ in range(rng.randrange(30, 90))]
        kind = i % 15
        if kind == 1:
            w = [x + "%&" for x in w]
        if kind == 2:
            w = w[:10] * 6
        if kind == 3:
            w = [x * 5 for x in w]
        text = " ".join(x + ("\n" if rng.random() < 0.1 else "") for x in w)
        out.append((text, rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 20}"))
    return out + [(t, "xx", None) for t in EDGES]


def test_counts(spark, documents, rows):
    texts = [r[0] for r in rows]
    df = documents(list(enumerate(texts))).withColumn("c", Q.base_counts(F.col("text")))
    for r in df.collect():
        assert r.c.asDict() == plain_counts(texts[r.doc_id]), texts[r.doc_id]


def test_small_parts_count_alike(monkeypatch, rows):
    import pyarrow as pa
    texts = pa.array([r[0] or "" for r in rows])
    whole = Q.count_texts(texts)
    halves = [Q.count_texts(texts[:100]), Q.count_texts(texts[100:])]
    assert all(whole[c].tolist() == halves[0][c].tolist() + halves[1][c].tolist() for c in Q.COUNTS)


@pytest.mark.parametrize("least_rows", [10, 100, 10_000])
def test_verdicts(spark, documents, rows, least_rows):
    rules = Q.Rules(least_rows=least_rows)
    df = documents([(i, *r) for i, r in enumerate(rows)]).withColumn("n_words", F.lit("clash")).withColumn("__pair", F.lit(1))
    got = {r.doc_id: r for r in Q.quality_verdicts(df, rules).collect()}
    want = plain_kept(rows, rules)
    assert [got[i].kept for i in range(len(rows))] == want
    assert 0 < sum(want) < len(rows)
    kept = Q.keep_good(df, rules)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, k in enumerate(want) if k]


def test_sketches_merge(spark, documents, rows):
    """Sketches of parts, added up, are the sketch of the whole."""
    df = Q.with_counts(documents([(i, *r) for i, r in enumerate(rows)]), Q.Rules())
    parts = Q.sketches(df.where("doc_id % 2 = 0")).union(Q.sketches(df.where("doc_id % 2 = 1")))
    keys = ["lang", "source", "measure", "bucket"]
    merged = parts.groupBy(*keys).agg(F.sum("n").alias("n"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, Q.sketches(df).collect()))


def test_bucket_error(spark):
    df = spark.range(0, 200_000, 7).select("id", Q.bucket(F.col("id")).alias("b"))
    bad = df.where((F.col("b") > F.col("id")) | ((F.col("id") - F.col("b")) * 32 > F.col("id")))
    assert bad.count() == 0 and [r.b for r in df.limit(5).collect()] == [plain_bucket(7 * i) for i in range(5)]


def test_empty_and_all_failing(spark, documents, rows):
    assert Q.quality_verdicts(documents([(1, "a")]).limit(0)).count() == 0
    assert not any(r.kept for r in Q.quality_verdicts(documents([(1, "few words"), (1, "few words"), (None, None)])).collect())
