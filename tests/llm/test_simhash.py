import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vacantia.llm import simhash as S

MASK = (1 << 64) - 1


def plain_print(text, k=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(values, distance=3):
    """The least index reachable from each value."""
    group = list(range(len(values)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(values)), 2):
        if ((values[i] ^ values[j]) & MASK).bit_count() <= distance:
            a, b = sorted((root(i), root(j)))
            group[b] = a
    return [root(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_values(rng, groups, size, steps):
    """Chains of values a few bits apart, around random centres."""
    out = []
    for _ in range(groups):
        v = rng.getrandbits(64)
        for _ in range(size):
            out.append(v)
            for b in rng.sample(range(64), rng.choice(steps)):
                v ^= 1 << b
    return out


@pytest.mark.parametrize("text", ["", None, "a", "A b", "a b c", "x\x1fy \x85 É É z", "The the THE the", "a b c a b c a b c", "é " * 20_000])
def test_fingerprint(text):
    assert S.fingerprint_of(text, 3) & MASK == plain_print(text)


def test_spark_hash_agrees(spark):
    """The library's hash is the one of Spark's own function."""
    row = spark.sql("SELECT xxhash64('some words here') AS h").first()
    assert row.h & MASK == xxhash.xxh64_intdigest(b"some words here", 42)


@pytest.mark.parametrize("settings", [S.Linking(), S.Linking(cell_rows=8), S.Linking(parts=8), S.Linking(parts=5), S.Linking(distance=5)])
def test_links_as_brute_force(spark, settings):
    rng = random.Random(settings.parts * 100 + settings.cell_rows + settings.distance)
    values = sorted({signed(v) for v in near_values(rng, 12, 9, [1, 2, 3, 4, 6]) + [0, MASK, 1]})
    prints = spark.createDataFrame([(v,) for v in values], "print bigint")
    got = {r.node: r.root for r in S.components(S.links(prints, settings)).collect()}
    want = plain_groups(values, settings.distance)
    assert {v: got.get(v, v) for v in values} == {v: min(u for u, h in zip(values, want) if h == g) for v, g in zip(values, want)}


@pytest.mark.parametrize("thresholds", [[3, -1, -1, -1], [1, 1, -1, -1], [0, 1, 0, -1], [2, 0, -1, -1], [0, 0, 0, 0]])
def test_any_allotment_finds_all(spark, monkeypatch, thresholds):
    """Whatever thresholds the program picks, as long as the sum of t + 1 is four."""
    rng = random.Random(9)
    values = sorted({signed(v) for v in near_values(rng, 6, 5, [1, 2, 3])})
    monkeypatch.setattr(S, "allot", lambda costs, units: [t + 1 for t in thresholds])
    prints = spark.createDataFrame([(v,) for v in values], "print bigint")
    got = {r.node: r.root for r in S.components(S.links(prints, S.Linking(cell_rows=10))).collect()}
    want = plain_groups(values)
    assert {v: got.get(v, v) for v in values} == {v: min(u for u, h in zip(values, want) if h == g) for v, g in zip(values, want)}


def test_allot_is_the_least_cost():
    rng = random.Random(1)
    costs = [[0.0, *sorted(rng.random() for _ in range(4))] for _ in range(4)]
    all_ = [u for u in np.ndindex(5, 5, 5, 5) if sum(u) == 4]
    assert S.allot(costs, 4) == list(min(all_, key=lambda u: sum(c[k] for c, k in zip(costs, u))))


def test_candidates_by_threshold():
    counts = np.zeros(8)
    counts[[0, 1, 7]] = 2, 3, 5
    pairs = [(a, b, (a ^ b).bit_count()) for a in range(8) for b in range(8)]
    want = [sum(counts[a] * counts[b] for a, b, d in pairs if d <= t) for t in range(4)]
    assert S.candidates_by_threshold(counts, 3, 3) == want


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 61] = 1 - bits[:, 17]
    x = np.column_stack([bits, np.ones(2000, int)])
    parts = S.correlated_parts(x.T @ x, 4)
    at = {b: i for i, p in enumerate(parts) for b in p}
    assert sorted(at) == list(range(64)) and {len(p) for p in parts} == {16}
    assert at[40] == at[3] and at[61] == at[17]


def test_dense_group_gives_few_links(spark):
    """Hundreds of values all near each other give no more links than cells have rows."""
    base = 0x123456789ABCDEF
    values = [signed(base ^ (1 << a) ^ (1 << b)) for a, b in combinations(range(30), 2)]
    prints = spark.createDataFrame([(v,) for v in values], "print bigint")
    links = S.links(prints, S.Linking(cell_rows=64))
    assert links.count() <= 4 * len(values) * (len(values) // 64 + 1)
    assert {r.root for r in S.components(links).collect()} == {min(values)}


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    nodes = rng.sample(range(-500, 500), 200)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])) + [(1000, 1001), (1001, 1000), (5000, 5000)], "a bigint, b bigint")
    roots = {r.node: r.root for r in S.components(edges).collect()}
    assert roots == {**{n: min(nodes) for n in nodes}, 1000: 1000, 1001: 1000}


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for g in range(12):
        w = words(rng, 300)
        for c in range(rng.randrange(1, 7)):
            v = list(w)
            for _ in range(c % 3):
                v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
    texts = out + ["", None, " \t ", "one", "one two", "One", out[0], out[0].upper()]
    rng.shuffle(texts)
    return [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "no copy of this one " * 9)] + [(0, texts[0])]


def test_table(spark, documents, rows):
    df = documents(rows).withColumn("component_id", F.lit("clash"))
    got = sorted(((r.doc_id, r["print"] & MASK, r.component_id) for r in S.near_copies(df).collect()), key=str)
    values = [plain_print(t) for _, t in rows]
    groups = plain_groups(values)
    ids = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            ids[g] = min(i, ids.get(g, i))
    assert got == sorted(((i, v, ids.get(g)) for (i, _), v, g in zip(rows, values, groups)), key=str)
    hexes = {r.x for r in S.near_copies(df).select(S.print_hex(F.col("print")).alias("x")).collect()}
    assert hexes == {f"{v:016x}" for v in values}


def test_keep_first(spark, documents, rows):
    df = documents(rows)
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    groups = plain_groups([plain_print(t) for _, t in rows])
    names = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            names[g] = min(i, names.get(g, i))
    want = sorted(names.values()) + [None] * sum(g not in names for (i, _), g in zip(rows, groups))
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == want


def test_empty_table(spark, documents, rows):
    assert S.near_copies(documents(rows).limit(0)).count() == 0
    assert S.keep_first(documents(rows).limit(0)).count() == 0


def test_keep_first_judges_rows_by_their_text(spark, documents):
    """Texts that share an id, or have none, are documents of their own; equal rows are one."""
    a, b, c, d, e = (" ".join(f"{w}{i * i}" for i in range(60)) for w in ("alpha", "beta", "gamma", "delta", "eps"))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, d), (None, e), (None, e), (None, a), (4, d), (4, d), (None, None), (5, "")]
    kept = S.keep_first(documents(rows).repartition(3)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(1, a), (2, b), (3, c), (3, d), (None, e), (5, "")], key=str)


def test_keep_first_with_clashing_columns(spark, documents):
    docs = documents([(2, "x y z w"), (1, "x y z w"), (9, "other words here now")])
    docs = docs.withColumns({"print": F.lit("p"), "root": F.lit(1), "first": F.lit(2), "n": F.lit(3)})
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 9]
