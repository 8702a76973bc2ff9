import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import merkle as M


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """The root, and the siblings of each leaf with their side."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for path, i in zip(paths, at):
            other = i ^ 1
            path.append((bool(i & 1), level[other] if other < len(level) else None))
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def plain_report(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0], plain_leaf(*r), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    built = {k: plain_tree([leaf for _, leaf, _ in trees[k]]) for k in names}
    root, outer = plain_tree([built[k][0] for k in names])
    out = []
    for k, above in zip(names, outer):
        for (doc_id, leaf, r), path in zip(trees[k], built[k][1]):
            path = path + above
            d = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and r[4] is not None:
                d = plain_leaf(*r[:4], r[4] + 1)
            for left, s in path:
                d = H(d) if s is None else H(s, d) if left else H(d, s)
            out.append((doc_id, leaf, built[k][0], root, H(*(s for _, s in path if s is not None)), d, d == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 37, "de": 1, None: 5, "é": 3, "zz": 16}])
@pytest.mark.parametrize("bits", [2, 10])
def test_report_as_brute_force(spark, documents, sizes, bits, monkeypatch):
    monkeypatch.setattr(M.build_manifest, "__kwdefaults__", {"bits": bits})
    rng, rows, i = random.Random(1), [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i * 31 % 101, rng.choice(["a", "", None, "é" * 50, "x y"]), lang, rng.choice(["s", None]), rng.choice([3, None, 7])))
            i += 1
    rows += rows[:2] + [(None, "t", "en", "s", 1), (None, None, "en", "s", 1), (None, "t", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumns({"tree": F.lit(1), "digest": F.lit("x"), "index": F.lit(0), "n": F.lit(2), "path": F.lit("p")})
    got = M.manifest_report(docs.repartition(3))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain_report(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(not r[-1] for r in want) or len(rows) < 12


def test_empty_table(spark, documents):
    assert M.manifest_report(documents([])).count() == 0


def test_log_is_in_order_of_completion(spark):
    """Positions are gapless, and each node follows its children's subtrees."""
    for n in (1, 2, 3, 21, 64, 100):
        leaves = spark.createDataFrame([("t", n, i, H(str(i))) for i in range(n)], "tree string, n bigint, index bigint, digest string")
        log, tallest = M.append_log(leaves, 3)
        rows = sorted(log.collect(), key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(len(rows)))
        done, nodes = [], {}
        for r in rows:
            nodes[r.height, r["index"]] = r.digest
            if r.height:
                children = [nodes[r.height - 1, j] for j in (2 * r["index"], 2 * r["index"] + 1) if (r.height - 1, j) in nodes]
                assert r.digest == H(*children)
            done.append((r.height, r["index"]))
            size = int(M.subtree_size(r.height, np.array([r["index"]]), n)[0])
            inside = done[-size:]
            assert all(i >> (r.height - h) == r["index"] for h, i in inside) and len(inside) == size
        assert nodes[tallest, 0] == plain_tree([H(str(i)) for i in range(n)])[0] == M.roots(log).first().digest


def test_long_texts_and_a_hot_language(spark):
    rows = [(i, "w " * (10 if i else 2_000_000), "en" if i % 3 else "de", "s", 5) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(map(tuple, M.manifest_report(docs).collect()), key=str) == plain_report(rows)


def test_largest_number_of_characters(spark, documents):
    rows = [(i, "t", "en", "s", (1 << 63) - 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r.verified for r in M.manifest_report(docs).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 != 0 for i in range(20)}
