import math
import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain(text, pieces):
    """Best splits of each word on its own, over all splits."""
    n_words = n_tokens = n_bytes = 0
    total = 0.0
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        w = T.MARK + w
        best = [(0.0, 0, 0)]
        for j in range(1, len(w) + 1):
            size = len(w[j - 1].encode())
            s, k, b = best[j - 1]
            options = [(s + size * pieces.lowest, 0, k + size, b + size)]
            for i in range(j):
                score = pieces.scores.get(w[i:j])
                if score is not None:
                    options.append((best[i][0] + score, j - i, best[i][1] + 1, best[i][2]))
            s, _, k, b = max(options)
            best.append((s, k, b))
        n_words, n_tokens, n_bytes, total = n_words + 1, n_tokens + best[-1][1], n_bytes + best[-1][2], total + best[-1][0]
    return n_words, n_tokens, n_bytes, total


EDGES = ["", None, "a", " a  b\tc ", "中文 é \U0001F600x", "a\0 a\0b \0", "x" * 47, "x" * 48, "y" * 300 + " yy", "the the there them theme", "▁▁ ▁"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    alphabet = "abcdeinorstuéü'.,中"
    return EDGES + [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(0, 60))) for _ in range(60)]


def same(got, want):
    assert tuple(got[:3]) == want[:3] and math.isclose(got[3], want[3], rel_tol=1e-9, abs_tol=1e-9)


def test_as_brute_force(texts):
    pieces = T.pieces_of(PATH)
    columns = T.count_texts(pa.array([t or "" for t in texts]), pieces)
    for i, text in enumerate(texts):
        same([c[i] for c in columns], plain(text, pieces))


def test_small_vocabulary_and_ties():
    pieces = T.Pieces({"a": -1.0, "b": -1.0, "ab": -2.0, "abc": -9.0, "c": -1.0, T.MARK: -0.5, T.MARK + "a": -1.5})
    texts = ["a", "ab", "abc", "cab", "zab", "aabbcc abcabc"]
    columns = T.count_texts(pa.array(texts), pieces)
    for i, text in enumerate(texts):
        same([c[i] for c in columns], plain(text, pieces))


def test_prefixes_are_scored_once(monkeypatch):
    """As many look-ups as the trie's nodes have prefixes to offer, not as the words have."""
    pieces = T.Pieces({"a": -1.0, "b": -1.1})
    asked = []
    find = pieces.table.find
    monkeypatch.setattr(pieces.table, "find", lambda keys: asked.append(len(keys)) or find(keys))
    words = sorted("a" * 30 + c for c in "bcdefgh")
    pieces.many(words)
    assert sum(asked) == 30 + 7


def test_table(spark, documents, texts):
    pieces = T.pieces_of(PATH)
    rows = list(enumerate(texts)) + [(0, "a"), (None, "the end"), (900, "word " * 50_000)]
    docs = documents(rows).withColumn("n_tokens", F.lit("clash"))
    out = T.count_tokens(docs, PATH).collect()
    assert [r.doc_id for r in out] == [r[0] for r in rows]
    for r, (_, text) in zip(out, rows):
        same((r.n_words, r.n_tokens, r.n_bytes, r.score), plain(text, pieces))
    assert T.count_tokens(docs.limit(0), PATH).count() == 0
