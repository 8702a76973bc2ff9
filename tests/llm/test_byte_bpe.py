import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from vacantia.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.merger(PATH).ranks, special_tokens={})


def pieces(texts):
    for a, b in B._cuts(np.array([len(t.encode()) for t in texts]), B.CHUNK):
        run = texts[a:b]
        ids, offsets, per_text = B.merger(PATH).encode(run)
        data, stops = B.merger(PATH).decode(ids, offsets, per_text)
        ends = np.cumsum(per_text)
        for text, a, b, c, d in zip(run, ends - per_text, ends, [0, *stops[:-1]], stops):
            yield text, ids[a:b].tolist(), data[c:d].tobytes(), offsets[a:b]


EDGES = ["", " ", "'s", "'", "''s", "'re've'll'd'S", " 's", "\n's", "x's's", "'st", "'rest", "\0a\0", "a" * 5000, "  \n\t x", "x  ",
         "é" * 300, "<|endoftext|>", "\x85\x1c a", "12 34", "áb", "ſ'ſ", "\U0001F600" * 200]


def test_as_the_library(library):
    rng = random.Random(3)
    pool = "ab s'tredlvm' \t\n  12é 　中!?.…ſK'\x85\x1c\U0001F600"
    texts = EDGES + ["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(3000)]
    for text, ids, data, offsets in pieces(texts):
        assert ids == library.encode_ordinary(text), text
        assert data == text.encode()
        assert [len(B.merger(PATH).tokens[i]) for i in ids[:-1]] == np.diff(offsets).tolist()


def test_classes_of_code_points(library):
    """A letter, number, blank or other at each place in the tables changes the ids of a text around it."""
    texts = [f"x{chr(c)}1{chr(c)} {chr(c)}" for c in range(0x20000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    texts += [f"x{chr(c)}1{chr(c)}" for r in (*B.LETTERS_16, *B.NUMBERS_16) for c in (r[0], r[1])]
    for text, ids, _, _ in pieces(texts):
        assert ids == library.encode_ordinary(text), ascii(text)


def test_scan_is_the_automaton():
    rng = np.random.default_rng(0)
    for n in (1, 2, 255, 256, 257, 70_000):
        symbols = rng.integers(0, 9, n)
        of_symbol, _, leads, _ = B.monoid()
        state, want = B.FRESH, []
        for s in symbols:
            state = B._step(state, s)[0]
            want.append(state)
        assert leads[B._scan(of_symbol[symbols]), B.FRESH].tolist() == want


def test_table(spark, documents, library):
    rows = [(1, "It's 20 o'clock"), (2, None), (3, ""), (3, ""), (None, "x" * 70_000 + " end"), (4, "It's 20 o'clock")]
    df = documents(rows).withColumn("ids", F.lit("clash"))
    out = B.encode_table(df, PATH).collect()
    assert [r.ids for r in out] == [library.encode_ordinary(r[1] or "") for r in rows]
    assert out[0].lang == "en" and out[0].offsets[0] == 0
    digests = B.round_trip_digests(df, PATH).collect()
    import hashlib
    for r, (doc_id, text) in zip(digests, rows):
        ids = library.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens) == (doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert B.round_trip_digests(df.limit(0), PATH).count() == 0


def test_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(B, "CACHED", 5)
    own = B.Merger(PATH)
    for i in range(4):
        ids, _, _ = own.encode([f"alpha beta gamma delta {i} epsilon zeta eta theta"])
        assert ids.tolist() == library.encode_ordinary(f"alpha beta gamma delta {i} epsilon zeta eta theta")
        assert len(own.known) <= 16
