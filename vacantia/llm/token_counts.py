"""Token counts of a unigram model, without writing tokens.

A text's words, each with a mark for the blank before it, are split into the pieces whose log probabilities add up to the
most. The best score of a word's prefix depends on the prefix alone, so words share it: distinct words go into a trie, each
node gets the best score and number of pieces of its prefix once, and the nodes where words end hold the counts. A text's
count is a sum over its words.

The pieces come from a vocabulary file whose scores are ranks; a piece of rank r has the probability of Zipf's law, 1 / (r + 1) by
their sum. A character may also be as many byte pieces as it has bytes in UTF-8, each less likely than any piece. Of splits that
score alike the one with the longer last piece counts.

A task builds the trie of the distinct words of some megabytes of text at a time, so nothing is shuffled and memory is
bounded.

Null and empty texts have no words and no tokens. Repeated rows are counted each for itself; other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.common import SlotTables, in_parts

MARK = "▁"
BYTE_SCORE = 5.0  # below the rarest piece
BYTES_AT_ONCE = 1 << 21
WIDTH = 48  # longer words are scored one by one
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
COUNTED = "struct<n_words: bigint, n_tokens: bigint, n_bytes: bigint, score: double>"


class Pieces:
    """Pieces and their scores, looked up by a 64-bit hash of their code points."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.lowest = min(scores.values(), default=0.0) - BYTE_SCORE
        keys = np.array([self._hash(s) for s in scores], np.uint64).view(np.int64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have one hash")
        self.table = SlotTables(keys, np.array(list(scores.values())), -np.inf)
        self.powers = BASE ** np.arange(self.longest + 1, dtype=np.uint64)

    @staticmethod
    def _hash(piece: str) -> int:
        out = 0
        for c in piece:
            out = (out * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return out

    def one(self, word: str) -> tuple[float, int, int]:
        """Score, pieces and byte pieces of a word. Of splits that score alike, the longer last piece counts."""
        best, pieces, raw = [0.0], [0], [0]
        for i in range(1, len(word) + 1):
            size = len(word[i - 1].encode())
            top, start, more, of_raw = best[i - 1] + size * self.lowest, i - 1, size, size
            for n in range(1, min(self.longest, i) + 1):
                score = self.scores.get(word[i - n:i])
                if score is not None and best[i - n] + score >= top:
                    top, start, more, of_raw = best[i - n] + score, i - n, 1, 0
            best.append(top)
            pieces.append(pieces[start] + more)
            raw.append(raw[start] + of_raw)
        return best[-1], pieces[-1], raw[-1]

    def many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for sorted distinct words of at most ``WIDTH`` characters, by a trie.

        Sorted words that share a prefix are neighbours, so a trie's node is a first word and a depth: the word has the node if
        its prefix of that depth is not one of the word before. Each depth scores its nodes side by side, and the other words
        with a node take its values over.
        """
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        width = int(lengths.max()) if n else 0
        points = np.zeros((n, width), np.uint32)
        points[np.arange(width)[None, :] < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        shared = np.zeros(n, np.int64)
        if n > 1:
            same = np.column_stack([points[1:] == points[:-1], np.zeros(n - 1, bool)])
            shared[1:] = np.minimum(np.argmin(same, axis=1), np.minimum(lengths[1:], lengths[:-1]))
        hashes = np.zeros((width + 1, n), np.uint64)
        best, pieces, raw = np.zeros((width + 1, n)), np.zeros((width + 1, n), np.int32), np.zeros((width + 1, n), np.int32)
        rows = np.arange(n)
        for d in range(1, width + 1):
            rows = rows[lengths[rows] >= d]
            new = shared[rows] < d
            nodes = rows[new]
            char = points[nodes, d - 1]
            size = (1 + (char >= 0x80).astype(np.int32) + (char >= 0x800) + (char >= 0x10000)).astype(np.int32)
            here = hashes[d - 1, nodes] * BASE + char.astype(np.uint64) + np.uint64(1)
            top = best[d - 1, nodes] + size * self.lowest
            count, of_raw = pieces[d - 1, nodes] + size, raw[d - 1, nodes] + size
            for k in range(1, min(self.longest, d) + 1):
                offer = best[d - k, nodes] + self.table.find((here - hashes[d - k, nodes] * self.powers[k]).view(np.int64))
                better = np.flatnonzero(offer >= top)
                top[better] = offer[better]
                count[better] = pieces[d - k, nodes[better]] + 1
                of_raw[better] = raw[d - k, nodes[better]]
            owner = np.cumsum(new) - 1
            for values, of_nodes in ((hashes, here), (best, top), (pieces, count), (raw, of_raw)):
                values[d, rows] = of_nodes[owner]
        at = (lengths, np.arange(n))
        return best[at], pieces[at], raw[at]


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log probabilities of pieces from their order."""
    ranks = np.arange(1, len(pieces) + 1)
    logs = -np.log(ranks) - np.log((1 / ranks).sum())
    return dict(zip(pieces, logs.tolist()))


@cache
def pieces_of(path: str) -> Pieces:
    """One per worker and vocabulary. Control and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return Pieces(zipf_scores([model.id_to_piece(i) for i in sorted(usual, key=lambda i: (-model.get_score(i), i))]))


def count_texts(texts: pa.Array, pieces: Pieces) -> list[np.ndarray]:
    """n_words, n_tokens, n_bytes and score of each text."""
    split = pc.ascii_split_whitespace(texts)
    of = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    coded = split.flatten().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    words = [MARK + w if w else "" for w in coded.dictionary.take(pa.array(order)).to_pylist()]
    results = np.zeros((3, len(words)))
    short = np.array([0 < len(w) <= WIDTH for w in words], bool)
    results[:, short] = pieces.many([w for w, s in zip(words, short.tolist()) if s])
    for i in np.flatnonzero(~short):
        results[:, i] = pieces.one(words[i])
    by_code = np.zeros((3, len(words)))
    by_code[:, order] = results
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = np.zeros(len(words), bool)
    real[order] = [bool(w) for w in words]
    sums = [np.bincount(of, v[codes], len(texts)) for v in (real, by_code[1], by_code[2])]
    return [*(v.astype(np.int64) for v in sums), np.bincount(of, by_code[0][codes], len(texts))]


def token_counts(text: Column, path: str) -> Column:
    """struct(n_words, n_tokens, n_bytes, score): words, tokens, those of them that are bytes, and the log probability."""
    @F.arrow_udf(COUNTED)
    def count(texts: pa.Array) -> pa.Array:
        parts = [count_texts(part, pieces_of(path)) for part in in_parts(texts, BYTES_AT_ONCE)]
        columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(4)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.StructArray.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)],
                                          ["n_words", "n_tokens", "n_bytes", "score"])

    return count(text)


def count_tokens(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts of each row."""
    return docs.select(doc, token_counts(F.col(text), path).alias("__c")).select(doc, "__c.*")
