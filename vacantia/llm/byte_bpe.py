"""Byte-level BPE: texts to token ids and back.

Pre-tokens are found without a regular expression. Every code point gets a symbol from a class array and its neighbours.
A symbol is a function from scanner state to scanner state; the functions form a small monoid, so an associative scan
of its multiplication table gives the state before each character, and with it where pre-tokens start. The slices go
through a cache to pair merging. Offsets of the tokens are kept; decoding puts the bytes back by them.

A null text counts as empty: no ids. Row order, repeated rows and further columns stay as they are.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.llm.common import SlotTables, give_back, held, sha256_hex

# Letters and numbers that Unicode 16 has beyond the 15.1 of Python's tables, as (first, last).
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
# The code points with the property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000)

# Symbols. GLUE is the last blank of a run before a word, which starts that word; LONE another last white space, which
# stands alone; SHORT and LONG an apostrophe before one or two letters of a contraction; BREAK parts two texts.
LETTER, NUMBER, OTHER, SPACE, GLUE, LONE, SHORT, LONG, BREAK = range(9)
# States: what the open pre-token is, or FRESH if the next character starts one. ONE, TWO: letters left of a contraction.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, GLUED, ONE, TWO = range(8)

CHUNK = 1 << 19  # bytes of text scanned at a time
BLOCK = 256
CACHED = 100_000  # pre-tokens whose ids a worker keeps
CACHED_BYTES = 8 << 20  # of these pre-tokens
FAR = 1 << 30


@cache
def class_array() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE for each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            out[first:last + 1] = kind
    out[list(WHITE_SPACE)] = SPACE
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether the character starts a pre-token."""
    if symbol == LETTER:
        if state in (ONE, TWO):
            return (FRESH, False) if state == ONE else (ONE, False)
        return IN_LETTERS, state not in (IN_LETTERS, GLUED)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, GLUED)
    if symbol == SPACE:
        return IN_SPACE, state != IN_SPACE
    if symbol == GLUE:
        return GLUED, True
    if symbol in (LONE, BREAK):
        return FRESH, True
    goes_on = state in (IN_OTHERS, GLUED)  # OTHER, or an apostrophe
    if symbol == OTHER or goes_on:
        return IN_OTHERS, not goes_on
    return (ONE if symbol == SHORT else TWO), True


@cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions closed under composition.

    Returns the element of each symbol, the product table (first the row's function, then the column's), the state each
    element leads to from each state, and whether a symbol starts a pre-token in a state.
    """
    states, symbols = range(8), range(9)
    base = [tuple(_step(q, s)[0] for q in states) for s in symbols]
    found = {f: i for i, f in enumerate(dict.fromkeys(base))}
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in base:
            h = tuple(g[q] for q in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    elements = list(found)
    product = np.array([[found[tuple(g[q] for q in f)] for g in elements] for f in elements], np.uint8)
    starts = np.array([[_step(q, s)[1] for s in symbols] for q in states])
    return (np.array([found[f] for f in base], np.uint8), product, np.array(elements, np.uint8), starts)


def _scan(elements: np.ndarray) -> np.ndarray:
    """Inclusive products: inside blocks, side by side, then over the blocks' totals."""
    _, product, _, _ = monoid()
    n = len(elements)
    if n <= BLOCK:
        out = elements.copy()
        for i in range(1, n):
            out[i] = product[out[i - 1], out[i]]
        return out
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = elements
    inside = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    for i in range(1, BLOCK):
        inside[i] = product[inside[i - 1], inside[i]]
    before = _scan(inside[-1])[:-1]
    inside[:, 1:] = product[before[None, :], inside[:, 1:]]
    return inside.T.reshape(-1)[:n]


def pretoken_starts(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Positions where a pre-token starts; ``breaks`` are the positions that part texts, and start one each."""
    of_symbol, _, leads, starts = monoid()
    kinds = class_array()[points]
    kinds[breaks] = BREAK
    after = np.append(kinds[1:], BREAK)
    last = (kinds == SPACE) & (after <= OTHER)
    symbols = kinds.copy()
    symbols[last] = LONE
    symbols[last & (points == 0x20)] = GLUE
    quotes = np.flatnonzero((points == 0x27) & (kinds == OTHER))
    one = points[np.minimum(quotes + 1, len(points) - 1)]
    two = points[np.minimum(quotes + 2, len(points) - 1)]
    symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    symbols[quotes[pairs]] = LONG
    state = np.empty(len(points), np.uint8)
    state[0] = FRESH
    state[1:] = leads[_scan(of_symbol[symbols])[:-1], FRESH]
    return np.flatnonzero(starts[state, symbols])


class Merger:
    """Ids of pre-tokens by pair merging, kept for the pre-tokens seen before."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.single_array = np.array(self.single, np.int64)
        pairs, made = array("q"), array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 20 | right)
                    made.append(rank)
        self.table = SlotTables(np.array(pairs, np.int64), np.array(made, np.int64), FAR)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.flat_starts = np.cumsum(self.lengths) - self.lengths
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.ids, self.ends = array("i"), array("q", [0])

    def learn(self, pieces: list[bytes]) -> None:
        """Merge pre-tokens not seen before, and number them."""
        whole, short, long = [], [], []
        for p in pieces:
            (whole if p in self.ranks else short if len(p) <= 100 else long).append(p)
        if short:
            ids, ends = self._merge_short(short)
            self._add(short, ids, ends)
        for p in long:
            ids = self._merge_long([self.single[b] for b in p])
            self._add([p], np.array(ids, np.int32), np.array([len(ids)]))
        if whole:
            self._add(whole, np.array([self.ranks[p] for p in whole], np.int32), np.arange(1, len(whole) + 1))

    def _add(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        before = len(self.known)
        self.known_bytes += sum(map(len, pieces))
        self.known.update(zip(pieces, range(before, before + len(pieces))))
        self.ends.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, FAR where it is no token."""
        return self.table.find(left << 20 | right)

    def _merge_short(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces side by side: in each, the pair of lowest rank, leftmost first, is merged until none is left.

        Returns the ids in the order of the pieces, and where each piece's ids end.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.single_array[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ranks = np.full(len(ids), FAR, np.int64)  # of each id with its right neighbour
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner] = self.pair_ranks(ids[inner], ids[inner + 1])
        done_ids, done_owner = [], []
        while len(ids):
            firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), firsts)
            ended = best >> 32 >= FAR
            if ended.any():
                over = np.repeat(ended, np.diff(np.append(firsts, len(ids))))
                done_ids.append(ids[over])
                done_owner.append(owner[over])
                ids, owner, ranks = ids[~over], owner[~over], ranks[~over]
                continue
            at = best & 0xFFFFFFFF
            ids[at] = best >> 32
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # one id to the left of each merge of an earlier piece is gone
            ids, owner, ranks = ids[stay], owner[stay], ranks[stay]
            for i in (at, at - 1):
                j = np.minimum(i + 1, len(ids) - 1)
                i, j = i[i >= 0], j[i >= 0]
                fits = (owner[i] == owner[j]) & (i < j)
                ranks[i[~fits]] = FAR
                ranks[i[fits]] = self.pair_ranks(ids[i[fits]], ids[j[fits]])
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        return ids[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=len(pieces)))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        if piece not in self.known:
            self.learn([piece])
        at = self.known[piece]
        return list(self.ids[self.ends[at]:self.ends[at + 1]])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs and a linked list."""
        n, seen = len(ids), {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = np.array(ids, np.int64)
        ranks = self.pair_ranks(at[:-1], at[1:])
        some = np.flatnonzero(ranks < FAR)
        heap = list(zip(ranks[some].tolist(), some.tolist(), at[some].tolist(), at[some + 1].tolist()))
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = ids[i] << 20 | ids[after[i]]
                if pair not in seen:
                    seen[pair] = int(self.table.find(np.array([pair], np.int64))[0])
                if seen[pair] < FAR:
                    heapq.heappush(heap, (seen[pair], i, ids[i], ids[after[i]]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in ids if t >= 0]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte offset of each in its text, and the number of ids of each text."""
        if len(self.known) > CACHED or self.known_bytes > CACHED_BYTES:
            self.forget()
        joined = "\0".join(texts) + "\0"
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        breaks = np.cumsum(sizes + 1) - 1
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        widths = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        byte_at = np.cumsum(widths) - widths
        starts = pretoken_starts(points, breaks)
        data, at = joined.encode(), byte_at[starts]
        cuts = [*at.tolist(), len(data)]
        keep = np.ones(len(starts), bool)
        keep[np.searchsorted(starts, breaks)] = False
        pieces = [data[a:b] for a, b, k in zip(cuts, cuts[1:], keep.tolist()) if k]
        self.learn(list(dict.fromkeys(p for p in pieces if p not in self.known)))
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        ends = np.frombuffer(self.ends, np.int64)
        first, count = ends[numbers], ends[numbers + 1] - ends[numbers]
        text_of = np.searchsorted(breaks, starts[keep])
        into = np.cumsum(count) - count
        ids = np.frombuffer(self.ids, np.int32)[
            np.repeat(first - into, count) + np.arange(int(count.sum()))] if len(numbers) else np.zeros(0, np.int32)
        per_text = np.bincount(text_of, count, len(texts)).astype(np.int64)
        lengths = self.lengths[ids]
        flat = np.cumsum(lengths) - lengths
        first_of = np.cumsum(per_text) - per_text
        base = np.append(flat, lengths.sum())[first_of]
        return ids, (flat - np.repeat(base, per_text)).astype(np.int32), per_text

    def decode(self, ids: np.ndarray, offsets: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in one array, each id's bytes put at its offset, and where each text ends."""
        lengths = self.lengths[ids]
        ends = np.cumsum(per_text)
        sizes = np.zeros(len(per_text), np.int64)
        some = per_text > 0
        sizes[some] = offsets[ends[some] - 1] + lengths[ends[some] - 1]
        stops = np.cumsum(sizes)
        out = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint8)
        places = np.repeat(stops - sizes, per_text) + offsets
        into = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(places, lengths) + into] = self.flat[np.repeat(self.flat_starts[ids], lengths) + into]
        return out, stops


def merger(path: str) -> Merger:
    """One per worker and vocabulary."""
    return held(("merger", path), lambda: Merger(path))


def _cuts(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows of about ``most`` in size; a longer row is in a run with few others."""
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, text: str, ids: str, offsets: str) -> Iterator[pa.RecordBatch]:
    """Batches with ids and offsets, handed on in parts of about ``CHUNK`` bytes of text."""
    for batch in batches:
        texts = pc.fill_null(batch.column(text), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in _cuts(sizes, CHUNK):
            found, places, per_text = merger(path).encode(texts[a:b].to_pylist())
            ends = np.cumsum(per_text)
            columns = dict(zip(batch.schema.names, batch[a:b].columns)) | {ids: _lists(ends, found), offsets: _lists(ends, places)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        del columns, found, places, texts
        give_back()


def decoded(ids: pa.ListArray, offsets: pa.ListArray, path: str) -> pa.Array:
    """The bytes of each list of ids."""
    per_text = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    data, sizes = [], []
    for a, b in _cuts(per_text, CHUNK // 4):
        run, stops = merger(path).decode(ids[a:b].flatten().to_numpy(), offsets[a:b].flatten().to_numpy(), per_text[a:b])
        data.append(run.tobytes())
        sizes.append(np.diff(stops, prepend=0))
    ends = np.cumsum(np.concatenate([[0], *sizes])).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(data))])


def decode_column(ids: Column, offsets: Column, path: str) -> Column:
    """The bytes of the ids, as binary. Null lists give no bytes."""
    @F.arrow_udf("binary")
    def decode(ids: pa.Array, offsets: pa.Array) -> pa.Array:
        return decoded(ids, offsets, path)

    none = F.array().cast("array<int>")
    return decode(F.coalesce(ids, none), F.coalesce(offsets, none))


def _types(df: DataFrame, more: dict[str, str]) -> T.StructType:
    kinds = {f.name: f.dataType for f in df.schema.fields} | {c: T._parse_datatype_string(k) for c, k in more.items()}
    return T.StructType([T.StructField(c, k) for c, k in kinds.items()])


def encode_table(df: DataFrame, path: str, text: str = "text", ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """The table with a column of ids and one of offsets, replacing columns of these names."""
    kept = df.drop(ids, offsets)
    return kept.mapInArrow(lambda batches: _encoded(batches, path, text, ids, offsets),
                           _types(kept, {ids: "array<int>", offsets: "array<int>"}))


def round_trip_digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the bytes decoded from them."""
    texts = df.select("doc_id", "text")

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _encoded(batches, path, "text", "ids", "offsets"):
            back = decoded(part.column("ids"), part.column("offsets"), path)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), back], ["doc_id", "ids", "back"])

    back = texts.mapInArrow(there_and_back, _types(texts.select("doc_id"), {"ids": "array<int>", "back": "binary"}))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       sha256_hex(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                       sha256_hex(F.col("back")).alias("decoded_sha256"))
