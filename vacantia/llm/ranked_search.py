"""Ranked lexical search: the best documents for each item, by best-first search over document intervals.

Documents are cut into shards of bounded size, and numbered in a shard by ascending id. For each term of the items a shard has a
posting list: the documents that hold it, and its impact in each, what one occurrence in an item adds to the document's score. A
range-maximum sparse table over the lists gives the largest impact of a term in any interval of documents in two look-ups.
The sum of these maxima over an item's terms bounds every score in the interval.

The search begins with the whole shard. The interval of the highest bound is split at the document where its weightiest term is
largest: that document is scored in full, and the intervals on both sides get bounds of their own. It ends when no bound can
beat the k-th best score; an interval whose bound equals that score matters only if it begins before the id that holds it. Many
intervals are split at once, with one look-up for all their terms.

Documents are read once, by one pass that counts their terms; only counts of terms that occur in some item are written and
shuffled. Items come in runs of bounded size, each of which meets every shard. A shard's best k of each item leave it, nothing else.

A null text has no terms, as has one without letters and digits; such documents are never found and such items find none. Rows that
repeat an id are documents of their own; those without an id can be found and come last among equal scores. Items equal in id and
text are one item; texts that share an id are ranked each by itself. Long texts are counted in pieces. An empty table on either side
gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm.common import ascii_lower, give_back, staged

NOT_A_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PIECE = 1 << 20  # bytes of a text that are split into terms at a time
LAST = (1 << 63) - 1  # stands for no id
POSTINGS = "part int, place bigint, doc_id bigint, n bigint, terms array<string>, counts array<bigint>"
FOUND = "item bigint, doc_id bigint, score bigint"


@dataclass(frozen=True)
class Searching:
    """Bounds of a shard in documents and in postings, of a run of items, and of the intervals split at once."""

    shard_docs: int = 8192
    shard_postings: int = 1_000_000
    items_at_once: int = 256
    splits: int = 256


_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def count_terms(text: str | None) -> Counter:
    """How often each term occurs, terms as UTF-8."""
    data, counts, at = (text or "").encode(), Counter(), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and _BYTES[data[end]] != 32:  # not inside a term
            end += 1
        counts.update(data[at:end].translate(_BYTES).split(b" "))
        at = end
    del counts[b""]
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as term counts, each with its place in the task; a first entry without a term stands for the document."""
    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for a in range(0, len(texts), 256):
            counted = [count_terms(t.as_py()) for t in texts[a:a + 256]]
            ends = np.cumsum([0, *(len(c) + 1 for c in counted)]).astype(np.int32)
            terms = pa.array([t for c in counted for t in (None, *(k.decode() for k in c))], pa.string())
            counts = pa.array([n for c in counted for n in (0, *c.values())], pa.int64())
            size = len(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, part, np.int32)), pa.array(np.arange(place, place + size)), ids[a:a + size],
                 pa.array([sum(c.values()) for c in counted], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), terms),
                 pa.ListArray.from_arrays(pa.array(ends), counts)], ["part", "place", "doc_id", "n", "terms", "counts"])
            place += size
        give_back()


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term, times): the terms of each item; ``item`` is a number for an id and text."""
    terms = F.filter(F.split(F.coalesce(ascii_lower(F.col(text)), F.lit("")), NOT_A_TERM), lambda t: t != "")
    rows = items.select(F.col(item).alias("item_id"), F.col(text).alias("text")).distinct()
    each = rows.select(F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item"), "item_id", F.explode(terms).alias("term"))
    return each.groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))


def sparse_table(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Level j holds where the largest of each 2**j consecutive values stands, the first of equal ones."""
    levels = [np.arange(len(values), dtype=np.int32)]
    for j in range(max(longest, 1).bit_length() - 1):
        a, b = levels[-1][:len(levels[-1]) - (1 << j)], levels[-1][1 << j:]
        levels.append(np.where(values[a] >= values[b], a, b))
    return levels


class Shard:
    """Posting lists of a run of documents, in one array sorted by term and document."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, term))
        self.docs, self.impact = docs, impact[order]
        self.keys = term[order] * (docs + 1) + doc[order]
        self.doc = doc[order]
        lengths = np.bincount(term, minlength=terms) if len(term) else np.zeros(terms, np.int64)
        self.levels = sparse_table(self.impact, int(lengths.max(initial=0)))

    def largest(self, terms: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest impact of each term in the documents from ``first`` on and before ``after``, and where it stands; 0 and -1
        for none. Rows are terms, columns intervals."""
        base = (terms * (self.docs + 1))[:, None]
        a = np.searchsorted(self.keys, base + first[None, :])
        b = np.searchsorted(self.keys, base + after[None, :])
        some = a < b
        at, value = np.full(a.shape, -1, np.int64), np.zeros(a.shape, np.int64)
        if some.any():
            a, length = a[some], (b - a)[some]
            level = np.frexp(length.astype(float))[1] - 1
            place = np.empty(len(a), np.int64)
            for j in np.unique(level).tolist():
                m = level == j
                x, y = self.levels[j][a[m]], self.levels[j][a[m] + length[m] - (1 << j)]
                place[m] = np.where(self.impact[x] >= self.impact[y], x, y)
            at[some], value[some] = place, self.impact[place]
        return value, at

    def scores(self, terms: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        key = (terms * (self.docs + 1))[:, None] + docs[None, :]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (np.where(self.keys[at] == key, self.impact[at], 0) * times[:, None]).sum(axis=0)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, splits: int) -> tuple[list[tuple[int, int]], int]:
        """(score, document) of the best k, equal scores by document, and how many documents were scored."""
        best: list[tuple[int, int]] = []  # a heap of (score, -document), the worst first
        waiting: list[tuple[int, int, int, int]] = []  # (-bound, first, after, document to split at)
        made = 0

        def offer(first: np.ndarray, after: np.ndarray) -> None:
            some = first < after
            first, after = first[some], after[some]
            if not len(first):
                return
            value, at = self.largest(terms, first, after)
            value = value * times[:, None]
            bound, weightiest = value.sum(axis=0), value.argmax(axis=0)
            split = self.doc[at[weightiest, np.arange(len(first))]]
            for entry in zip((-bound).tolist(), first.tolist(), after.tolist(), split.tolist()):
                if matters(-entry[0], entry[1]):
                    heapq.heappush(waiting, entry)

        def matters(bound: int, first: int) -> bool:
            return bound > 0 and (len(best) < k or (bound, -first) > best[0])

        offer(np.zeros(1, np.int64), np.full(1, self.docs, np.int64))
        size = 2
        while waiting:
            taken = []
            while waiting and len(taken) < size:
                entry = heapq.heappop(waiting)
                if matters(-entry[0], entry[1]):
                    taken.append(entry)
                elif len(best) == k and -entry[0] < best[0][0]:
                    waiting.clear()  # no bound is higher than this one
            if not taken:
                break
            size = min(2 * size, splits)
            _, first, after, at = (np.array(x, np.int64) for x in zip(*taken))
            scored = self.scores(terms, times, at)
            made += len(at)
            for score, doc in zip(scored.tolist(), at.tolist()):
                if score > 0 and (len(best) < k or (score, -doc) > best[0]):
                    (heapq.heappush if len(best) < k else heapq.heapreplace)(best, (score, -doc))
            offer(np.concatenate([first, at + 1]), np.concatenate([at, after]))
        return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1])), made


def _searcher(k: int, splits: int):
    def search(postings: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if postings.num_rows and items.num_rows:
            key = postings["part"].to_numpy().astype(np.int64) << 40 | postings["place"].to_numpy()
            ids = postings["doc_id"].fill_null(LAST).to_numpy()
            _, at, of = np.unique(key, return_index=True, return_inverse=True)
            order = np.lexsort((np.arange(len(at)), ids[at]))
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            ids, missing = ids[at][order], postings["doc_id"].is_null().to_numpy()[at][order]
            names, term = np.unique(postings["term_id"].to_numpy(), return_inverse=True)
            shard = Shard(term.astype(np.int64), number[of], postings["impact"].to_numpy(), len(order), len(names))
            del key, of
            wanted, asked, times = (items[c].to_numpy() for c in ("item", "term_id", "times"))
            places = np.searchsorted(names, asked)
            there = places < len(names)
            there[there] = names[places[there]] == asked[there]
            for item in np.unique(wanted).tolist():
                mine = (wanted == item) & there
                if mine.any():
                    found, _ = shard.search(places[mine].astype(np.int64), times[mine].astype(np.int64), k, splits)
                    out += [(item, None if missing[d] else int(ids[d]), s) for s, d in found]
            give_back()
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["item", "doc_id", "score"])

    return search


def impact(w: Column, tf: Column, m: Column) -> Column:
    """What one occurrence of a term in an item adds."""
    return w * F.call_function("div", F.lit(1_000_000_000) * tf, F.lit(1000) * tf + F.lit(8) * m)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, settings: Searching = Searching(), doc: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k documents of highest score above 0 for each item."""
    asked = item_terms(items).withColumn("term_id", F.xxhash64("term"))
    runs = max(1, math.ceil(items.count() / settings.items_at_once))
    asked = staged(asked.withColumn("run", F.pmod("item", F.lit(runs)).cast("int")), "item-terms")
    terms = staged(asked.select("term", "term_id").distinct(), "terms")
    counted = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_counted, POSTINGS)
    each = counted.select("part", "place", "doc_id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("e")).select(
        "part", "place", "doc_id", "n", F.col("e.terms").alias("term"), F.col("e.counts").alias("tf"))
    # Spark broadcasts the terms if their file is small, and else shuffles counts, not texts.
    known = staged(each.join(terms, "term", "left").where("term IS NULL OR term_id IS NOT NULL").drop("term"), "postings")
    whole = known.where("term_id IS NULL").agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
                                               F.count("*").alias("rows")).first()
    postings = known.where("term_id IS NOT NULL")
    held = staged(postings.groupBy("term_id").agg(F.count("*").alias("df")), "frequencies")
    shards = max(1, math.ceil(whole.rows / settings.shard_docs), math.ceil((held.agg(F.sum("df")).first()[0] or 0) / settings.shard_postings))
    w = F.floor(1000 * F.log((2.0 * whole.docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    m = F.lit(25) + F.call_function("div", F.lit(75 * whole.docs) * F.col("n"), F.lit(max(whole.terms, 1)))
    weighed = postings.join(held.select("term_id", w.alias("w")), "term_id").select(
        "part", "place", "doc_id", "term_id", impact(F.col("w"), F.col("tf"), m).alias("impact"))
    # A term of several runs of items goes to each of them.
    of_run = weighed.join(staged(asked.select("run", "term_id").distinct(), "runs"), "term_id").withColumn(
        "shard", F.pmod(F.xxhash64("part", "place"), F.lit(shards)).cast("int"))
    every = asked.select("run", "item", "term_id", "times", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    found = of_run.groupBy("run", "shard").cogroup(every.groupBy("run", "shard")).applyInArrow(_searcher(k, settings.splits), FOUND)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
