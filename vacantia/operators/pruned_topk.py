"""Exact top-k by cosine similarity that leaves out cells of items too far away to matter.

Items are placed by their nearest centre and their angle to it; a cell is one centre and one ring of angles around it. The
angle between two vectors is a metric, so an item of a cell is at least as far from a query as the query's own angle to
the centre lies outside the cell's range of angles. Each query first meets the cells nearest to it. Its k-th score there
says which others can still hold something better; only these it meets in the second round, where neighbouring cells share a
block, so that a query is sent once to each block and not to each cell.

Centres come from a sample of bounded size and decide the work alone, never the result: rows are those of
``topk.top_k_similar``. Vectors without clusters are all near to each other's bounds, and nearly all pairs are multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.operators.topk import BLOCK_NUMBERS, BROADCAST_BYTES, ITEM_BLOCK_ROWS, QUERY_BLOCK_ROWS, Kept, _best, _column, _matrix, _nothing, _usable
from vacantia.session import ship_package, staged

SAMPLE_ROWS = 2_048
HASHES = 1 << 31
ROUNDS_OF_MEANS = 8
FIRST_CELLS = 2
ROWS_AT_ONCE = 512
QUERIES_AT_ONCE = 2_048
SLACK = 1e-6  # over the error of an angle near zero
ZERO_CELL = -1


@dataclass(frozen=True)
class Pruned:
    """The rows found, and how many of all pairs the bounds let through for them, in both rounds. In the second, queries of one
    nearest centre go through together, and a pair is multiplied if any of them needs it."""
    rows: DataFrame
    pairs: int
    multiplied: int


@dataclass(frozen=True)
class Cells:
    """Names, sizes and ranges of angles of the cells that hold items: at most centres x rings, and one of zero vectors."""
    centres: np.ndarray
    rings: int
    name: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def near(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and cell: the highest score an item there can have, and the angle to the middle of the ring."""
        angle = np.arccos(np.clip(unit @ self.centres.T, -1, 1))[:, np.maximum(self.name, 0) // self.rings]
        outside = np.maximum(np.maximum(angle - self.high, self.low - angle), 0)
        bound = np.where(self.name == ZERO_CELL, 0.0, np.cos(outside))
        bound[~unit.any(axis=1)] = 0.0
        return bound, np.abs(angle - (self.low + self.high) / 2)

    def first(self, bound: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
        """Flags of each query's first cells: the most promising, until they hold k items."""
        order = np.lexsort((off, -bound), axis=1)
        held = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        flags = np.zeros(bound.shape, bool)
        np.put_along_axis(flags, order, (held < k) | (np.arange(bound.shape[1]) < FIRST_CELLS), axis=1)
        return flags


def _finite(df: DataFrame) -> DataFrame:
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return df.where(F.forall("v", fine))


def centres_of(rows: np.ndarray, n: int) -> np.ndarray:
    """At most n unit centres: rows far from each other, then a few rounds of means. Copies count once."""
    rows = np.unique(rows[rows.any(axis=1)], axis=0)
    if not len(rows):
        return np.eye(1, rows.shape[1])
    chosen, near = [0], rows @ rows[0]
    while len(chosen) < min(n, len(rows)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    out = rows[chosen]
    for _ in range(ROUNDS_OF_MEANS):
        sums = np.zeros_like(out)
        np.add.at(sums, (rows @ out.T).argmax(axis=1), rows)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        out = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), out)
    return out


def _sample(items: DataFrame, n: int) -> np.ndarray:
    """Unit rows of at most SAMPLE_ROWS items: few rows pass the bound on the hash before they are put in order."""
    place = F.pmod(F.xxhash64("item_id"), F.lit(HASHES))
    few = items.where(place < min(HASHES, HASHES * 2 * SAMPLE_ROWS // max(n, 1) + 1))
    return _matrix(few.orderBy(place, "item_id").limit(SAMPLE_ROWS).select("v").toArrow()["v"])


def _placed(items: DataFrame, centres: np.ndarray, rings: int) -> DataFrame:
    """The items with their cell and their angle to its centre."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _matrix(batch["v"])
                cos = np.clip(unit @ centres.T, -1, 1)
                of, angle = cos.argmax(axis=1), np.arccos(cos.max(axis=1))
                ring = np.minimum((angle * (rings / np.pi)).astype(np.int64), rings - 1)
                cell = np.where(unit.any(axis=1), of * rings + ring, ZERO_CELL).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch["item_id"], batch["v"], pa.array(cell), pa.array(angle)],
                                                 names=["item_id", "v", "cell", "angle"])

    kinds = {c: items.schema[c].dataType.simpleString() for c in ("item_id", "v")}
    return items.mapInArrow(place, f"item_id {kinds['item_id']}, v {kinds['v']}, cell int, angle double")


def _probes(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """A row for each query and cell that meet in the first round, with the rows of the cell."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                row, cell = np.nonzero(cells.first(*cells.near(_matrix(part["v"])), k))
                taken = part.select(["query_id", "v"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells.name[cell].astype(np.int32)), pa.array(cells.rows[cell])],
                                                 names=["query_id", "v", "lane", "pairs"])

    kinds = {c: queries.schema[c].dataType.simpleString() for c in ("query_id", "v")}
    return queries.mapInArrow(probe, f"query_id {kinds['query_id']}, v {kinds['v']}, lane int, pairs bigint")


def _lanes(cells: Cells, most: int) -> np.ndarray:
    """The first cells of lanes: runs of cells that hold at most so many rows together, or one cell that holds more."""
    starts, held = [], most
    for at, n in enumerate(cells.rows.tolist()):
        if held + n > most:
            starts.append(at)
            held = 0
        held += n
    return np.array(starts)


def _later_probes(queries: DataFrame, cells: Cells, starts: np.ndarray) -> DataFrame:
    """A row for each query and lane with a cell that its k-th score ``t`` leaves, and the rows of all such cells of the lane."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                left = _Left(cells, _matrix(part["v"]), _kth(part["t"]))
                pairs = np.add.reduceat(left.open(slice(None), np.arange(len(cells.name))) * cells.rows, starts, axis=1)
                row, lane = np.nonzero(pairs)
                taken = part.select(["query_id", "v", "t"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(lane.astype(np.int32)), pa.array(pairs[row, lane])],
                                                 names=["query_id", "v", "t", "lane", "pairs"])

    kinds = {c: queries.schema[c].dataType.simpleString() for c in ("query_id", "v")}
    return queries.mapInArrow(probe, f"query_id {kinds['query_id']}, v {kinds['v']}, t double, lane int, pairs bigint")


def _met(probes: DataFrame, placed: DataFrame, sizes: dict[int, int], search: Callable[[pa.Table, pa.Table], pa.Table],
         query_block_rows: int, item_block_rows: int) -> tuple[DataFrame | None, int]:
    """What a search of queries and items finds in each lane, and the pairs let through. Lanes of so many items are cut so that
    each pair of blocks is one bounded group."""
    arrivals = probes.groupBy("lane").agg(F.count("*").alias("n"), F.sum("pairs").alias("pairs")).collect()  # at most one row for each cell
    if not arrivals:
        return None, 0
    blocks = F.broadcast(placed.sparkSession.createDataFrame(
        [(r.lane, -(-r.n // query_block_rows), -(-sizes[r.lane] // item_block_rows)) for r in arrivals], "lane int, nq int, ni int"))

    def number(name: str, n: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = placed.join(blocks, "lane").select("item_id", "v", "cell", "lane", number("item_id", "ni").alias("ib"), every("nq").alias("qb"))
    right = probes.drop("pairs").join(blocks, "lane").withColumn("qb", number("query_id", "nq")).withColumn("ib", every("ni")).drop("nq", "ni")
    schema = f"query_id {probes.schema['query_id'].dataType.simpleString()}, " \
             f"item_id {placed.schema['item_id'].dataType.simpleString()}, score double"

    def score(item_table: pa.Table, query_table: pa.Table) -> pa.Table:
        return search(query_table, item_table)

    key = ["lane", "qb", "ib"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(score, schema)
    return found, sum(r.pairs for r in arrivals)


def _kth(column: pa.Array) -> np.ndarray:
    return column.fill_null(-2.0).to_numpy(zero_copy_only=False)


class _Left:
    """The cells that the k-th scores of some queries leave."""

    def __init__(self, cells: Cells, unit: np.ndarray, kth: np.ndarray) -> None:
        self.cells = cells
        self.angle = np.arccos(np.clip(unit @ cells.centres.T, -1, 1))
        reach = np.where(kth <= SLACK - 1, np.pi, np.arccos(np.clip(kth - SLACK, -1, 1)))
        self.open_to_zero = kth <= SLACK
        self.reach = np.where(unit.any(axis=1), reach, np.where(self.open_to_zero, 2 * np.pi, -2 * np.pi))  # a zero vector has score 0 with all

    def open(self, rows: slice | np.ndarray, at: np.ndarray) -> np.ndarray:
        """Flags for queries and the cells at some places."""
        name = self.cells.name[at]
        angle, reach = self.angle[rows][:, np.maximum(name, 0) // self.cells.rings], self.reach[rows][:, None]
        flags = (angle <= self.cells.high[at] + reach) & (angle >= self.cells.low[at] - reach)
        flags[:, name == ZERO_CELL] = self.open_to_zero[rows][:, None]
        return flags


class _Later:
    """The second round of some queries: their k best of the items offered, except some that don't reach the k-th score ``t``."""

    def __init__(self, asked: pa.Table, cells: Cells, k: int) -> None:
        ids, unit, kth = _column(asked, "query_id"), _matrix(asked["v"]), _kth(_column(asked, "t"))
        self.left, self.cells = _Left(cells, unit, kth), cells
        self.kept = Kept(ids, unit, k, kth.copy())
        near = self.left.angle.argmin(axis=1)
        order = np.argsort(near, kind="stable")
        ends = np.flatnonzero(np.diff(near[order])) + 1
        self.parts = [part[i:i + QUERIES_AT_ONCE] for part in np.split(order, ends) for i in range(0, len(part), QUERIES_AT_ONCE)]

    def offer(self, item_ids: pa.Array, items: np.ndarray, cell: np.ndarray) -> None:
        names, of = np.unique(cell, return_inverse=True)
        at = np.searchsorted(self.cells.name, names)
        for part in self.parts:
            flags = self.left.open(part, at)
            rows, wanted = part[flags.any(axis=1)], flags.any(axis=0)
            if wanted.all():
                self.kept.offer(item_ids, items, rows)
            elif wanted.any():
                some = np.flatnonzero(wanted[of])
                self.kept.offer(item_ids.take(pa.array(some)), items[some], rows)

    def pairs(self) -> int:
        """The pairs that the bounds let through."""
        every = np.arange(len(self.cells.name))
        return sum(int(self.left.open(part, every).sum(axis=0) @ self.cells.rows) for part in self.parts)


def _beaten(asked: pa.Table, kind: str, placed: DataFrame, cells: Cells, k: int) -> tuple[DataFrame, int]:
    """What reaches each query's k-th score ``t``, and the pairs let through. The queries, of a checked size, go to the tasks."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        later = None
        for batch in batches:
            if batch.num_rows:
                later = later or _Later(asked, cells, k)
                later.offer(batch["item_id"], _matrix(batch["v"]), batch["cell"].to_numpy())
        if later and (best := later.kept.result()) is not None:  # the best k of each query are all that leaves the task
            yield from best.to_batches()

    schema = f"query_id {kind}, item_id {placed.schema['item_id'].dataType.simpleString()}, score double"
    return placed.select("item_id", "v", "cell").mapInArrow(score, schema), _Later(asked, cells, k).pairs()


def _beaten_in_blocks(asked: DataFrame, placed: DataFrame, cells: Cells, k: int, query_block_rows: int,
                      item_block_rows: int) -> tuple[DataFrame | None, int]:
    """As _beaten, for queries of any size: each goes once to every block that holds a cell it has to meet."""
    starts = _lanes(cells, item_block_rows)
    lane = F.broadcast(placed.sparkSession.createDataFrame(
        [(int(name), int(np.searchsorted(starts, at, "right")) - 1) for at, name in enumerate(cells.name)], "cell int, lane int"))

    def search(query_table: pa.Table, item_table: pa.Table) -> pa.Table:
        best = None
        if query_table.num_rows and item_table.num_rows:
            later = _Later(query_table, cells, k)
            later.offer(_column(item_table, "item_id"), _matrix(item_table["v"]), _column(item_table, "cell").to_numpy())
            best = later.kept.result()
        return _nothing(query_table, item_table) if best is None else best

    sizes = dict(enumerate(np.add.reduceat(cells.rows, starts).tolist()))
    return _met(_later_probes(asked, cells, starts), placed.join(lane, "cell"), sizes, search, query_block_rows, item_block_rows)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id"))
    return found.withColumn("rang", rank).where(F.col("rang") <= k)


def pruned_top_k(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, query_vector: str = "vector",
                 item_vector: str = "vector", centres: int = 64, rings: int = 32, broadcast_bytes: int = BROADCAST_BYTES, query_block_rows: int = QUERY_BLOCK_ROWS,
                 item_block_rows: int = ITEM_BLOCK_ROWS) -> Pruned:
    """The k items nearest to each query: ``query_id, item_id, score, rang``, ties by item id; and the pairs let through.

    All vectors have the same length and ids are unique on each side. Vectors that are null, or hold a null or a number that is
    not finite, take no part. A zero vector has score 0 with everything. The items are placed and written once to the shared
    folder, as are the first round's results. In the second round queries go to the tasks up to ``broadcast_bytes``, and the items
    stay where they are; beyond it both are shuffled in blocks of neighbouring cells, a query once for each block with a cell that it
    has to meet.
    """
    ship_package(queries.sparkSession)
    asked = _finite(_usable(queries, query_id, query_vector, "query_id"))
    offered = _finite(_usable(items, item_id, item_vector, "item_id"))
    sizes = [df.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most"),
                    F.sum(F.length(F.col(name).cast("string"))).alias("text")).first()
             for df, name in ((asked, "query_id"), (offered, "item_id"))]
    if len({w for s in sizes for w in (s.least, s.most) if w is not None}) > 1:
        raise ValueError("vectors of different length")
    n_queries, n_items = (s.n for s in sizes)
    if not n_queries or not n_items:
        none = asked.join(offered.drop("v"), F.lit(False)).select("query_id", "item_id", F.lit(0.0).alias("score"))
        return Pruned(_ranked(none, k), 0, 0)

    middles = centres_of(_sample(offered, n_items), centres)
    in_order = _placed(offered, middles, rings).repartitionByRange("cell", F.xxhash64("item_id")).sortWithinPartitions("cell")
    placed = staged(in_order, "placed")
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    found = sorted(stats.collect())  # at most centres x rings + 1 rows
    cells = Cells(middles, rings, *(np.array([r[c] for r in found]) for c in ("cell", "n", "low", "high")))
    blocks = [max(1, min(rows, BLOCK_NUMBERS // max(1, sizes[0].most))) for rows in (query_block_rows, item_block_rows)]

    def search(query_table: pa.Table, item_table: pa.Table) -> pa.Table:
        return _best(query_table, item_table, k)

    names = dict(zip(cells.name.tolist(), cells.rows.tolist()))
    near, first = _met(_probes(asked, cells, k), placed.withColumn("lane", F.col("cell")), names, search, *blocks)
    best = staged(_ranked(near, k).drop("rang"), "first")
    kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("t")).where(F.col("n") == k).drop("n")
    left = staged(asked.join(kth, "query_id", "left"), "asked")
    if n_queries * (sizes[0].most * 8 + 64 + 8 * len(middles)) + (sizes[0].text or 0) <= broadcast_bytes:
        every, second = _beaten(left.toArrow(), asked.schema["query_id"].dataType.simpleString(), placed, cells, k)
    else:
        every, second = _beaten_in_blocks(left, placed, cells, k, *blocks)
    return Pruned(_ranked(every, k), n_queries * n_items, first + second)
