"""Exact top-k by inner product, with a pivot table for elimination.

Components are whole numbers, floor(256 x). For vectors q and v of length |q| and |v| the product is (|q|^2 + |v|^2 - d(q, v)^2) / 2, and
by the triangle inequality d(q, v) is at least the largest |d(q, p) - d(v, p)| over the pivots p. So distances to the pivots,
computed once for each vector, give an upper bound of each product without looking at the vectors. A query takes its candidates in
the order of their bounds and stops where no bound reaches its k-th best score.

Candidates are sorted by their nearest pivot and cut into blocks of some thousand rows, each with the range of its distances to every
pivot. A query is first compared with the block that lies around it, which gives it a k-th best score to beat, then with every
block whose bound reaches that score. No pairs become rows: a task holds one block and a bounded number of queries, and gives the best k
of each. Blocks visited by many queries are copied for each run of ``visits`` of them.

Vectors that are null, or hold a null or a component that is not finite, take no part; nor do those of more than 2**22 in length,
whose products might not be 64-bit numbers, nor rows without an id. Rows of one id are one query's own and never its candidates; apart
from that each row is a candidate, repeated rows too. Equal rows are one query; an id with different vectors is several queries.
Vectors are compared with those of as many components only. Ties go to the smaller vec_id. Of equal vectors only the k + 1 of
smallest ids can be among the best k of any query, one of them perhaps being its own; the others are left out beforehand, so a
vector that fills a third of the table costs no more than others. Ids that repeat count once for that.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm.common import give_back, staged

SCALE = 256
LONGEST = float(1 << 30)  # of a vector of whole numbers
CELLS_AT_ONCE = 1 << 20  # bounds held at a time
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


@dataclass(frozen=True)
class Pivoting:
    """Pivots are chosen among about ``sample`` rows; all rows are indexed."""

    pivots: int = 32
    sample: int = 4096
    block_rows: int = 8192
    blocks_at_once: int = 1024
    queries_at_once: int = 4096
    visits: int = 2048
    step: int = 128


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) for each component, as bigint; null for vectors that take no part."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LONGEST / SCALE))
    whole = F.when(fits, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")))
    length = F.aggregate(whole, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.when(length <= LONGEST * LONGEST, whole)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim, vec_key) of the rows that take part."""
    whole = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("vec_id"), whole_numbers(F.col(vector)).alias("v"))
    return whole.where("v IS NOT NULL").select("vec_id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("vec_key"))


def _matrix(column: pa.ChunkedArray | pa.Array, kind=np.int64) -> np.ndarray:
    """Lists of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def choose_pivots(rows: DataFrame, n: int, settings: Pivoting) -> dict[int, np.ndarray]:
    """Pivots for each number of components: of a sample of different vectors, picked by a hash and not by place, one after
    the other the one farthest from those picked."""
    share = min(1.0, 1.25 * settings.sample / max(n, 1))
    picked = F.pmod("vec_key", F.lit(1 << 40)) < int(share * (1 << 40))
    sample = rows.where(picked).select("vec_key", "v").dropDuplicates(["vec_key"]).orderBy("vec_key").limit(2 * settings.sample).toArrow()
    lists = sample["v"].to_pylist()
    out = {}
    for dim in sorted({len(v) for v in lists}):
        of_dim = [v for v in lists if len(v) == dim]
        x = np.array(of_dim, float).reshape(len(of_dim), dim)
        far, chosen = ((x - x.mean(axis=0)) ** 2).sum(axis=1), []
        while len(chosen) < settings.pivots and (not chosen or far.max() > 0):
            chosen.append(int(far.argmax()))
            own = ((x - x[chosen[-1]]) ** 2).sum(axis=1)
            far = own if len(chosen) == 1 else np.minimum(far, own)
        out[dim] = x[chosen]
    return out


def with_distances(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the squared length, the distances to the pivots, the nearest pivot and its distance."""
    def measure(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                v, p = _matrix(part.column("v")), pivots.get(dim, np.zeros((0, dim)))
                apart = np.empty((len(v), len(p)))
                for i, pivot in enumerate(p):
                    apart[:, i] = np.sqrt(((v - pivot) ** 2).sum(axis=1))
                near = apart.argmin(axis=1) if len(p) else np.zeros(len(v), np.int64)
                ring = apart[np.arange(len(v)), near] if len(p) else np.zeros(len(v))
                lists = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * len(p), pa.array(apart.astype(np.float32).ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array((v * v).sum(axis=1)), lists, pa.array(near.astype(np.int32)),
                                                  pa.array(ring.astype(np.float32))], [*part.schema.names, "norm2", "d", "cell", "ring"])

    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    return rows.mapInArrow(measure, f"{kinds}, norm2 bigint, d array<float>, cell int, ring float")


def _slack(norms: np.ndarray) -> np.ndarray:
    """What rounding may take from a bound."""
    return norms * 1e-12 + 1e-3


def bounds(q_norm: np.ndarray, q_d: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The highest product that each query may have with what lies between the distances ``low`` and ``high`` to each pivot."""
    least = np.zeros((len(q_norm), len(norm)), np.float32)
    for i in range(q_d.shape[1]):
        np.maximum(least, q_d[:, i, None] - high[None, :, i], out=least)
        np.maximum(least, low[None, :, i] - q_d[:, i, None], out=least)
    largest = float(q_d.max(initial=0)) + float(high.max(initial=0))
    least = np.maximum(least.astype(float) - largest * 2.0 ** -20, 0.0)
    sums = q_norm[:, None].astype(float) + norm[None, :]
    return (sums - least * least) / 2 + _slack(sums)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, least: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int,
                  step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, candidate row, score) of each query's best k, none below its ``least``, and how many products were computed."""
    rows, found, scores, made = [], [], [], 0
    for i in range(len(q_ids)):
        open_ = np.flatnonzero((bound[i] >= least[i]) & (ids != q_ids[i]))
        open_ = open_[np.argsort(-bound[i, open_], kind="stable")]
        kept, kept_scores, reach, at, size = np.zeros(0, np.int64), np.zeros(0, np.int64), float(least[i]), 0, step
        while at < len(open_) and bound[i, open_[at]] >= reach:
            now = open_[at:at + size]
            product = v[now] @ q[i]
            made += len(now)
            good = product >= reach
            kept, kept_scores = np.append(kept, now[good]), np.append(kept_scores, product[good].astype(np.int64))
            order = np.lexsort((ids[kept], -kept_scores))[:k]
            kept, kept_scores = kept[order], kept_scores[order]
            if len(kept) == k:
                reach = max(reach, float(kept_scores[-1]))
            at, size = at + size, size * 2
        rows.append(np.full(len(kept), i)), found.append(kept), scores.append(kept_scores)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores), made


def _evaluate(k: int, step: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best k of each query that visits a block."""
    def evaluate(visits: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if visits.num_rows and items.num_rows:
            ids, whole, norm, d = items["vec_id"].to_numpy(), _matrix(items["v"]), items["norm2"].to_numpy(), _matrix(items["d"], np.float32)
            q_ids, keys, q_norm = (visits[c].to_numpy() for c in ("query_id", "query_key", "norm2"))
            q, q_d = _matrix(visits["v"]), _matrix(visits["d"], np.float32)
            least = visits["kth"].to_numpy(zero_copy_only=False).astype(float)
            least[np.isnan(least)] = -math.inf
            if math.sqrt(float(norm.max()) * float(q_norm.max())) < 1 << 52:  # doubles hold all sums exactly
                whole, q = whole.astype(float), q.astype(float)
            some = max(1, CELLS_AT_ONCE // len(ids))
            for a in range(0, len(q_ids), some):
                s = slice(a, a + some)
                row, found, score, _ = best_of_block(q_ids[s], q[s], bounds(q_norm[s], q_d[s], norm, d, d), least[s], ids, whole, k, step)
                out.append(pa.table([q_ids[s][row], keys[s][row], ids[found], score], ["query_id", "query_key", "vec_id", "score"]))
            give_back()
        return pa.concat_tables(out) if out else pa.schema(
            [(c, pa.int64()) for c in ("query_id", "query_key", "vec_id", "score")]).empty_table()

    return evaluate


def _visit(first: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(query, block): the block around each query, or every block but that one whose bound reaches the query's k-th score."""
    names = ["query_id", "query_key", "block", "away"]

    def visit(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for dim in np.unique(queries["dim"].to_numpy()).tolist() if queries.num_rows and blocks.num_rows else []:
            q, b = (t.filter(pa.compute.equal(t["dim"], dim)) for t in (queries, blocks))
            if not b.num_rows:
                continue
            low, high, block = _matrix(b["low"], np.float32), _matrix(b["high"], np.float32), b["block"].to_numpy()
            ids, keys, d = q["query_id"].to_numpy(), q["query_key"].to_numpy(), _matrix(q["d"], np.float32)
            if first:
                away = np.zeros((len(ids), len(block)))
                for i in range(d.shape[1]):
                    away += np.abs(d[:, i, None] - (low[None, :, i] + high[None, :, i]) / 2)
                best = away.argmin(axis=1)
                out.append(pa.table([ids, keys, block[best], away[np.arange(len(ids)), best]], names))
            else:
                kth = q["kth"].to_numpy(zero_copy_only=False).astype(float)
                kth[np.isnan(kth)] = -math.inf
                reached = bounds(q["norm2"].to_numpy(), d, b["norm2"].to_numpy(), low, high) >= kth[:, None]
                reached &= q["seen"].to_numpy()[:, None] != block[None, :]
                i, j = np.nonzero(reached)
                out.append(pa.table([ids[i], keys[i], block[j], np.zeros(len(i))], names))
        return pa.concat_tables(out) if out else pa.schema([*[(c, pa.int64()) for c in names[:3]], ("away", pa.float64())]).empty_table()

    return visit


def top_k_products(vectors: DataFrame, queries: Column, k: int = 5, settings: Pivoting = Pivoting(), vec_id: str = "vec_id",
                   vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k highest products of each query. ``queries`` says of a row, by its vec_id, whether
    it is one."""
    rows = usable(vectors, vec_id, vector)
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("vec_key").alias("query_key"), "v", "dim").distinct()
    n = rows.count()
    pivots = choose_pivots(rows, n, settings)
    place = F.dense_rank().over(Window.partitionBy("dim", "vec_key").orderBy("vec_id"))
    several = rows.withColumn("__place", place).where(F.col("__place") <= k + 1).drop("__place")
    order = ["dim", "cell", "ring", "vec_key", "vec_id"]
    dealt = with_distances(several, pivots).repartitionByRange(max(1, math.ceil(n / settings.block_rows)), *order)
    items = staged(dealt.withColumn("block", F.spark_partition_id().cast("bigint")), "pivot-table")
    asked = staged(with_distances(asked, pivots).drop("cell", "ring"), "queries")
    width = F.max(F.size("d"))
    widest = items.agg(width).first()[0] or 0
    ends = [f(F.get("d", i)) for f in (F.min, F.max) for i in range(widest)]
    blocks = staged(items.groupBy("block", "dim").agg(F.max("norm2").alias("norm2"), F.array(*ends[:widest]).cast("array<float>").alias("low"),
                                                      F.array(*ends[widest:]).cast("array<float>").alias("high"), width.alias("width")).select(
        "block", "dim", "norm2", F.slice("low", 1, F.col("width")).alias("low"), F.slice("high", 1, F.col("width")).alias("high")), "blocks")
    parts = max(1, math.ceil(asked.count() / settings.queries_at_once))
    groups = max(1, math.ceil(blocks.count() / settings.blocks_at_once))
    group = F.pmod(F.xxhash64("block", "dim"), F.lit(groups)).cast("int")

    def visits(of: DataFrame, first: bool) -> DataFrame:
        """The blocks that queries visit; both sides meet in groups of bounded size."""
        left = of.withColumns({"part": F.pmod(F.xxhash64("query_id", "query_key"), F.lit(parts)).cast("int"),
                               "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))}).groupBy("part", "group")
        right = blocks.withColumns({"group": group, "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))}).groupBy("part", "group")
        return left.cogroup(right).applyInArrow(_visit(first), "query_id bigint, query_key bigint, block bigint, away double")

    def evaluated(visiting: DataFrame, name: str) -> DataFrame:
        """The best k of each query in each block it visits. ``visiting`` has the queries' columns, kth and block."""
        visiting = staged(visiting, f"{name}-visits")
        many = staged(visiting.groupBy("block", "dim").agg(F.ceil(F.count("*") / settings.visits).cast("int").alias("runs")), f"{name}-runs")
        copies = many.select("block", "dim", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("copy"))
        at = ["block", "dim"]
        run = F.pmod(F.xxhash64("query_id", "query_key"), F.col("runs")).cast("int")
        left = visiting.join(many, at).withColumn("run", run).groupBy(*at, "run")
        right = items.join(copies, at).withColumn("run", F.col("copy")).groupBy(*at, "run")
        return staged(left.cogroup(right).applyInArrow(_evaluate(k, settings.step), FOUND), name)

    one = ["query_id", "query_key"]
    nearest = visits(asked, True).groupBy(*one).agg(F.min(F.struct("away", "block"))["block"].alias("block"))
    seen = asked.join(nearest, one).withColumn("kth", F.lit(None).cast("bigint"))
    near = evaluated(seen, "near")
    beaten = near.groupBy(*one).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    asked = staged(seen.drop("kth").withColumnRenamed("block", "seen").join(beaten, one, "left"), "queries-seen")
    reached = visits(asked, False).drop("away").join(asked.drop("seen"), one)
    every = near.unionByName(evaluated(reached, "far"))
    rank = F.row_number().over(Window.partitionBy(*one).orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
