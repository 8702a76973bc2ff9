"""Gradient boosted regression trees for squared error, as MLlib grows them, over binned sparse rows.

Rows are binned once. A row is the list of the bins its features fall into, without those that hold zero, so a level of a tree costs what
rows hold and not rows x features; of two children only the smaller is counted, the other is what is left of the parent. Residuals
are whole multiples of a power of two, whose sums are exact: trees do not depend on how rows are dealt out. Rows up to a checked
size are boosted by one task; more stay where they are, and each level is a job that adds their counts. The fitted model is MLlib's.
"""

from __future__ import annotations

import json
import math
import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.memory import give_back
from vacantia.session import ship_package, staged, staging_path, use_checkpoints

BINS = 32
LIMIT_ROWS = 10_000  # rows that say where bins end, as in MLlib
LOCAL_BYTES = 320 * 1024 * 1024  # of the rows that one task may hold
ROW_BYTES = 40  # of a row in memory, besides its bins
CHUNK_ROWS = 16_384
CUT_EVERY = 10  # trees after which the lineage of distributed predictions is cut

ROWS_SCHEMA = "h long, y double, codes binary"
LIMITS_SCHEMA = "feature int, limits array<double>"
NODES_SCHEMA = "tree int, id int, n double, total double, squares double, gain double, left int, right int, feature int, threshold double"


# --- bins --------------------------------------------------------------------------------------------

def _entries(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the numbers that are not zero, row by row, of a column of vectors."""
    values, indices = column.field("values"), column.field("indices")
    dense = column.field("type").to_numpy(zero_copy_only=False) == 1
    lengths = values.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    feature = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    feature[~dense[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    some = value != 0
    return row[some], feature[some], value[some]


def _limits(values: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """Upper limits of all bins but the last, from the values of a feature in ``rows`` rows, of which zeros are not listed."""
    found, n = np.unique(values, return_counts=True)
    if rows > len(values):
        at = np.searchsorted(found, 0.0)
        found, n = np.insert(found, at, 0.0), np.insert(n, at, rows - len(values))
    middle = (found[1:] + found[:-1]) / 2
    if len(middle) < bins:
        return middle
    below, chosen, target = np.cumsum(n), [], rows / bins
    for i in range(len(middle)):
        if abs(below[i] - target) < abs(below[i + 1] - target):
            chosen.append(middle[i])
            target += rows / bins
    return np.array(chosen)


def _limits_of(bins: int) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.num_rows, *_entries(b.column(0))[1:]) for b in batches if b.num_rows]
        if not parts:
            return
        rows = sum(p[0] for p in parts)
        feature, value = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        order = np.argsort(feature, kind="stable")
        names, start = np.unique(feature[order], return_index=True)
        limits = [_limits(v, rows, bins) for v in np.split(value[order], start[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(limits, pa.list_(pa.float64()))], ["feature", "limits"])

    return find


class Bins:
    """Features with more than one bin. The bins of all of them are numbered in one row, the codes."""

    def __init__(self, limits: dict[int, np.ndarray]) -> None:
        limits = {f: np.asarray(v, np.float64) for f, v in sorted(limits.items()) if len(v)}
        self.features = np.array(list(limits), np.int64)
        self.limits = list(limits.values())
        self.size = np.array([len(v) + 1 for v in self.limits], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.codes = int(self.size.sum())
        self.zero = np.array([np.searchsorted(v, 0.0) for v in self.limits], np.int64)
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        self.kind = np.uint16 if self.codes < 1 << 16 else np.uint32  # one number more stands for "none"

    def cut(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hash, label and codes of rows of hash, label and vector."""
        for batch in batches:
            row, feature, value = _entries(batch.column(2))
            at = np.searchsorted(self.features, feature)
            known = self.features[np.minimum(at, len(self.features) - 1)] == feature if len(self.features) else np.zeros(len(row), bool)
            row, at, value = row[known], at[known], value[known]
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(len(self.features) + 1))
            bin_ = np.empty(len(row), np.int64)
            for j, limits in enumerate(self.limits):
                if (some := order[ends[j]:ends[j + 1]]).size:
                    bin_[some] = np.searchsorted(limits, value[some])
            some = bin_ != self.zero[at]
            codes = (self.first[at[some]] + bin_[some]).astype(self.kind)
            ends = np.searchsorted(row[some], np.arange(batch.num_rows + 1)) * codes.itemsize
            listed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed], ["h", "y", "codes"])


# --- rows --------------------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes from the root on, children after their parents. Codes from ``low`` on, ``width`` many, go right if ``inside``, else left."""

    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    width: np.ndarray
    inside: np.ndarray
    value: np.ndarray


@dataclass(frozen=True)
class Plan:
    """What all rows of a training have to know."""

    trees: int
    rate: float
    depth: int
    leaf: int
    subsample: float
    seed: int
    scale: float
    codes: int


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A hash of 64 bits of a hash and a number."""
    x = h.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Some rows: codes as a matrix, filled up with the number that stands for none, and predictions so far."""

    def __init__(self, h: np.ndarray, y: np.ndarray, codes: np.ndarray) -> None:
        self.h, self.y, self.codes, self.so_far = h, y, codes, np.zeros(len(y))

    def begin(self, plan: Plan, number: int) -> None:
        """Residuals, doubled as the gradient is, and the rows that this tree is grown on."""
        rest = self.y if number == 0 else 2 * (self.y - self.so_far)
        self.rest = np.rint(rest * plan.scale)
        chosen = _mixed(self.h, plan.seed + number) >> np.uint64(11)
        self.bag = chosen < np.uint64(int(plan.subsample * (1 << 53)))
        self.node = np.zeros(len(self.y), np.int32)

    def descend(self, tree: Tree) -> None:
        """Rows at a node that was split go to its children."""
        rows = np.flatnonzero(tree.left[self.node] > 0)
        node, kind = self.node[rows], self.codes.dtype.type
        low, width = tree.low.astype(kind)[node], tree.width.astype(kind)[node]
        found = (self.codes[rows] - low[:, None] < width[:, None]).any(axis=1)  # numbers without sign: below low is far above
        self.node[rows] = np.where(found == tree.inside[node], tree.right[node], tree.left[node])

    def count(self, plan: Plan, slot_of: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and residuals by slot and code, and rows, residuals and their squares by slot, of rows whose node has a slot."""
        slot = slot_of[self.node]
        rows = np.flatnonzero((slot >= 0) & self.bag)
        slot, rest, width = slot[rows], self.rest[rows], plan.codes + 1
        at = self.codes[rows].astype(np.int64)
        at += (slot * width)[:, None]
        flat = at.ravel()
        found = np.stack([np.bincount(flat, minlength=slots * width), np.bincount(flat, np.repeat(rest, at.shape[1]), slots * width)])
        whole = np.stack([np.bincount(slot, w, slots) for w in (np.ones(len(rest)), rest, rest * rest)])
        return found.reshape(2, slots, width).astype(np.float64, copy=False), whole.astype(np.float64, copy=False)

    def finish(self, tree: Tree, weight: float) -> None:
        self.so_far += weight * tree.value[self.node]


def _chunks(batches: Iterable[pa.RecordBatch], bins_kind: type, none: int) -> Iterator[Chunk]:
    """Chunks of rows with about as many codes each, so that little is filled up."""
    held, rows = [], 0

    def packed() -> Iterator[Chunk]:
        table = pa.Table.from_batches(held).combine_chunks()
        column = table["codes"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // np.dtype(bins_kind).itemsize
        codes = np.frombuffer(column.buffers()[2] or b"", bins_kind)
        h, y = table["h"].to_numpy(), table["y"].to_numpy()
        lengths = np.diff(ends)
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(order), CHUNK_ROWS):
            some = order[at:at + CHUNK_ROWS]
            long = lengths[some]
            out = np.full((len(some), int(long.max())), none, bins_kind)
            row = np.repeat(np.arange(len(some)), long)
            place = np.arange(len(row)) - np.repeat(np.cumsum(long) - long, long)
            out[row, place] = codes[np.repeat(ends[some], long) + place]
            yield Chunk(h[some], y[some], out)

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 4 * CHUNK_ROWS:
            yield from packed()
            held, rows = [], 0
    if rows:
        yield from packed()


class Held:
    """Rows in this process."""

    def __init__(self, chunks: list[Chunk], plan: Plan) -> None:
        self.chunks, self.plan = chunks, plan

    def begin(self, number: int) -> None:
        for c in self.chunks:
            c.begin(self.plan, number)

    def count(self, tree: Tree, level: int, slot_of: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        total = None
        for c in self.chunks:
            if level:
                c.descend(tree)
            found = c.count(self.plan, slot_of, slots)
            total = found if total is None else tuple(np.add(t, f, out=t) for t, f in zip(total, found))
        return total

    def finish(self, tree: Tree, weight: float) -> None:
        for c in self.chunks:
            c.descend(tree)
            c.finish(tree, weight)


class Dealt:
    """Rows that stay with the executors. A level is a job; predictions follow the rows as an RDD of their own."""

    def __init__(self, spark: SparkSession, blocks, plan: Plan) -> None:
        use_checkpoints(spark)
        self.blocks, self.plan, self.number = blocks.persist(StorageLevel.MEMORY_AND_DISK), plan, 0
        self.so_far = self.blocks.map(lambda c: c.so_far).persist(StorageLevel.MEMORY_AND_DISK)
        self.olden = []

    def begin(self, number: int) -> None:
        self.number = number

    def _ready(self, tree: Tree | None, level: int):
        plan, number = self.plan, self.number

        def ready(pair) -> Chunk:
            chunk, chunk.so_far = pair
            chunk.begin(plan, number)
            for _ in range(level):
                chunk.descend(tree)
            return chunk

        return self.blocks.zip(self.so_far).map(ready)

    def count(self, tree: Tree, level: int, slot_of: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        plan = self.plan

        def add(a, b):
            return tuple(x + y for x, y in zip(a, b))

        def counted(chunks: Iterator[Chunk]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            total = None
            for c in chunks:
                found = c.count(plan, slot_of, slots)
                total = found if total is None else add(total, found)
            if total is not None:
                yield total

        out = self._ready(tree, level).mapPartitions(counted).treeReduce(add)
        if not level:  # by now the predictions are there, and those they came from can go
            for rdd in self.olden:
                rdd.unpersist()
            self.olden = []
        return out

    def finish(self, tree: Tree, weight: float) -> None:
        def finished(chunk: Chunk) -> np.ndarray:
            chunk.finish(tree, weight)
            return chunk.so_far

        self.olden.append(self.so_far)
        self.so_far = self._ready(tree, self.plan.depth).map(finished).persist(StorageLevel.MEMORY_AND_DISK)
        if self.number % CUT_EVERY == CUT_EVERY - 1:
            self.so_far.checkpoint()

    def close(self) -> None:
        for rdd in (*self.olden, self.so_far, self.blocks):
            rdd.unpersist()


# --- trees -------------------------------------------------------------------------------------------

def _best_splits(found: np.ndarray, whole: np.ndarray, bins: Bins, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain and code of the best split of each slot, and rows and residuals up to that code. A split lies behind a bin, and has
    no gain where a side would have fewer than ``leaf`` rows. Of equal ones the first feature's first."""
    up_to = found[:, :, :-1].copy()
    up_to[:, :, bins.first + bins.zero] = whole[:2, :, None] - np.add.reduceat(up_to, bins.first, axis=2)  # rows that list no bin
    for step in range(1, int(bins.size.max())):
        at = bins.first[bins.size > step] + step
        up_to[:, :, at] += up_to[:, :, at - 1]
    n, total = whole[0][:, None], whole[1][:, None]
    n_left, left = up_to
    usable = (n_left >= leaf) & (n - n_left >= leaf)
    usable[:, bins.first + bins.size - 1] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(usable, left * left / n_left + (total - left) ** 2 / (n - n_left) - total * total / n, -np.inf)
    best = gain.argmax(axis=1)
    at = np.arange(len(best))
    return gain[at, best], best, up_to[:, at, best]


def _grow(rows: Held | Dealt, number: int, bins: Bins, plan: Plan) -> tuple[Tree, list[dict]]:
    """One tree, level by level."""
    nodes: list[dict] = []
    tree = Tree(*(np.zeros(1, t) for t in (np.int32, np.int32, np.int64, np.int64, bool, np.float64)))
    slot_of, counted, known = np.zeros(1, np.int64), [0], {}
    rows.begin(number)
    for level in range(plan.depth if len(bins.features) else 1):
        found, whole = rows.count(tree, level, slot_of, len(counted))
        if not level:
            nodes.append({"whole": whole[:, 0]})
        # A sibling that was not counted is what its parent has besides.
        here = {node: (found[:, s], whole[:, s]) for s, node in enumerate(counted)}
        for node in counted if level else ():
            parent, other = nodes[node]["parent"], nodes[node]["sibling"]
            nodes[node]["whole"] = here[node][1]
            nodes[other]["whole"] = known[parent][1] - here[node][1]
            here[other] = (known[parent][0] - here[node][0], nodes[other]["whole"])
        known, order = here, sorted(here)
        if not len(bins.features):
            break
        gains, codes, ups = _best_splits(np.stack([known[i][0] for i in order], 1), np.stack([known[i][1] for i in order], 1), bins, plan.leaf)
        counted = []
        for i, (node, gain, code) in enumerate(zip(order, gains, codes)):
            n, total, squares = nodes[node]["whole"]
            if not gain > 1e-12 * squares:
                continue
            owner, (n_left, left) = bins.owner[code], ups[:, i]
            at = len(nodes)
            nodes[node] |= {"gain": gain / n, "left": at, "right": at + 1, "owner": int(owner), "code": int(code)}
            nodes.append({"parent": node, "sibling": at + 1, "whole": np.array([n_left, left, 0.0])})
            nodes.append({"parent": node, "sibling": at, "whole": np.array([n - n_left, total - left, 0.0])})
            counted.append(at if 2 * n_left <= n else at + 1)
        tree = _tree(nodes, bins, plan.scale)
        if not counted:
            break
        slot_of = np.full(len(nodes), -1, np.int64)
        slot_of[counted] = np.arange(len(counted))
    return _tree(nodes, bins, plan.scale), nodes


def _tree(nodes: list[dict], bins: Bins, scale: float) -> Tree:
    def column(kind: type, of: Callable[[dict], float]) -> np.ndarray:
        return np.array([of(n) if "left" in n else 0 for n in nodes], kind)

    def start(n: dict) -> int:  # where zero goes right, the codes that go left are looked for, else those that go right
        return bins.first[n["owner"]] if zero_right(n) else n["code"] + 1

    def zero_right(n: dict) -> bool:
        return bins.first[n["owner"]] + bins.zero[n["owner"]] > n["code"]

    def end(n: dict) -> int:
        return n["code"] + 1 if zero_right(n) else bins.first[n["owner"]] + bins.size[n["owner"]]

    whole = np.array([n["whole"] for n in nodes])
    return Tree(column(np.int32, lambda n: n["left"]), column(np.int32, lambda n: n["right"]), column(np.int64, start),
                column(np.int64, lambda n: end(n) - start(n)), column(bool, lambda n: not zero_right(n)),
                whole[:, 1] / np.maximum(whole[:, 0], 1) / scale)


def _boost(rows: Held | Dealt, bins: Bins, plan: Plan) -> list[dict]:
    """The nodes of all trees."""
    out = []
    for number in range(plan.trees):
        tree, nodes = _grow(rows, number, bins, plan)
        if number + 1 < plan.trees:
            rows.finish(tree, 1.0 if number == 0 else plan.rate)
        for at, node in enumerate(nodes):
            n, total, squares = map(float, node["whole"])
            split = "left" in node
            out.append({
                "tree": number, "id": at, "n": n, "total": total / plan.scale, "squares": squares / plan.scale ** 2,
                "gain": float(node["gain"]) / plan.scale ** 2 if split else -1.0, "left": node.get("left", -1), "right": node.get("right", -1),
                "feature": int(bins.features[node["owner"]]) if split else -1,
                "threshold": float(bins.limits[node["owner"]][node["code"] - bins.first[node["owner"]]]) if split else None})
    return out


# --- estimator -----------------------------------------------------------------------------------------

class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Gives a ``GBTRegressionModel``. Rows are drawn for a tree by a hash of ``keyCol``, so they are the same in every run."""

    keyCol = Param(Params._dummy(), "keyCol", "column that tells rows apart", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "weight of all trees but the first", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf at least", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows for each tree", TypeConverters.toFloat)
    localBytes = Param(Params._dummy(), "localBytes", "size up to which one task holds the rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol=None, labelCol=None, predictionCol=None, keyCol=None, maxIter=None, stepSize=None, maxDepth=None,
                 minInstancesPerNode=None, subsamplingRate=None, seed=None, localBytes=None):
        super().__init__()
        self._setDefault(maxIter=20, stepSize=0.1, maxDepth=5, minInstancesPerNode=1, subsamplingRate=1.0, localBytes=LOCAL_BYTES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        spark, of = dataset.sparkSession, self.getOrDefault
        ship_package(spark)
        rows = dataset.select(F.xxhash64(F.col(of("keyCol")).cast("string")).alias("h"), F.col(self.getLabelCol()).cast("double").alias("y"),
                              F.col(self.getFeaturesCol()).alias("v"))
        seen = rows.agg(F.count("*").alias("n"), F.max(F.abs("y")).alias("y")).first()
        if not seen.n:
            raise ValueError("no rows to learn from")
        share = min(1.0, max(BINS * BINS, LIMIT_ROWS) / seen.n)
        drawn = rows.filter(F.pmod(F.xxhash64("h", F.lit(self.getSeed())), F.lit(1 << 30)) < int(share * (1 << 30))).select("v")
        found = drawn.repartition(1).mapInArrow(_limits_of(BINS), LIMITS_SCHEMA).collect()
        bins = Bins({r.feature: r.limits for r in found})
        binned = staged(rows.mapInArrow(bins.cut, ROWS_SCHEMA), "binned")
        # Sums of residuals stay below 2 ** 52, with the doubled residuals of labels not above a power of two.
        scale = 2.0 ** math.floor(49 - math.log2(seen.n) - math.log2(max(seen.y, 1e-9)))
        plan = Plan(of("maxIter"), of("stepSize"), of("maxDepth"), of("minInstancesPerNode"), of("subsamplingRate"), self.getSeed(), scale, bins.codes)
        size = binned.agg(F.sum(F.length("codes") + F.lit(ROW_BYTES))).first()[0]
        nodes = _in_a_task(binned, bins, plan) if size <= of("localBytes") else _by_jobs(binned, bins, plan)
        width = rows.select(F.col("v")).first().v.size
        return self._model(spark, nodes, width)

    def _model(self, spark: SparkSession, nodes: list[dict], width: int) -> GBTRegressionModel:
        """MLlib's model, by way of the files that it saves."""
        of, path = self.getOrDefault, staging_path(spark, "trees")
        shared = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "predictionCol": self.getPredictionCol(), "impurity": "variance",
                  "maxDepth": of("maxDepth"), "minInstancesPerNode": of("minInstancesPerNode"), "seed": self.getSeed()}

        def about(kind: str, params: dict, **more) -> str:
            return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": 0, "sparkVersion": spark.version,
                               "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": params, "defaultParamMap": {}, **more})

        params = shared | {"maxIter": of("maxIter"), "stepSize": of("stepSize"), "subsamplingRate": of("subsamplingRate")}
        head = about("GBTRegressionModel", params, numFeatures=width, numTrees=of("maxIter"))
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        trees = [(i, about("DecisionTreeRegressionModel", shared, numFeatures=width), 1.0 if i == 0 else of("stepSize")) for i in range(of("maxIter"))]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        listed = []
        for r in nodes:
            n = max(r["n"], 1.0)
            mean = r["total"] / n
            listed.append((r["tree"], (
                r["id"], mean, max(r["squares"] / n - mean * mean, 0.0), [r["n"], r["total"], r["squares"]], int(r["n"]), r["gain"], r["left"], r["right"],
                (r["feature"], [] if r["threshold"] is None else [r["threshold"]], -1))))
        spark.createDataFrame(listed, "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
                              "rawCount long, gain double, leftChild int, rightChild int, split struct<featureIndex int, "
                              "leftCategoriesOrThreshold array<double>, numCategories int>>").coalesce(1).write.parquet(f"{path}/data")
        return GBTRegressionModel.load(path)


def _in_a_task(binned: DataFrame, bins: Bins, plan: Plan) -> list[dict]:
    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Held(list(_chunks(batches, bins.kind, bins.codes)), plan)
        if rows.chunks:
            names = [c.split()[0] for c in NODES_SCHEMA.split(", ")]
            kinds = {"int": pa.int32(), "double": pa.float64()}
            schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in NODES_SCHEMA.split(", ")])
            found = _boost(rows, bins, plan)
            del rows
            give_back()
            yield from pa.table({c: [r[c] for r in found] for c in names}, schema).to_batches()

    return binned.coalesce(1).mapInArrow(boost, NODES_SCHEMA).toArrow().to_pylist()


def _by_jobs(binned: DataFrame, bins: Bins, plan: Plan) -> list[dict]:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, bins.kind, bins.codes):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chunk)], pa.binary())], ["chunk"])

    blocks = binned.mapInArrow(packed, "chunk binary").rdd.map(lambda r: pickle.loads(r.chunk))
    rows = Dealt(binned.sparkSession, blocks, plan)
    try:
        return _boost(rows, bins, plan)
    finally:
        rows.close()
