"""A Merkle manifest of a table: a tree of digests for each language, and a tree over their roots.

The nodes of a tree are kept in an append log in postorder: a node is written when its last leaf has come, right after its
children's subtrees. Leaves are numbered in order, and runs of ``1 << CHUNK_BITS`` neighbours that begin at a multiple of that
length are built side by side, each by a builder that writes its nodes as they are completed. Their roots are the leaves of the
next tier, and so on to the root; the tiers are as many as the logarithm of the largest tree.

Where a node stands in the log follows from its height and index alone. Before leaf i come i leaves and one node for each pair
of subtrees joined so far, which makes 2i - popcount(i); a node stands as many places after its last leaf as it is high. So
builders need not know of each other, and a proof is read off by position: a right sibling stands as many places further as its
subtree has nodes, a left one as many places back as the node's own. Each chunk's proofs are extracted by one task of bounded size
from its part of the log, and the siblings above come down from the tier above with the chunk.

A node without a sibling becomes the digest of its own digest; its level has no sibling in the proof. Null values are ``-`` in a
leaf, so a null text and an empty one differ. A null language is a tree of its own and comes first. Rows without a doc_id come
first in their tree and are not tampered with; rows that share an id are ordered by leaf, and equal rows have a place each.
Texts are only hashed, whatever their length. An empty table gives no rows. Columns beyond the five are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm.common import sha256_hex, staged

CHUNK_BITS = 10
LOG = "tree string, n bigint, height int, index bigint, position bigint, digest string"
PATH = "array<struct<left:boolean,digest:string>>"


def document_leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row: each value with its length in bytes, so that no two rows read alike."""
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha256_hex(F.concat(*map(field, (doc_id, source, lang, n_chars, text))))


def tree_name(value: Column) -> Column:
    """A name for each value and for null, in the order null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows of each ``tree`` with ``index``, their place in order from 0, and ``n``, their number.

    Rows are dealt out in order and written once; places follow from the counts of the parts before, so no task holds a tree.
    """
    by = ["tree", *order, "__tie"]
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = staged(dealt.drop("__tie").withColumns({"__part": F.spark_partition_id(), "__at": row}), "numbered")
    runs = placed.groupBy("__part", "tree").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("__part", "tree", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__before"),
                       F.sum("__n").over(Window.partitionBy("tree")).alias("n"))
    return placed.join(runs, ["__part", "tree"]).withColumn("index", F.col("__at") + F.col("__before")).drop(
        "__part", "__at", "__before")


def position(height: int, index: np.ndarray, n: int) -> np.ndarray:
    """Where the nodes of a height stand in the log of a tree of ``n`` leaves."""
    last = np.minimum((index + 1) << height, n) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + height


def subtree_size(height: int, index: np.ndarray, n: int) -> np.ndarray:
    """How many nodes a subtree has, itself included."""
    last = np.minimum((index + 1) << height, n) - (index << height) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + height + 1


def _height(n: int) -> int:
    return (n - 1).bit_length()


def _builder(base: int, bits: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Builds the subtrees over a chunk of nodes of height ``base``; writes the nodes above them, leaves too."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        tree, n = key[0].as_py(), key[1].as_py()
        rows = rows.sort_by("index")
        last, top = (n - 1) >> base, min(_height(n), base + bits)
        heights, indexes, digests, waiting = [], [], [], {}
        for at, digest in zip(rows["index"].to_pylist(), rows["digest"].to_pylist()):
            height, index = base, at
            if base == 0:
                heights.append(0), indexes.append(at), digests.append(digest)
            while height < top:
                if index & 1:
                    digest = sha256((waiting.pop(height) + digest).encode()).hexdigest()
                elif at == last:
                    digest = sha256(digest.encode()).hexdigest()
                else:
                    waiting[height] = digest
                    break
                height, index = height + 1, index >> 1
                heights.append(height), indexes.append(index), digests.append(digest)
        of, where = np.array(heights, np.int32), np.array(indexes, np.int64)
        places = np.zeros(len(of), np.int64)
        for h in np.unique(of).tolist():
            places[of == h] = position(h, where[of == h], n)
        size = len(of)
        return pa.table([pa.array([tree] * size, pa.string()), pa.array(np.full(size, n)), pa.array(of), pa.array(where),
                         pa.array(places), pa.array(digests, pa.string())], ["tree", "n", "height", "index", "position", "digest"])

    return build


def append_log(leaves: DataFrame, bits: int = CHUNK_BITS) -> tuple[DataFrame, int]:
    """The log of all trees over (tree, n, index, digest), written to the shared folder, and the height of the tallest."""
    tallest = _height(leaves.agg(F.max("n")).first()[0] or 1)
    tiers, items = [], leaves.select("tree", "n", "index", "digest")
    for base in range(0, max(tallest, 1), bits):
        chunks = items.withColumn("chunk", F.shiftright("index", bits)).groupBy("tree", "n", "chunk")
        tiers.append(staged(chunks.applyInArrow(_builder(base, bits), LOG), f"log-{base}"))
        items = tiers[-1].where((F.col("height") == base + bits) & (F.col("n") > 1 << (base + bits))).select(
            "tree", "n", "index", "digest")
    log = tiers[0]
    for tier in tiers[1:]:
        log = log.unionByName(tier)
    return log, tallest


def roots(log: DataFrame) -> DataFrame:
    """(tree, n, digest) of the root of each tree."""
    return log.where((F.col("index") == 0) & (F.col("n") <= F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("height")))
                     ).select("tree", "n", "digest")


def _extractor(base: int, bits: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Adds to the nodes of height ``base`` in a chunk their siblings up to the root, read off the chunk's log by position."""
    def extract(key: tuple, items: pa.Table, log: pa.Table) -> pa.Table:
        n = key[1].as_py()
        above = [p for p in log["path"].to_pylist() if p is not None]
        above = above[0] if above else []
        log = log.filter(pa.compute.is_valid(log["position"])).sort_by("position")
        places = log["position"].to_numpy()
        at = items["index"].to_numpy()
        steps = max(min(_height(n), base + bits) - base, 0)
        found = np.full((len(at), steps + len(above)), -1, np.int64)  # in the digests of the log, then of what is above
        left = np.zeros(found.shape, bool)
        for k in range(steps):
            height, index = base + k, at >> k
            own, right = position(height, index, n), index % 2 == 1
            other = np.where(right, index - 1, index + 1)
            there = other << height < n
            wanted = np.where(right, own - subtree_size(height, index, n), own + subtree_size(height, np.where(there, other, index), n))
            found[there, k] = np.searchsorted(places, wanted[there])
            left[:, k] = right
        for k, step in enumerate(above, steps):
            found[:, k] = -1 if step["digest"] is None else len(places) + k - steps
            left[:, k] = step["left"]
        digests = pa.chunked_array([*log["digest"].chunks, pa.array([s["digest"] for s in above], pa.string())], pa.string())
        flat = found.ravel()
        taken = digests.take(pa.array(flat, mask=flat < 0))
        taken = taken.combine_chunks() if isinstance(taken, pa.ChunkedArray) else taken
        path = pa.ListArray.from_arrays(
            pa.array(np.arange(len(at) + 1, dtype=np.int32) * found.shape[1]),
            pa.StructArray.from_arrays([pa.array(left.ravel()), taken], ["left", "digest"]))
        return items.drop_columns(["chunk"]).append_column("path", path)

    return extract


def with_paths(leaves: DataFrame, log: DataFrame, tallest: int, outer: DataFrame | None = None,
               bits: int = CHUNK_BITS) -> DataFrame:
    """``leaves`` (tree, n, index and more columns) with ``path``, an entry for each level: whether the sibling is on the left,
    and its digest, null where the node has none. ``outer`` (tree, n, path) is what stands above a tree's root."""
    above = None
    for base in reversed(range(0, max(tallest, 1), bits)):
        height = F.col("height") - base
        part = log.where((height >= 0) & (height <= bits)).select(
            "tree", "n", F.call_function("shiftright", F.col("index"), F.lit(bits) - height).alias("chunk"), "position", "digest",
            F.lit(None).cast(PATH).alias("path"))
        if outer is not None:
            top_here = (F.col("n") <= 1 << (base + bits)) & ((F.col("n") > 1 << base) | F.lit(base == 0))
            ends = outer.where(top_here).select("tree", "n", F.lit(0).cast("bigint").alias("index"), "path")
            above = ends if above is None else above.unionByName(ends)
        if above is not None:
            part = part.unionByName(above.select("tree", "n", F.col("index").alias("chunk"), F.lit(None).cast("bigint").alias("position"),
                                                 F.lit(None).cast("string").alias("digest"), "path"))
        items = leaves if base == 0 else log.where((F.col("height") == base) & (F.col("n") > 1 << base)).select("tree", "n", "index")
        kinds = ", ".join(f"`{c}` {k}" for c, k in items.dtypes)
        key = ["tree", "n", "chunk"]
        above = items.withColumn("chunk", F.shiftright("index", bits)).groupBy(*key).cogroup(part.groupBy(*key)).applyInArrow(
            _extractor(base, bits), f"{kinds}, path {PATH}")
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    def step(so_far: Column, s: Column) -> Column:
        return sha256_hex(F.when(s["digest"].isNull(), so_far).when(s["left"], F.concat(s["digest"], so_far)).otherwise(
            F.concat(so_far, s["digest"])))

    return F.aggregate(path, digest, step)


def proof_digest(path: Column) -> Column:
    """The digest of the siblings, from the leaf up."""
    return sha256_hex(F.array_join(F.transform(path, lambda s: s["digest"]), ""))


@dataclass(frozen=True)
class Manifest:
    """``leaves`` with their paths up to ``root``; the log of the trees and (tree, n, digest) of each, in ``subroots``."""

    leaves: DataFrame
    log: DataFrame
    subroots: DataFrame
    root: str | None


def build_manifest(rows: DataFrame, *order: str, bits: int = CHUNK_BITS) -> Manifest:
    """The manifest of rows with ``tree`` (a name from ``tree_name``), ``digest`` and the columns they are ordered by."""
    leaves = numbered(rows, *order)
    log, tallest = append_log(leaves, bits)
    subroots = staged(roots(log), "subroots")
    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("n").alias("of_n"), "digest"), "of")
    top_log, top_tallest = append_log(tops, bits)
    outer = staged(with_paths(tops, top_log, top_tallest, bits=bits).select(
        F.col("of").alias("tree"), F.col("of_n").alias("n"), "path"), "outer-paths")
    root = roots(top_log).select("digest").first()
    return Manifest(with_paths(leaves, log, tallest, outer, bits), log, subroots, root and root[0])


def manifest_report(docs: DataFrame, every: int = 7) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row; the rows whose id's checksum ``every``
    divides are checked with one more in n_chars."""
    c = {k: F.col(k) for k in ("doc_id", "source", "lang", "n_chars", "text")}
    forged = document_leaf(**c | {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))})
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    rows = docs.select("doc_id", tree_name(F.col("lang")).alias("tree"), document_leaf(**c).alias("digest"),
                       F.when(chosen, forged).alias("forged"))
    made = build_manifest(rows, "doc_id", "digest")
    out = made.leaves.join(made.subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    root = F.lit(made.root).cast("string")
    folded = fold(F.coalesce("forged", "digest"), F.col("path"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == root)
