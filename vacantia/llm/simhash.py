"""Near-copies by SimHash: fingerprints of 64 bits that differ in few bits are linked, and links make groups.

Links are found by the generalised pigeonhole principle. The bits are put into parts, correlated bits together. Each part i
gets a threshold t(i), -1 or more, with the sum of t(i) + 1 over the parts equal to ``distance`` + 1: two fingerprints
within ``distance`` bits then agree up to t(i) bits in some part, for if they did not, they would differ in more. A dynamic
program picks the thresholds with the fewest candidates, as estimated from counts of all fingerprints by part value.
Fingerprints meet in cells (part, value); a part with a threshold above 0 is also probed at the values around. Every
meeting is verified bit by bit.

Equal fingerprints are one row from the start, so groups of copies cost nothing. A cell of more than ``cell_rows`` rows is
dealt out as cells for each pair of its blocks. Cells don't emit pairs: each emits, for a fingerprint linked to others,
its link to the first of them, so that no more rows leave a cell than enter it. Groups come from these links by alternating
star contraction with a partial aggregate and a join in each round; no group is gathered anywhere.

A null text counts as empty, and a text without words has the fingerprint zero, linked like any other. Rows without a
doc_id are linked too but can't give a group its name; a group of such rows only has none. Repeated rows come once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.common import in_parts, lean, staged, without

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 14
BYTES_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Linking:
    """``parts`` of equal width must be 16 bits wide or less, which bounds the counts the driver sees."""

    shingle: int = 3
    distance: int = 3
    parts: int = 4
    cell_rows: int = 2048
    probe_cost: float = 20.0  # of a row moved, in comparisons


def fingerprint_of(text: str | None, shingle: int) -> int:
    """Bit b is set if it is set in more than half of the hashes of the shingles. Signed, as Spark's bigint."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts, stops = (ends[:n] - [len(w) + 1 for w in words[:n]]).tolist(), (ends[len(words) - n:] - 1).tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, SHINGLES_AT_ONCE):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + SHINGLES_AT_ONCE], stops[i:i + SHINGLES_AT_ONCE])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def fingerprint(text: Column, settings: Linking = Linking()) -> Column:
    """The fingerprint of each text, as bigint."""
    shingle = settings.shingle

    @F.arrow_udf("bigint")
    @lean
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for part in in_parts(texts, BYTES_AT_ONCE) for t in part.to_pylist()], pa.int64())

    return simhash(text)


def bit_moments(prints: DataFrame) -> np.ndarray:
    """How often each two bits are set together: 64 x 64, whatever the number of rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().astype(">i8")
            for i in range(0, len(values), 1 << 16):
                bits = np.unpackbits(values[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]
                x = np.column_stack([bits, np.ones(len(bits), np.uint8)]).astype(np.float32)
                total += (x.T @ x).astype(np.int64)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    rows = prints.select("print").mapInArrow(partial, "at bigint, n bigint").groupBy("at").agg(F.sum("n")).collect()
    out = np.zeros((BITS + 1) ** 2, np.int64)
    for at, n in rows:
        out[at] = n
    return out.reshape(BITS + 1, BITS + 1)


def correlated_parts(moments: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of equal width: each part starts with the bit most correlated with the rest, and takes the bits most
    correlated with what it has."""
    n = max(int(moments[-1, -1]), 1)
    p = moments[:-1, -1] / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((moments[:-1, :-1] / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    rest, out = list(range(BITS)), []
    for k in range(parts):
        width = len(rest) // (parts - k)
        part = [max(rest, key=lambda b: (related[b, rest].sum(), -b))]
        rest.remove(part[0])
        while len(part) < width:
            part.append(max(rest, key=lambda b: (related[b, part].sum(), -b)))
            rest.remove(part[-1])
        out.append(sorted(part))
    return out


def part_value(part: list[int]) -> Column:
    """The bits of a part, packed."""
    bits = [F.shiftleft(F.call_function("getbit", "print", F.lit(b)).cast("int"), i) for i, b in enumerate(part)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def candidates_by_threshold(counts: np.ndarray, width: int, most: int) -> list[float]:
    """Estimated meetings if a part's threshold is 0, 1, ..: for each value its count times the counts around it."""
    rings = [counts.astype(float)] + [np.zeros(len(counts)) for _ in range(most)]
    flipped = np.arange(len(counts))
    for b in range(width):
        other = flipped ^ (1 << b)
        rings = [rings[0]] + [rings[k] + rings[k - 1][other] for k in range(1, most + 1)]
    return np.cumsum([float(counts @ r) for r in rings]).tolist()


def allot(costs: list[list[float]], units: int) -> list[int]:
    """Units for each part, ``units`` in all, of least cost; costs[i][u] is the cost of u units. A threshold is u - 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for u in range(min(units - used, len(cost) - 1) + 1):
                offer = (total + cost[u], [*chosen, u])
                if used + u not in step or offer < step[used + u]:
                    step[used + u] = offer
        best = step
    return best[units][1]


def plan_parts(prints: DataFrame, settings: Linking) -> tuple[list[list[int]], list[int], DataFrame]:
    """The parts, their thresholds, and the counts by (part, value)."""
    parts = correlated_parts(bit_moments(prints), settings.parts)
    if max(map(len, parts)) > 16:
        raise ValueError("a part may have 16 bits at most")
    values = F.array(*[F.struct(F.lit(i).alias("part"), part_value(p).alias("value")) for i, p in enumerate(parts)])
    counts = staged(prints.select(F.explode(values).alias("cell")).groupBy("cell.part", "cell.value").agg(
        F.count("*").alias("n")), "part-counts")
    seen = counts.toPandas()  # 2**16 rows for a part at most
    n = int(seen.n[seen.part == 0].sum())
    costs = []
    for i, part in enumerate(parts):
        held = np.zeros(1 << len(part))
        own = seen[seen.part == i]
        held[own.value] = own.n
        meetings = candidates_by_threshold(held, len(part), settings.distance)
        probes = np.cumsum([float(len(list(combinations(range(len(part)), k)))) for k in range(settings.distance + 1)])
        costs.append([0.0, *[m + settings.probe_cost * n * p for m, p in zip(meetings, probes)]])
    return parts, [u - 1 for u in allot(costs, settings.distance + 1)], counts


def cells(prints: DataFrame, parts: list[list[int]], thresholds: list[int], counts: DataFrame, settings: Linking) -> DataFrame:
    """(cell, probe, print): fingerprints at their own values and, marked as probes, at the values around."""
    rows = []
    for i, (part, most) in enumerate(zip(parts, thresholds)):
        if most < 0:
            continue
        masks = [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(len(part)), k)]
        at = F.explode(F.array(*[F.lit(m) for m in masks])) if len(masks) > 1 else F.lit(0)
        rows.append(prints.select("print", part_value(part).alias("own"), at.alias("mask")).select(
            F.lit(i).alias("part"), F.col("own").bitwiseXOR(F.col("mask")).alias("value"),
            (F.col("mask") != 0).alias("probe"), "print"))
    every = reduce(DataFrame.unionByName, rows)
    around = max(len(list(combinations(range(16), k))) for k in range(max(thresholds) + 1))
    large = counts.where(F.col("n") * around > settings.cell_rows).select(  # cells that may need more than one block
        "part", "value", F.ceil(F.col("n") / settings.cell_rows).cast("int").alias("blocks"))
    every = every.join(F.broadcast(large), ["part", "value"], "left")  # 2**16 rows for a part at most
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    # A row of block b meets block j in the cell (lower, higher) of the two.
    each = every.withColumns({"blocks": blocks, "own": own}).withColumn(
        "other", F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))))
    return each.select("part", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                       "probe", "print")


def first_links(cell: np.ndarray, probe: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of a cell, as a star for each group linked in it.

    ``cell`` is sorted, and rows at their own values come before probes. Rows at distance d in that order are compared at
    once for all cells, for d = 1, 2, ..
    """
    n = len(cell)
    group = np.arange(n)
    left = np.flatnonzero(~probe)
    unsigned, step = prints.view(np.uint64), 1
    while True:
        left = left[left + step < n]
        left = left[cell[left] == cell[left + step]]
        if not len(left):
            break
        apart = left[group[left] != group[left + step]]
        near = apart[np.bitwise_count(unsigned[apart] ^ unsigned[apart + step]) <= distance]
        if len(near):
            group = _joined(group, near, near + step)
        step += 1
    linked = np.flatnonzero(group != np.arange(n))
    return prints[linked], prints[group[linked]]


def _joined(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``group`` (the first row of each row's group) after joining the groups of a[i] and b[i]."""
    group = group.copy()
    x, y = group[a], group[b]
    while True:
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            return group
        np.minimum.at(group, high[apart], low[apart])
        while not np.array_equal(group, up := group[group]):
            group = up
        x, y = group[low[apart]], group[high[apart]]


def links(prints: DataFrame, settings: Linking = Linking()) -> DataFrame:
    """(a, b): links that connect what fingerprints within the distance of each other connect. ``prints`` are distinct."""
    distance = settings.distance
    parts, thresholds, counts = plan_parts(prints, settings)
    at = ["part", "value", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pd.DataFrame] = []

        def found(rows: pd.DataFrame) -> pa.RecordBatch:
            key = rows[at].to_numpy()
            cell = np.cumsum(np.append(0, (key[1:] != key[:-1]).any(axis=1)))
            a, b = first_links(cell, rows.probe.to_numpy(), rows.print.to_numpy(), distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            kept.append(batch.to_pandas())
            if sum(map(len, kept)) >= ROWS_AT_ONCE:
                rows = pd.concat(kept, ignore_index=True)
                last = (rows[at].to_numpy() == rows[at].iloc[-1].to_numpy()).all(axis=1)
                if not last.all():  # the last cell may go on in the next batch
                    yield found(rows[~last])
                    rows = rows[last]
                kept = [rows]
        if kept:
            yield found(pd.concat(kept, ignore_index=True))

    dealt = cells(prints, parts, thresholds, counts, settings).repartition(*at).sortWithinPartitions(*at, "probe")
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of an edge is connected with, by alternating stars.

    Large star: the greater neighbours of a node are linked to its least neighbour. Small star: a node and its lesser
    neighbours are. Each round is written to the shared folder; the rounds end when nothing changes, after about the
    logarithm of the number of nodes.
    """
    edges, before = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        lesser = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lesser, "a").select(F.explode(F.array(
            F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
        edges, before = staged(small.select("e.a", "e.b").where("a <> b").distinct(), "links"), now


def _rooted(of_docs: DataFrame, settings: Linking) -> DataFrame:
    """(print, first, root): each distinct fingerprint, the smallest doc_id that has it, and the fingerprint that names its group."""
    prints = staged(of_docs.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    grouped = components(links(prints.select("print"), settings)).withColumnRenamed("node", "print")
    return prints.join(grouped, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_copies(docs: DataFrame, settings: Linking = Linking(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, print (bigint) and component_id, the smallest doc_id reachable, for each row.

    Texts are read once; ids and fingerprints go to the shared folder.
    """
    of_docs = staged(docs.select(F.col(doc).alias("doc_id"), fingerprint(F.col(text), settings).alias("print")), "prints")
    rooted = _rooted(of_docs, settings)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = staged(rooted.join(named, "root").select("print", "component_id"), "components")
    return of_docs.join(by_print, "print", "left").select("doc_id", "print", "component_id")


def print_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


KEYS = ("__id", "__text", "__row")


def _with_keys(docs: DataFrame) -> DataFrame:
    """The rows with what tells them apart: the id, a hash of the text, a hash of all columns that can be hashed."""
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return docs.withColumns({"__id": F.col("doc_id"), "__text": F.xxhash64("text"), "__row": F.xxhash64(*[F.col(f"`{c}`") for c in plain])})


def keep_first(docs: DataFrame, settings: Linking = Linking()) -> DataFrame:
    """One document of each group, with its columns: that of the smallest doc_id (none comes last), then of the least hashes of
    its text and its row.

    Documents are rows here: texts that share an id are judged each by its own group. Only keys are joined with the texts. Rows
    equal in everything are one group, of which one stays; no text is moved for that unless there are some.
    """
    seen = staged(_with_keys(docs).select(*KEYS, fingerprint(F.col("text"), settings).alias("print")), "rows")
    roots = staged(_rooted(seen.withColumnRenamed("__id", "doc_id"), settings).select("print", "root"), "roots")
    place = F.struct(F.col("__id").isNull().alias("none"), *KEYS)
    rooted = seen.join(roots, "print")
    first = staged(rooted.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    several = staged(rooted.join(first, "root").select(*KEYS, (place == F.col("first")).alias("stays")), "several")
    gone = staged(several.where("NOT stays").select(*[F.col(c).alias(f"{c}_gone") for c in KEYS]).distinct(), "copies")
    equal = several.where("stays").groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1")
    equal = staged(equal.select(*[F.col(c).alias(f"{c}_equal") for c in KEYS]), "equal")

    kept = without(_with_keys(docs), gone, KEYS, "_gone")
    if not equal.isEmpty():
        once = kept.join(equal, [F.col(c).eqNullSafe(F.col(f"{c}_equal")) for c in KEYS], "left_semi").dropDuplicates(list(KEYS))
        kept = without(kept, equal, KEYS, "_equal").unionByName(once)
    return kept.select(*docs.columns)
