"""A quality classifier that can be read: a generalised additive model with pairwise interactions.

Every text becomes a few shares and lengths. Their values are put into bins. Boosting goes round the features in turn: a tree of
a few leaves on one feature's bins is fitted to what the model so far leaves unexplained, and a small part of it is added to
that feature's lookup table. Then the pairs of features that explain most of the rest get tables of their own in the same
way. A score is the sum of one number from each table, through the logistic function.

Fitting uses at most ``fit_rows`` labelled rows, those of least hash; the texts of all others are only scored. Several bags
of them are fitted at once, a task each, and the tables' means are the model, so the driver sees tables only.

Null texts count as empty and are scored like any other text. Labels other than 0 and 1 are ignored, and of repeated labels
the largest and of repeated documents the one of least features is used to fit. Without labels of both kinds the model is the share of the label there is, or one half.
Repeated rows are scored each for itself; other columns are not read.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.common import in_parts, staged
from vacantia.llm.quality_rules import BYTES_AT_ONCE, count_texts

FEATURES = ("log_words", "word_length", "symbols", "repeats", "dup_lines", "upper", "digits", "marks", "bars", "stops",
            "distinct", "line_words")


@dataclass(frozen=True)
class Boosting:
    fit_rows: int = 12_000
    bags: int = 4
    rounds: int = 60
    pair_rounds: int = 30
    pairs: int = 6
    bins: int = 32
    pair_bins: int = 8
    leaves: int = 4
    rate: float = 0.2
    penalty: float = 1.0  # on leaf values


def _of(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_KINDS = {"upper": _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _of("0123456789"), "marks": _of("!?"), "bars": _of("|"),
          "stops": _of(".,;:")}


def features_of(texts: pa.Array) -> np.ndarray:
    """A row of features for each text."""
    c = count_texts(texts)
    data = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    counts = np.bincount(data, minlength=256)
    shares = {}
    for name, kind in _KINDS.items():
        per_text = np.diff(np.concatenate([[0], np.cumsum(kind[data])])[edges]) if counts[kind].any() else np.zeros(len(texts))
        shares[name] = per_text / (chars if name in ("upper", "digits") else words)
    columns = {"log_words": np.log1p(c["n_words"]), "word_length": c["word_chars"] / words, "symbols": c["n_symbols"] / words,
               "repeats": c["n_repeat_words"] / words, "dup_lines": c["n_dup_lines"] / lines, **shares,
               "distinct": c["n_distinct_words"] / words, "line_words": np.log1p(c["n_words"] / lines)}
    return np.column_stack([columns[f] for f in FEATURES]).astype(float)


def features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        rows = np.concatenate([features_of(p) for p in in_parts(texts, BYTES_AT_ONCE)] or [np.zeros((0, len(FEATURES)))])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(rows.ravel()))

    return compute(text)


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Edges at quantiles; a value as large as an edge lies above it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def small_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Values by bin of the tree that splits the run of bins with the greatest gain, ``leaves`` - 1 times."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])

    def best(a: int, b: int) -> tuple[float, int]:
        cuts = np.arange(a + 1, b)
        if not len(cuts):
            return 0.0, a
        def worth(x, y): return (g[y] - g[x]) ** 2 / (h[y] - h[x] + penalty)
        gains = worth(a, cuts) + worth(cuts, b) - worth(a, b)
        i = int(np.argmax(gains))
        return float(gains[i]), int(cuts[i])

    runs = [(0, len(gradient))]
    for _ in range(leaves - 1):
        gain, cut, run = max(((*best(a, b), (a, b)) for a, b in runs), key=lambda x: x[0])
        if gain <= 1e-9:
            break
        runs.remove(run)
        runs += [(run[0], cut), (cut, run[1])]
    out = np.zeros(len(gradient))
    for a, b in runs:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return out


def small_pair_tree(gradient: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """The same for a grid: one cut of either feature, then the best cut of the other on each side."""
    best_gain, best_values = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, h = (gradient.T, weight.T) if turned else (gradient, weight)
        for cut in range(1, len(g)):
            values = np.zeros_like(g)
            for rows in (slice(0, cut), slice(cut, None)):
                values[rows] = small_tree(g[rows].sum(axis=0), h[rows].sum(axis=0), 2, penalty)
            gain = float((values * g - values ** 2 * (h / 2)).sum())
            if gain > best_gain:
                best_gain, best_values = gain, values.T if turned else values
    return best_values


@dataclass
class Model:
    """Edges and tables by feature, and tables by pair of features; ``intercept`` is the log odds of an average text."""
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, f], side="right")]
        coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, model_edges: list[np.ndarray], pair_edges: list[np.ndarray], s: Boosting) -> Model:
    """Boost the tables of single features in turn, then those of pairs."""
    share = np.clip(y.mean() if len(y) else 0.5, 0.001, 0.999)
    model = Model(float(np.log(share / (1 - share))) if len(y) else 0.0, model_edges, [np.zeros(len(e) + 1) for e in model_edges],
                  pair_edges, [], [])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model_edges)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(pair_edges)]
    total = np.full(len(y), model.intercept)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    def histograms(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = rest()
        return np.bincount(at, g, size), np.bincount(at, h, size)

    for _ in range(s.rounds):
        for f, table in enumerate(model.tables):
            step = s.rate * small_tree(*histograms(bins[f], len(table)), s.leaves, s.penalty)
            table += step
            total += step[bins[f]]
    offers = []
    for a, b in combinations(range(x.shape[1]), 2):
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        g, h = (v.reshape(shape) for v in histograms(coarse[a] * shape[1] + coarse[b], shape[0] * shape[1]))
        values = small_pair_tree(g, h, s.penalty)
        offers.append((float((values * g - values ** 2 * (h / 2)).sum()), a, b, shape))
    chosen = sorted(offers, key=lambda o: -o[0])[:s.pairs]
    model.pairs = [(a, b) for _, a, b, _ in chosen]
    model.pair_tables = [np.zeros(shape) for *_, shape in chosen]
    for _ in range(s.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            at = coarse[a] * table.shape[1] + coarse[b]
            step = s.rate * small_pair_tree(*(v.reshape(table.shape) for v in histograms(at, table.size)), s.penalty)
            table += step
            total += step.ravel()[at]
    return model


def mean_model(models: list[Model]) -> Model:
    """One model whose tables are the means; a pair that only some models have counts as zero in the others."""
    first, n = models[0], len(models)
    pairs = sorted({p for m in models for p in m.pairs})
    tables = {p: np.zeros((len(first.pair_edges[p[0]]) + 1, len(first.pair_edges[p[1]]) + 1)) for p in pairs}
    for m in models:
        for p, t in zip(m.pairs, m.pair_tables):
            tables[p] += t / n
    return Model(float(np.mean([m.intercept for m in models])), first.edges,
                 [np.mean(t, axis=0) for t in zip(*(m.tables for m in models))], first.pair_edges, pairs, [tables[p] for p in pairs])


def least_hashes(known: DataFrame, n: int) -> DataFrame:
    """The n rows of least hash of doc_id. Hashes are uniform, so a bound on them leaves a little more than n rows, and only
    these are put in order: what one task gets does not grow with the number of partitions or rows."""
    total = known.count()
    share = (n + 8 * n ** 0.5 + 64) / max(total, 1)  # eight standard deviations more than n
    if share < 1:
        known = known.where(F.xxhash64("doc_id") < int(-2 ** 63 + share * 2 ** 64))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def fit_on(docs: DataFrame, labels: DataFrame, settings: Boosting = Boosting(), label: str = "quality") -> Model:
    """A model of the labelled documents given. Both tables need doc_id."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    sample = least_hashes(staged(known, "labels"), settings.fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # fit_rows rows at most
    each = texts.select("doc_id", "label", features(F.col("text")).alias("x"))
    rows = staged(each.groupBy("doc_id", "label").agg(F.min("x").alias("x")), "features")  # of several texts, always the same one
    pieces = rows.select("x").toPandas()  # fit_rows rows of a dozen numbers at most
    x = np.array(pieces.x.tolist(), float).reshape(-1, len(FEATURES))
    edges, pair_edges = ([bin_edges(c, n) if len(c) else np.zeros(0) for c in x.T] for n in (settings.bins, settings.pair_bins))
    bags, s = settings.bags, settings

    def fit_bag(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        m = fit(np.array(rows.x.tolist(), float), rows.label.to_numpy(float), edges, pair_edges, s)
        model = asdict(m) | {"edges": None, "pair_edges": None, "tables": [t.tolist() for t in m.tables],
                             "pair_tables": [t.tolist() for t in m.pair_tables]}
        return pd.DataFrame({"model": [json.dumps(model)]})

    # Each row is in all bags but one.
    out_of = F.pmod(F.xxhash64("doc_id", F.lit("bag")), F.lit(bags))
    each = rows.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1)))).where((F.col("bag") != out_of) | F.lit(bags == 1))
    fitted = [json.loads(r.model) for r in each.groupBy("bag").applyInPandas(fit_bag, "model string").collect()]
    models = [Model(m["intercept"], edges, [np.array(t) for t in m["tables"]], pair_edges, [tuple(p) for p in m["pairs"]],
                    [np.array(t) for t in m["pair_tables"]]) for m in fitted]
    return mean_model(models) if models else fit(x, np.zeros(0), edges, pair_edges, settings)


def quality_score(text: Column, model: Model) -> Column:
    """The probability of label 1."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.score(features_of(p)) for p in in_parts(texts, BYTES_AT_ONCE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def score_quality(docs: DataFrame, labels: DataFrame, settings: Boosting = Boosting()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, by a model of the labels that are not held out."""
    model = fit_on(docs, labels.where(~held_out(F.col("doc_id"))), settings)
    scored = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                         quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
