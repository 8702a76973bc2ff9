import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import pivot_search as P

SMALL = P.Pivoting(pivots=4, sample=50, block_rows=20, blocks_at_once=3, queries_at_once=5, visits=4, step=2)


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def plain(rows, every, k=5):
    """Rows (id, vector) of distinct ids."""
    used = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for qi, q in used:
        if qi % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in used if i != qi and len(v) == len(q))
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, every, settings=SMALL, k=5):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"v": F.lit(1), "dim": F.lit("x"), "block": F.lit(0)})
    got = P.top_k_products(df.repartition(3), F.col("vec_id") % every == 0, k, settings)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()))


def vectors(n, dim, seed, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    rows = (centres[rng.integers(0, clusters, n)] + 0.1 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, list(map(float, v))) for i, v in enumerate(rows)]


@pytest.mark.parametrize("settings", [SMALL, P.Pivoting()])
def test_as_brute_force(spark, settings):
    rows = vectors(260, 8, 1)
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a hot vector, asked for as well
    rows += [(2000, None), (2010, [1.0, None] * 4), (2020, [math.nan] * 8), (2030, [math.inf] * 8), (None, [1.0] * 8), (2040, [0.0] * 8)]
    random.Random(2).shuffle(rows)
    want = plain(rows, 10)
    assert found(spark, rows, 10, settings) == want and len(want) > 150


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, -1.0]), (2, [1.0, 0.5])]
    assert found(spark, rows, 2) == plain(rows, 2)
    assert found(spark, [(0, [1.0])], 1) == []
    assert found(spark, [], 1) == []


def test_vectors_of_several_lengths(spark):
    rows = vectors(40, 3, 3) + [(100 + i, v) for i, v in vectors(30, 5, 4)] + [(200, []), (201, []), (210, [])]
    assert found(spark, rows, 5) == plain(rows, 5)


def test_repeated_rows(spark):
    """Equal rows are one query and each a candidate; a query is compared with no row of its id."""
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (0, [2.0, 2.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.5, 0.0])]
    one, two = 256 * 256, 512 * 256
    half = 256 * 128
    want = [(0, 1, 3, one), (0, 2, 3, one), (0, 3, 4, half), (0, 1, 3, two), (0, 2, 3, two), (0, 3, 4, one)]
    assert found(spark, rows, 10) == sorted(want)


def test_large_components_and_ties(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.choice([-2.5e6, 0, 2.5e6, 1])) for _ in range(2)]) for i in range(50)] + [(60, [1e30, 0.0])]
    assert found(spark, rows, 7) == plain([r for r in rows if r[0] != 60], 7)


def test_bounds_hold_and_save_products():
    rng = np.random.default_rng(6)
    rows = np.array([whole(v) for _, v in vectors(2000, 16, 7, clusters=20)])
    pivots = rows[rng.choice(len(rows), 16, replace=False)].astype(float)
    d = np.sqrt(((rows[:, None, :] - pivots[None]) ** 2).sum(axis=2)).astype(np.float32)
    norm = (rows * rows).sum(axis=1)
    bound = P.bounds(norm[:50], d[:50], norm, d, d)
    assert (bound >= rows[:50] @ rows.T).all()
    ids = np.arange(len(rows))
    i, j, s, made = P.best_of_block(ids[:50], rows[:50], bound, np.full(50, -np.inf), ids, rows, 5, 32)
    assert made < 0.3 * 50 * len(rows)
    for q in range(50):
        order = [x for x in np.lexsort((ids, -(rows @ rows[q]))) if x != q][:5]
        assert j[i == q].tolist() == order
