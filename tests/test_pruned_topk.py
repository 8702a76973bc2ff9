import numpy as np
import pytest

from helpers import plan_of
from vacantia.operators import pruned_topk
from vacantia.operators.pruned_topk import centres_of, pruned_top_k
from vacantia.operators.topk import top_k_similar


def frame(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id LONG, vector ARRAY<DOUBLE>")


def brute_force(q, items, k):
    def unit(m):
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norms == 0, 1, norms)

    scores = np.round(unit(q) @ unit(items).T, 9)
    return {(i, int(j), r + 1) for i in range(len(q))
            for r, j in enumerate(sorted(range(len(items)), key=lambda j: (-scores[i, j], j))[:k])}


def found(out):
    return {(r.query_id, r.item_id, r.rang) for r in out.rows.collect()}


def clustered(rng, groups=20, each=60, width=16):
    return np.repeat(rng.normal(size=(groups, width)), each, axis=0) + 0.05 * rng.normal(size=(groups * each, width))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_block_rows": 7, "item_block_rows": 11},
                                     {"centres": 1, "rings": 1}])
def test_clusters_are_left_out(spark, options):
    rng = np.random.default_rng(5)
    items = clustered(rng)
    q = items[::40] + 0.01 * rng.normal(size=items[::40].shape)
    out = pruned_top_k(frame(spark, q), frame(spark, items).repartition(5), 7, "id", "id", **options)
    assert found(out) == brute_force(q, items, 7)
    assert out.pairs == len(q) * len(items)
    assert out.multiplied >= out.pairs if options.get("centres") == 1 else out.multiplied < 0.3 * out.pairs
    plan = plan_of(out.rows)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("k, sent", [(1, 0), (9, 0), (9, 1 << 20), (500, 1 << 20)])
def test_vectors_without_clusters(spark, k, sent):
    rng = np.random.default_rng(6)
    q, items = rng.normal(size=(19, 6)), rng.normal(size=(300, 6))
    items[::3] = items[0]  # a third are copies, so ties decide
    items[5] = items[7] = q[3] = 0
    q[4], q[5] = items[0], -items[0]
    out = pruned_top_k(frame(spark, q), frame(spark, items).repartition(5), k, "id", "id", item_block_rows=40, broadcast_bytes=sent)
    assert found(out) == brute_force(q, items, k)
    same = top_k_similar(frame(spark, q), frame(spark, items), k, "id", "id")
    assert sorted(map(tuple, out.rows.collect())) == sorted(map(tuple, same.collect()))


def test_text_ids_and_vectors_that_take_no_part(spark):
    kind = "id STRING, vector ARRAY<FLOAT>, score STRING"
    q = spark.createDataFrame([("c", [1.0, 0.0], "clash"), ("d", None, ""), ("e", [float("nan"), 0.0], "")], kind)
    items = spark.createDataFrame([("x", [1.0, 0.0], ""), ("y", [0.0, 2.0], ""), ("z", None, ""), ("n", [None, 1.0], ""),
                                   ("i", [float("inf"), 1.0], "")], kind)
    out = pruned_top_k(q, items, 5, "id", "id")
    assert [(r.query_id, r.item_id, r.score) for r in out.rows.orderBy("rang").collect()] == [("c", "x", 1.0), ("c", "y", 0.0)]
    for empty in (pruned_top_k(q.limit(0), items, 5, "id", "id"), pruned_top_k(q, items.limit(0), 5, "id", "id")):
        assert empty.rows.count() == 0 and empty.rows.columns == out.rows.columns and empty.pairs == 0


def test_all_items_zero(spark):
    q = np.ones((2, 3))
    assert found(pruned_top_k(frame(spark, q), frame(spark, np.zeros((4, 3))), 2, "id", "id")) == brute_force(q, np.zeros((4, 3)), 2)


def test_mixed_lengths(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id LONG, vector ARRAY<DOUBLE>")
    with pytest.raises(ValueError, match="different length"):
        pruned_top_k(items.filter("id = 1"), items, 1, "id", "id")


def test_centres_count_copies_once():
    rows = np.repeat(np.eye(3), [500, 1, 1], axis=0)
    assert sorted(centres_of(rows, 3).tolist()) == sorted(np.eye(3).tolist())
    assert len(centres_of(rows, 64)) == 3


def test_a_query_is_sent_once_to_a_block_of_cells(spark, monkeypatch):
    rng = np.random.default_rng(9)
    q, items = rng.normal(size=(40, 8)), rng.normal(size=(600, 8))
    sent, met = [], pruned_topk._met
    monkeypatch.setattr(pruned_topk, "_met", lambda probes, *rest: (sent.append(probes.count()), met(probes, *rest))[1])
    out = pruned_top_k(frame(spark, q), frame(spark, items), 7, "id", "id", broadcast_bytes=0, item_block_rows=200)
    assert found(out) == brute_force(q, items, 7)
    assert len(sent) == 2 and sent[1] <= len(q) * 6  # not once for each of some hundred cells
