import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from test_salary_model import rows as salary_rows
from helpers import postings
from vacantia.operators import boosting
from vacantia.plans import salary_model as sm

SETTINGS = dict(featuresCol="v", labelCol="y", predictionCol="p", maxIter=8, stepSize=0.1, maxDepth=4, minInstancesPerNode=3, seed=7)


@pytest.fixture(scope="module")
def table(spark):
    """Sparse and dense rows; features with few values, with many, below zero, constant and of one row."""
    rng = np.random.default_rng(3)
    n = 1500
    x = np.zeros((n, 12))
    x[:, 0] = rng.normal(size=n)
    x[:, 1] = rng.integers(0, 3, n)
    x[:, 2] = np.where(rng.random(n) < 0.2, rng.random(n), 0)
    x[:, 3] = (rng.random(n) < 0.5) * -1.5
    x[:, 4] = 2.0
    x[7, 5] = 1.0
    x[:, 6:] = np.where(rng.random((n, 6)) < 0.1, rng.exponential(size=(n, 6)), 0)
    y = 2000 + 300 * np.sin(2 * x[:, 0]) + 150 * x[:, 1] * (x[:, 2] > 0.3) + 90 * x[:, 3] + 40 * x[:, 6:].sum(axis=1) + rng.normal(size=n) * 20
    data = [(i, Vectors.dense(r) if i % 3 else Vectors.sparse(12, {int(j): float(r[j]) for j in np.flatnonzero(r)}), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ["id", "v", "y"]).repartition(3).cache()


def predictions(model, table):
    return np.array([r.p for r in model.transform(table).orderBy("id").select("p").collect()])


def test_same_trees_as_mllib(table):
    ours = boosting.BoostedTrees(keyCol="id", **SETTINGS).fit(table)
    theirs = GBTRegressor(subsamplingRate=1.0, **SETTINGS).fit(table)
    assert np.allclose(predictions(ours, table), predictions(theirs, table), atol=1e-3)
    assert ours.totalNumNodes == theirs.totalNumNodes and ours.numFeatures == 12 and ours.treeWeights == theirs.treeWeights
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)


def test_rows_of_executors_give_the_trees_of_one_task(table):
    drawn = dict(SETTINGS, maxIter=12, subsamplingRate=0.7, keyCol="id")
    one = boosting.BoostedTrees(**drawn).fit(table)
    many = boosting.BoostedTrees(localBytes=0, **drawn).fit(table.repartition(5))
    assert one.toDebugString.split("\n")[1:] == many.toDebugString.split("\n")[1:]


def test_small_chunks_change_nothing(spark, table, monkeypatch):
    binned = {}
    monkeypatch.setattr(boosting, "_in_a_task", lambda b, *a: binned.update(rows=b.toArrow(), plan=a) or [])
    with pytest.raises(Exception):  # no trees, no model
        boosting.BoostedTrees(keyCol="id", subsamplingRate=0.8, **SETTINGS).fit(table)
    bins, plan = binned["plan"]
    grown = []
    for size in (64, 5000):
        monkeypatch.setattr(boosting, "CHUNK_ROWS", size)
        grown.append(boosting._boost(boosting.Held(list(boosting._chunks(binned["rows"].to_batches(), bins.kind, bins.codes)), plan), bins, plan))
    assert len(grown[0]) > 8 and [(n["left"], n["feature"], n["threshold"], n["n"], n["total"]) for n in grown[0]] == [
        (n["left"], n["feature"], n["threshold"], n["n"], n["total"]) for n in grown[1]]


def test_constant_features_give_the_mean(spark):
    rows = spark.createDataFrame([(i, Vectors.dense([1.0, 0.0]), float(i)) for i in range(10)], ["id", "v", "y"])
    model = boosting.BoostedTrees(keyCol="id", **SETTINGS).fit(rows)
    assert np.allclose(predictions(model, rows), 4.5)
    with pytest.raises(ValueError):
        boosting.BoostedTrees(keyCol="id", **SETTINGS).fit(rows.limit(0))


def test_jobs_do_not_grow_with_trees(spark):
    """A job for each level of each tree made salary_train too long."""
    rows, jobs = postings(spark, salary_rows()), []
    for trees in (2, 9):
        group = f"trees-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        sm.train(rows, sm.ModelSettings(terms=20, trees=trees, folds=0))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_damped_counts_stay_sparse(spark):
    rows = spark.createDataFrame([(Vectors.sparse(4, {1: 1.0, 3: 4.0}),), (Vectors.dense([0.0, 2.0, 0.0, 1.0]),), (Vectors.sparse(4, {}),)], ["c"])
    tf = sm.SublinearCounts(inputCol="c", outputCol="t").transform(rows)
    sparse, dense, none = [r.t for r in tf.collect()]
    assert sparse.indices.tolist() == [1, 3] and np.allclose(sparse.values, [1, 1 + np.log(4)])
    assert np.allclose(dense.toArray(), [0, 1 + np.log(2), 0, 1]) and none.numNonzeros() == 0
    weighted = sm.SmoothIDF(inputCol="t", outputCol="w").fit(tf).transform(tf).first().w
    assert weighted.indices.tolist() == [1, 3] and np.allclose(weighted.values[0], 1 + np.log(4 / 3))
