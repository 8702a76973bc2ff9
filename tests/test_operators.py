import random
import statistics

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from vacantia.operators import dedup, keys, median, merge, profile, topk


def test_latest_per_key_with_hot_key(spark):
    rows = [(1 if i % 3 else i, i, f"2024-01-{i % 28 + 1:02d}" if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "offre_id INT, n INT, d STRING").withColumn("date_creation", F.to_timestamp("d"))
    out = {r.offre_id: r for r in dedup.latest_per_key(df).collect()}
    assert len(out) == len({r[0] for r in rows})
    assert out[1].d == max(d for k, _, d in rows if k == 1 and d)


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("offre_id"), F.current_timestamp().alias("date_creation"))
    plan = plan_of(dedup.latest_per_key(df))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_cross_source_copies_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS offre_id", "CAST(id % 3 AS STRING) AS titre", "CAST(id AS STRING) AS entreprise",
                                     "CAST(id AS STRING) AS ville", "CAST(id % 2 AS STRING) AS source")
    plan = plan_of(dedup.best_source_per_posting(df))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.index("Partial")


def test_best_source(spark):
    rows = [("b", "Data-Engineer!", "ACME", None, "adzuna"), ("a", "DataEngineer", "ACME", None, "france_travail"),
            ("c", "Data Engineer", None, "ACME", "emploima"), ("e", "dataengineer", "ACME", None, "other")]
    df = spark.createDataFrame(rows, "offre_id STRING, titre STRING, entreprise STRING, ville STRING, source STRING")
    assert sorted(r.offre_id for r in dedup.best_source_per_posting(df).collect()) == ["a", "c"]


@pytest.mark.parametrize("n", [0, 1, 50, 5000])
def test_dense_ids(spark, n):
    rng = random.Random(n)
    values = sorted({(rng.choice([None, "é", "a", "b"]), rng.randint(0, 10 * n)) for _ in range(n)},
                    key=lambda v: (v[0] is not None, (v[0] or "").encode(), v[1]))
    df = spark.createDataFrame(random.sample(values, len(values)), "a STRING, b INT")
    out = [(r.id, r.a, r.b) for r in keys.dense_ids(df, ["a", "b"], "id").orderBy("id").collect()]
    assert out == [(i, *v) for i, v in enumerate(values, start=1)]


def test_dense_ids_do_not_sort_in_one_task(spark):
    plan = plan_of(keys.dense_ids(spark.range(100).distinct(), ["id"], "n"))
    main = plan.split("Subquery")[0]
    assert "SinglePartition" not in main


def test_hash_key_keeps_null_places(spark):
    row = spark.sql("SELECT CAST(NULL AS STRING) AS n, 'a' AS a").select(
        keys.hash_key(F.col("n"), F.col("a")), keys.hash_key(F.col("a"), F.col("n"))).first()
    assert row[0] != row[1]


def test_median_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else rng.choice(["x", "y", None]), rng.choice([None, float(rng.randint(-3000, 9000)) / 2, 1234.5]))
            for i in range(3000)] + [("none", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(5)
    out = {r.g: r for r in median.aggregate_with_median(df.withColumn("n", F.lit(1)), ["g"], "v", "m", ["n"]).collect()}
    groups = {g for g, _ in rows}
    assert set(out) == groups
    for g in groups:
        known = [v for k, v in rows if k == g and v is not None]
        assert out[g].m == (statistics.median(known) if known else None)
        assert out[g].n == sum(k == g for k, _ in rows)
    whole = median.aggregate_with_median(df, [], "v", "m").collect()
    assert [r.m for r in whole] == [statistics.median(v for _, v in rows if v is not None)]


def test_median_with_weights(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 2000.0, 1), ("a", 3000.0, 6)], "g STRING, v DOUBLE, w INT")
    assert median.aggregate_with_median(df, ["g"], "v", "m", weight="w").first().m == (2000.0 + 3000.0) / 2


def test_median_has_no_percentile_state(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    plan = plan_of(median.aggregate_with_median(df, ["g"], "v", "m"))
    assert "percentile" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


POSTING = "offre_id STRING, titre STRING, date_creation STRING"


def test_insert_ignore_twice_adds_nothing(spark):
    target = spark.createDataFrame([("1", "old", "2024")], POSTING)
    batch = spark.createDataFrame([("1", "new", "2025"), ("2", "b", "2024"), ("2", "c", "2025")], POSTING)
    once = merge.insert_ignore(target, batch, order=(F.col("date_creation").desc(),))
    assert sorted((r.offre_id, r.titre) for r in once.collect()) == [("1", "old"), ("2", "c")]
    assert merge.new_rows(once, batch).count() == 0


def test_delete_insert(spark):
    target = spark.createDataFrame([("1", "old", "x"), ("2", "old", "x")], POSTING)
    batch = spark.createDataFrame([("2", "new", "x"), ("3", "new", "x")], POSTING)
    out = merge.delete_insert(target, batch).collect()
    assert sorted((r.offre_id, r.titre) for r in out) == [("1", "old"), ("2", "new"), ("3", "new")]


def test_sync_schema(spark):
    out = merge.sync_schema(spark.createDataFrame([(1, 2)], "a INT, gone INT"), spark.createDataFrame([(3, 4)], "new INT, a INT"))
    assert out.columns == ["new", "a"]
    assert sorted(map(tuple, out.collect()), key=str) == [(3, 4), (None, 1)]


def test_upsert_keeps_id_and_creation(spark):
    day = "TIMESTAMP '2024-01-0"
    existing = spark.sql(f"SELECT 7L AS candidat_id, 'N' AS nom, 'P' AS prenom, 'a@x' AS email, 'cv' AS texte_cv, 'sql' AS competences, {day}1' AS created_at, {day}1' AS updated_at")
    incoming = spark.sql(
        f"SELECT 'N2' AS nom, 'P2' AS prenom, 'a@x' AS email, 'cv2' AS texte_cv, 'r' AS competences, {day}2' AS updated_at "
        f"UNION ALL SELECT 'N3', 'P3', 'a@x', 'cv3', 'go', {day}3' UNION ALL SELECT 'M', 'Q', 'b@x', 'c', '', NULL")
    now = F.to_timestamp(F.lit("2024-02-01"))
    out = {r.email: r for r in merge.upsert_candidates(existing, incoming, now).collect()}
    assert (out["a@x"].candidat_id, out["a@x"].nom, out["a@x"].created_at.day, out["a@x"].updated_at.day) == (7, "N3", 1, 3)
    assert out["b@x"].candidat_id is not None and str(out["b@x"].created_at).startswith("2024-02-01")
    again = merge.upsert_candidates(spark.createDataFrame(list(out.values())), incoming, now)
    assert {r.email: r.candidat_id for r in again.collect()} == {e: r.candidat_id for e, r in out.items()}


def test_update_predictions_guard(spark):
    fact = spark.sql(
        "SELECT * FROM VALUES ('1', 10, NULL, NULL), ('2', NULL, NULL, NULL), ('3', NULL, 5, 'haute'), "
        "('4', NULL, 5, 'basse (fallback)'), ('5', NULL, NULL, NULL) AS t(offre_id, salaire_min, p, salaire_confiance)"
    ).select("offre_id", "salaire_min", F.col("p").cast("decimal(10,2)").alias("salaire_predit_eur"),
             F.col("salaire_confiance").cast("string").alias("salaire_confiance"), F.lit(None).cast("timestamp").alias("date_prediction"))
    predictions = spark.createDataFrame([(str(i), 900.0 + i) for i in range(1, 5)] + [("5", None)], "offre_id STRING, salaire_predit_eur DOUBLE")
    out = {r.offre_id: r for r in merge.update_predictions(fact, predictions, F.current_timestamp()).collect()}
    assert [out[i].modifie for i in "12345"] == [False, True, False, True, False]
    assert float(out["4"].salaire_predit_eur) == 904.0 and out["4"].salaire_confiance == "moyenne"
    assert out["1"].salaire_predit_eur is None and out["3"].salaire_confiance == "haute"
    only_empty = merge.update_predictions(fact, predictions, F.current_timestamp(), "basse (fallback)", replace_fallback=False)
    assert only_empty.filter("modifie").count() == 1


def brute_force(q, items, k):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    scores = np.round(unit(q) @ unit(items).T, 9)
    return {(i, int(j), r + 1) for i in range(len(q))
            for r, j in enumerate(sorted(range(len(items)), key=lambda j: (-scores[i, j], j))[:k])}


@pytest.mark.parametrize("blocks", [False, True])
def test_top_k_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(23, 6))
    items = rng.normal(size=(300, 6))
    items[::3] = items[0]  # a third are copies, so ties decide
    items[5] = 0
    def frame(m):
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id LONG, vector ARRAY<DOUBLE>")
    options = dict(broadcast_bytes=0, query_block_rows=7, item_block_rows=40) if blocks else {}
    out = topk.top_k_similar(frame(q), frame(items).repartition(5), 7, "id", "id", **options)
    assert {(r.query_id, r.item_id, r.rang) for r in out.collect()} == brute_force(q, items, 7)
    plan = plan_of(out)
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_k_text_ids_and_empty_sides(spark):
    q = spark.createDataFrame([("c", [1.0, 0.0])], "id STRING, vector ARRAY<FLOAT>")
    items = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 2.0]), ("z", None)], "id STRING, vector ARRAY<FLOAT>")
    out = topk.top_k_similar(q, items, 5, "id", "id").orderBy("rang").collect()
    assert [(r.item_id, r.score) for r in out] == [("x", 1.0), ("y", 0.0)]
    assert topk.top_k_similar(q.limit(0), items, 5, "id", "id").count() == 0
    assert topk.top_k_similar(q, items.limit(0), 5, "id", "id", broadcast_bytes=0).count() == 0


def test_top_k_multiplies_few_pairs_twice(monkeypatch):
    """Scores closer than single precision tells apart, copies, a zero vector; several slices of items."""
    monkeypatch.setattr(topk, "ITEMS_AT_ONCE", 300)
    rng = np.random.default_rng(8)
    items = rng.normal(size=(2_000, 32))
    items[100:140] = items[0] + 3e-4 * rng.normal(size=(40, 32))
    items[200:500] = items[1]
    items[7] = 0
    items /= np.where((norms := np.linalg.norm(items, axis=1, keepdims=True)) == 0, 1, norms)
    q = np.concatenate([items[:60], np.zeros((1, 32))])
    kept = topk.Kept(pa.array([f"q{i}" for i in range(len(q))]), q, 9)
    exact, whole = [], []
    monkeypatch.setattr(kept, "_keep", lambda rows, *rest, keep=kept._keep: (exact.append(len(rows)), keep(rows, *rest)))
    monkeypatch.setattr(kept, "_whole", lambda rows, *rest, keep=kept._whole: (whole.append(len(rows)), keep(rows, *rest)))
    kept.offer(pa.array(np.arange(len(items))), items)
    scores = np.round(q @ items.T, 9)
    wanted = {(f"q{i}", j, scores[i, j]) for i in range(len(q)) for j in sorted(range(len(items)), key=lambda j: (-scores[i, j], j))[:9]}
    assert {tuple(r.values()) for r in kept.result().to_pylist()} == wanted
    assert sum(exact) < 0.1 * q.shape[0] * len(items) and sum(whole) <= 2 * 9 * 7  # the zero vector and the copied one


def test_top_k_rejects_mixed_lengths(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id LONG, vector ARRAY<DOUBLE>").coalesce(1)
    with pytest.raises(Exception, match="different length"):
        topk.top_k_similar(items.filter("id = 1"), items, 1, "id", "id").collect()


def test_null_rates_read_once(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a INT, b STRING")
    out = {r.colonne: (r.nb_nulls, r.pct_nulls) for r in profile.null_rates(df, {"a": "a", "bee": "b"}).collect()}
    assert out == {"a": (1, 33.3), "bee": (2, 66.7)}
    assert plan_of(profile.null_rates(spark.range(5), ["id"])).count("Range") == 1
    empty = profile.quality_report(df.limit(0), ["a"]).first()
    assert (empty.pct_nulls, empty.ok) == (0.0, True)


def test_field_profile(spark):
    rows = ['{"a": 1, "b": null}', '{"a": 2.5, "c": [1]}', '{"a": "x"}', "[1]", "broken {", None]
    df = spark.createDataFrame([(r,) for r in rows], "j STRING")
    out = {r.champ: (r.nb_lignes, r.nb_remplis, r.pct_remplis) for r in profile.field_profile(df, "j").collect()}
    assert out == {"a": (3, 3, 100.0), "b": (1, 0, 0.0), "c": (1, 1, 33.3)}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k INT")
    assert [tuple(r) for r in profile.duplicate_keys(df, "k").collect()] == [(2, 2)]


def test_settled_keys_are_distinct_and_stay(spark):
    rows = spark.createDataFrame([(f"n{i}", None if i % 7 == 0 else "x") for i in range(40)], "nom STRING, part STRING")
    first = keys.settle_keys(rows.limit(25), ["nom", "part"], "id", bits=6).collect()
    known = spark.createDataFrame(first)
    rest = rows.subtract(known.select("nom", "part"))
    more = keys.settle_keys(rest, ["nom", "part"], "id", known, bits=6).collect()
    ids = [r.id for r in first + more]
    assert len(ids) == 40 == len(set(ids)) and all(0 <= i < 64 for i in ids) and any(r.essai for r in first + more)
    assert sorted(map(tuple, keys.settle_keys(rest, ["nom", "part"], "id", known, bits=6).collect()), key=str) == sorted(map(tuple, more), key=str)
    wide = keys.settle_keys(rows, ["nom", "part"], "id")
    assert {r.essai for r in wide.collect()} == {0}
    with pytest.raises(ValueError):
        keys.settle_keys(rows, ["nom", "part"], "id", bits=5, attempts=5)


def test_exceptions_reach_the_fact(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y")], "nom STRING, part STRING")
    listed = spark.createDataFrame([(77, "b", None)], "id LONG, nom STRING, part STRING")
    parts = {"nom": F.col("nom"), "part": F.col("part")}
    out = keys.exact_keys(rows.withColumn("id", keys.hash_key(*parts.values())), "id", parts, listed)
    got = {r.nom: r.id for r in out.collect()}
    assert got["b"] == 77 and got["a"] != 77 and got["c"] != 77
