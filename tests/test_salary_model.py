import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, postings
from vacantia.plans import salary_model as sm


def rows(n=160):
    rng = random.Random(5)
    out = []
    for i in range(n):
        senior = i % 2
        pay = (5000 if senior else 2500) + rng.randint(-200, 200)
        out.append(dict(titre="Senior Data Engineer" if senior else "Développeur junior", description="spark kafka" if senior else "web",
                        pays="France", type_contrat="CDI", source="s", secteur=f"it {i % 3}", salaire_min=pay if i % 4 else None,
                        salaire_max=None))
    return out


SMALL = sm.ModelSettings(terms=20, trees=5, folds=2)


@pytest.fixture(scope="module")
def table(spark):
    return postings(spark, rows())


@pytest.fixture(scope="module")
def model(table):
    return sm.train(table, SMALL)


def test_features(spark):
    df = postings(spark, [dict(titre="Sr. Dev", pays="  FRANCE ", salaire_min=36000, salaire_max=48000, description="x" * 600),
                          dict(titre="Leader", description="on AWS")])
    a, b = sm.engineer_features(df).orderBy("offre_id").collect()
    assert (a.salaire_cible, a.is_senior, a.has_tech, a.pays, a.secteur) == (3500.0, 1, 0, "france", "inconnu")
    assert (b.salaire_cible, b.is_senior, b.has_tech) == (None, 0, 1) and len(a.texte) == len("sr. dev   ") + 600


def test_model_beats_the_mean(model, table):
    assert model.metrics["r2_score"] > 0.5 and model.metrics["cv_r2_mean"] > 0.5
    assert model.metrics["n_train"] + model.metrics["n_test"] == 120 and model.metrics["n_sans_salaire"] == 40


def test_split_does_not_depend_on_partitions(table):
    share = sm._share("offre_id", 42, 100) < 20
    ids = lambda df: sorted(r.offre_id for r in df.filter(share).select("offre_id").collect())
    assert ids(table) == ids(table.repartition(7))


def test_predictions_only_where_unknown(model, table):
    out = sm.predict_batch(model, table)
    assert out.filter("salaire_cible IS NOT NULL AND salaire_predit_eur IS NOT NULL").count() == 0
    got = [r.salaire_predit_eur for r in out.filter("salaire_cible IS NULL").collect()]
    assert len(got) == 40 and all(v >= 500 and round(v, 2) == v for v in got)


def test_records_and_unseen_values(spark, model):
    df = postings(spark, [dict(titre="Senior Lead", pays="Mars", secteur="new", type_contrat="CDI")])
    row = sm.prediction_records(model, df).first()
    assert row.fourchette_basse < row.salaire_estime_eur < row.fourchette_haute and row.confiance == "haute" and row.is_senior is True


def test_export(model, table):
    out = sm.prediction_export(sm.predict_batch(model, table), F.lit("2026-01-01"))
    assert out.columns == ["offre_id", "titre", "pays", "type_contrat", "salaire_cible", "salaire_predit_eur", "source_prediction", "generated_at"]
    assert out.first().source_prediction == "gradient_boosting_v1"


def test_save_load_reuse(spark, model, table, tmp_path):
    path = str(tmp_path / "m")
    assert sm.model_status(spark, path) == {"available": False}
    sm.save_model(model, spark, path)
    again = sm.train_or_load(table, path, settings=SMALL)
    assert again.metrics["r2_score"] == model.metrics["r2_score"]
    pick = lambda m: [r.salaire_predit_eur for r in sm.predict_batch(m, table).orderBy("offre_id").collect()]
    assert pick(again) == pick(model)
    assert sm.model_status(spark, path)["available"]


def test_named_categories_are_hashed(table):
    settings = sm.ModelSettings(terms=10, trees=2, folds=0, hashed=("secteur",))
    model = sm.train(table.withColumn("secteur", F.col("offre_id")), settings)
    hasher, = [s for s in model.pipeline.stages if type(s).__name__ == "FeatureHasher"]
    assert hasher.getInputCols() == ["secteur"] and model.metrics["n_train"] > 0


def test_too_few_rows(spark):
    with pytest.raises(ValueError):
        sm.train(postings(spark, rows(8)), SMALL)


def test_texts_are_cut_once_for_all_splits(table, monkeypatch):
    cut, plain = [], sm.RegexTokenizer.transform
    monkeypatch.setattr(sm.RegexTokenizer, "transform", lambda self, *a: cut.append(1) or plain(self, *a))
    model = sm.train(table, SMALL)
    assert len(cut) == 1 and [type(s).__name__ for s in model.pipeline.stages].count("RegexTokenizer") == 1


def test_weights_come_from_counts_and_not_from_texts_again(table):
    out = sm.term_weights(sm.engineer_features(table), 20)
    assert "texte" not in plan_of(out) and out.count() > 0
