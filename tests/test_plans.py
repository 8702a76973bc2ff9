import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, postings
from vacantia.operators.merge import new_rows
from vacantia.plans import conform, gold, marts, pipeline, recommend, skills, star
from vacantia.plans.conform import sanitise
from vacantia.schema import CANDIDATE_SCHEMA, LABOUR_API, LABOUR_RECORD, LISTING_API, POSTING_COLUMNS, SCRAPED_SITE
from vacantia.sources.tables import read_current


def labour(id_, title, created, **more):
    return {"id": id_, "intitule": title, "dateCreation": created, **more}


LANDED = {
    LABOUR_API: [
        labour("A1", "  Data \t Engineer ", "2026-05-01T10:00:00Z", typeContrat="PERMANENT", lieuTravail={"libelle": "Paris"},
               entreprise={"nom": "ACME"}, salaire={"libelle": "30000 - 45000 EUR"}, description="Python et Spark"),
        labour("A1", "Data Engineer", "2026-05-03T10:00:00Z", typeContrat="PERMANENT", lieuTravail={"libelle": "Paris"},
               entreprise={"nom": "ACME"}, salaire={"libelle": "30000 - 45000 EUR"}, description="Python et Spark"),
        labour("A2", "BI", "2026-05-01T10:00:00Z"),
        labour("A3", "Data Analyst", "2026-05-02T10:00:00Z", salaire={"libelle": "Annuel de 35000.0 Euros à 45000.0 Euros"}),
    ],
    LISTING_API: [
        {"id": "B1", "title": "Data Engineer", "company": {"display_name": "ACME"}, "location": {"display_name": "Paris", "area": ["France"]}},
        {"id": "B2", "title": "ML Engineer", "location": {"display_name": "Lyon", "area": []}, "salary_min": 42000.9, "description": "SQL"},
        {"id": "B3", "title": "Data Scientist", "location": {"area": ["France", "IDF"]}, "contract_type": None},
    ],
    SCRAPED_SITE: [
        {"titre": "Data Architect", "entreprise": "X", "region": "Rabat", "date_publication": "18.05.2026", "url_offre": "https://x/1",
         "pays": "Maroc", "competences": "SQL"},
        {"titre": "Data Manager", "entreprise": "Y", "region": "Fès", "date_publication": "Non precise", "url": "https://x/2", "pays": "Maroc"},
    ],
}


@pytest.fixture()
def landed(tmp_path):
    paths = {}
    for source, records in LANDED.items():
        folder = tmp_path / "bronze" / source
        folder.mkdir(parents=True)
        (folder / "data.json").write_text(json.dumps({"source": source, "keyword": "data", "offres": records}, ensure_ascii=False, indent=1))
        paths[source] = f"{folder}/*.json"
    (tmp_path / "bronze" / LABOUR_API / "cut.json").write_text('{"source": "x", "offres": [{"id": "Z')
    (tmp_path / "bronze" / LABOUR_API / "none.json").write_text('{"source": "x", "offres": []}')
    return paths


def test_daily_job(spark, landed, tmp_path):
    lake = pipeline.Lake(str(tmp_path / "lake"))
    done = pipeline.run_daily(spark, landed, lake)
    assert done["sources"] == list(LANDED)
    unified = {r.offre_id: r for r in spark.read.parquet(lake.unified).collect()}
    assert len(unified) == 6 and {"A1", "A3", "B2", "B3"} <= set(unified)
    assert (unified["A1"].titre, unified["A1"].type_contrat, unified["A1"].salaire_min, unified["A1"].salaire_max) == (
        "Data Engineer", "CDI", 30000, 45000)
    assert unified["A1"].date_creation == dt.datetime(2026, 5, 3, 10)
    assert (unified["A3"].salaire_min, unified["A3"].entreprise) == (None, None)
    assert (unified["B2"].region, unified["B2"].salaire_min, unified["B3"].region, unified["B3"].type_contrat) == (None, 42000, "France", "Autre")
    scraped = {r.titre: r for r in unified.values() if r.source == SCRAPED_SITE}
    assert scraped["Data Architect"].date_creation == dt.datetime(2026, 5, 18) and scraped["Data Manager"].date_creation is None
    assert scraped["Data Manager"].url_offre == "https://x/2" and scraped["Data Architect"].secteur == "SQL"

    tables = pipeline.read_star(spark, lake)
    assert tables.fact.count() == 6 and tuple(tables.fact.columns) == star.FACT_COLUMNS
    joined = marts.flat_postings(tables)
    assert joined.count() == 6 and joined.filter("ville = 'Paris'").first().entreprise == "ACME"
    names = {r.nom for r in read_current(spark, lake.table("dim_competence")).collect()}
    assert {"Python", "Spark", "SQL", "R"} <= names
    assert done["gold"] == ["offres_par_source", "offres_par_contrat", "offres_par_ville", "salaires", "offres_par_mois", "offres_par_secteur"]
    assert {r.colonne: r.nb_nulls for r in done["quality"].collect()}["date_creation"] == 3

    rejects = {(r.source, r.lisible) for r in done["rejects"].collect()}
    assert (LABOUR_API, False) in rejects
    bridge = sorted(map(tuple, read_current(spark, lake.table("bridge_offre_competence")).collect()))
    dimension = sorted(map(tuple, read_current(spark, lake.table("dim_competence")).collect()))

    pipeline.run_daily(spark, landed, lake)  # the same files again change nothing
    assert pipeline.read_star(spark, lake).fact.count() == 6 and read_current(spark, lake.table("raw_offres")).count() == 6
    assert sorted(map(tuple, read_current(spark, lake.table("bridge_offre_competence")).collect())) == bridge
    assert sorted(map(tuple, read_current(spark, lake.table("dim_competence")).collect())) == dimension

    predictions = spark.createDataFrame([("A3", 3333.0), ("A1", 1.0)], "offre_id STRING, salaire_predit_eur DOUBLE")
    assert pipeline.apply_predictions(spark, lake, predictions, F.lit("2026-06-01").cast("timestamp")) == 1
    assert pipeline.apply_predictions(spark, lake, predictions, F.lit("2026-06-01").cast("timestamp")) == 0
    row = pipeline.read_star(spark, lake).fact.filter("offre_id = 'A3'").first()
    assert float(row.salaire_predit_eur) == 3333.0 and row.salaire_confiance == "moyenne"


def test_absent_source_is_skipped(spark, landed, tmp_path):
    lake = pipeline.Lake(str(tmp_path / "lake"))
    built = pipeline.build_silver(spark, {LABOUR_API: landed[LABOUR_API], LISTING_API: str(tmp_path / "no" / "*.json")}, lake)
    assert built == [LABOUR_API]
    with pytest.raises(ValueError):
        pipeline.build_silver(spark, {LISTING_API: str(tmp_path / "no" / "*.json")}, pipeline.Lake(str(tmp_path / "other")))


def test_lenient_conforming(spark):
    rows = spark.createDataFrame([json.dumps(r) for r in LANDED[LABOUR_API]], "string")
    records = rows.select(F.from_json("value", LABOUR_RECORD).alias("r")).select("r.*").drop("romeCode", "lieuTravail")
    out = conform.clean_lenient(conform.lenient_postings(records, LABOUR_API))
    got = {r.offre_id: r for r in out.collect()}
    assert tuple(out.columns) == POSTING_COLUMNS and set(got) == {"A1", "A3"}
    assert got["A1"].type_contrat == "PERMANENT" and got["A1"].salaire_min is None and got["A1"].ville is None
    scraped = spark.createDataFrame([("Titre", "E", "u1", "18.05.2026"), ("None", "E", "u2", "x"), (" nan ", "E", "u3", "x")],
                                    "titre STRING, entreprise STRING, url STRING, date_publication STRING")
    row, = conform.clean_lenient(conform.lenient_postings(scraped, SCRAPED_SITE)).collect()
    assert (row.pays, row.url_offre, row.date_creation) == ("Maroc", "u1", dt.datetime(2026, 5, 18)) and len(row.offre_id) == 32


def test_full_key_gives_one_row_and_name_key_fans_out(spark):
    rows = postings(spark, [dict(entreprise="A", secteur="x", ville="P"), dict(entreprise="A", secteur="y", ville="P", region="R"), dict()])
    assert star.build_star(rows).fact.count() == 3
    dense = star.build_star(rows, dense=True)
    assert dense.fact.count() == 3
    flat = {r.offre_id: (r.secteur, r.region) for r in marts.flat_postings(dense).collect()}
    assert flat == {"0": ("x", "Non renseigné"), "1": ("y", "R"), "2": ("Non renseigné", "Non renseigné")}
    assert star.build_star(rows, dense=True, match="name").fact.count() == 2 * 2 * 2 + 1
    with pytest.raises(ValueError):
        star.fact_by_join(rows, *dense[1:], match="other")


def test_hash_fact_needs_no_shuffle(spark):
    plan = plan_of(star.fact_by_hash(postings(spark, [dict()])))
    assert "Exchange" not in plan and "Join" not in plan


def test_fact_has_typed_placeholders(spark):
    fact = star.fact_by_hash(postings(spark, [dict()]))
    assert dict(fact.dtypes)["salaire_predit_eur"] == "decimal(10,2)" and dict(fact.dtypes)["date_prediction"] == "timestamp"
    assert fact.first().date_id is None


def test_raw_values_and_labels_stay_two_groups(spark):
    rows = postings(spark, [dict(pays=None, source="s"), dict(pays="Non renseigné", source="s"), dict(pays="FR")])
    out = sorted((r.source, r.pays, r.nb_offres) for r in gold.by_source(rows).collect())
    assert out == [("inconnu", "FR", 1), ("s", "Non renseigné", 1), ("s", "Non renseigné", 1)]


def test_gold_salaries_round_half_to_even(spark):
    rows = postings(spark, [dict(source="s", salaire_min=2, salaire_max=None), dict(source="s", salaire_min=3), dict(source="s", salaire_min=0),
                            dict(source=None, salaire_min=9)])
    assert [tuple(r) for r in gold.salaries(rows).collect()] == [("s", 2.0, None, 2)]


def test_fallback_medians(spark):
    rows = postings(spark, [dict(rome_libelle="m", type_contrat="c", salaire_min=10, salaire_max=20), dict(rome_libelle="m", type_contrat="c"),
                            dict(rome_libelle=None, type_contrat="c"), dict(salaire_min=100, salaire_max=300), dict(rome_libelle="z", type_contrat="c")])
    out = {r.offre_id: r.salaire_estime_fallback for r in marts.salary_fallback(star.fact_by_hash(rows)).collect()}
    assert out == {"1": 15.0, "2": 107.5, "4": 107.5}


def test_percentages_are_bounded(spark):
    rows = postings(spark, [dict(source="s", salaire_min=1), dict(source="s"), dict(source="s", description="d")])
    row = marts.kpi_source(star.fact_by_hash(rows)).first()
    assert (row.pct_sans_salaire, row.pct_avec_description, row.pct_avec_experience) == (66.7, 33.3, 0.0)


DICT = [skills.Skill(1, "R", "L"), skills.Skill(2, "Apache Spark", "B"), skills.Skill(3, "C++", "L")]


def test_bridge(spark):
    rows = postings(spark, [dict(titre="Dev C++ apache", description="spark power"), dict(titre="R", description=None), dict(titre="x", description=None),
                            dict(offre_id="1", titre="zzzz", description="r")])
    pairs = lambda df: sorted((r.offre_id, r.competence_id) for r in df.collect())
    assert pairs(skills.skill_bridge(rows, DICT)) == [("0", 1), ("0", 3), ("1", 1)]
    assert pairs(skills.skill_bridge(rows, DICT, boundary=True)) == [("0", 3), ("1", 1)]
    assert pairs(skills.skill_matches(rows, DICT, per_field=False)) == [("0", 1), ("0", 2), ("0", 3), ("1", 1), ("1", 1)]
    plan = plan_of(skills.skill_bridge(rows, DICT))
    assert "Join" not in plan
    assert "Exchange" not in plan_of(skills.skill_bridge(rows, DICT, unique_ids=True))


def test_carried_salaries_spare_the_join(spark):
    rows = postings(spark, [dict(titre="R", salaire_min=10 * i) for i in range(1, 4)])
    fact, names = star.fact_by_hash(rows), skills.skill_table(spark, DICT)
    carried = skills.skill_top(skills.skill_bridge(fact, DICT, unique_ids=True, amounts=True), names, fact)
    joined = skills.skill_top(skills.skill_bridge(fact, DICT), names, fact)
    assert [tuple(r) for r in carried.collect()] == [tuple(r) for r in joined.collect()] == [("R", "L", 3, 100.0, 20.0, None, None)]
    with pytest.raises(ValueError):
        skills.skill_bridge(fact, DICT, amounts=True)


def test_summary_numbers_found_skills_only(spark):
    rows = postings(spark, [dict(titre="C++ only"), dict(titre="apache", description="spark")])
    out = [tuple(r) for r in skills.skill_summary(rows, DICT).orderBy("competence_id").collect()]
    assert out == [(1, "R", "L", 1), (2, "Apache Spark", "B", 1), (3, "C++", "L", 1)]
    assert [r.nom for r in skills.skill_summary(rows.limit(1), DICT).collect()] == ["C++"]


def test_dictionary():
    names = [s.nom for s in skills.dictionary()]
    assert len(names) == len(set(names)) == 53 and names[0] == "Python" and names[-1] == "REST"


def test_cv_skills_in_list_order(spark):
    df = spark.createDataFrame([("Python, SQL et Power BI",), ("",), (None,)], "texte_cv STRING")
    assert [r.competences for r in skills.with_cv_skills(df).collect()] == ["python,r,sql,power bi", "", ""]


def test_skill_words_finds_whole_words(spark):
    names = spark.createDataFrame([(1, "R"), (2, "Apache Spark"), (3, "C++"), (4, "CI/CD"), (5, "++"), (6, ".NET")], "competence_id INT, nom STRING")
    rows = postings(spark, [dict(titre="Spark", description="apache  R"), dict(titre="C++ dev", description="ci/cd, apache spark"),
                            dict(titre="Apache", description="Spark"), dict(titre="c ci cd"), dict(titre="arr", description=None),
                            dict(titre="asp.net", description="c++x"), dict(titre=".net", description="(.NET) c++"), dict(titre="", description=" r")])
    found = sorted((r.offre_id, r.competence_id) for r in skills.skill_words(rows, names).collect())
    assert found == [("0", 1), ("1", 2), ("1", 3), ("1", 4), ("6", 3), ("6", 6), ("7", 1)]


def test_lookup_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([("a@x", 1), ("b@x", 2)], "email STRING, n INT").write.parquet(path)
    found = skills.lookup_candidates(spark.read.parquet(path), ["a@x"])
    assert [r.n for r in found.collect()] == [1] and "PushedFilters: [IsNotNull(email), EqualTo(email,a@x)]" in plan_of(found)


def test_explanations(spark):
    df = spark.createDataFrame([
        ("python,java", "Dev", "Python, Kafka, AWS et docker", 0.8735, 1), ("", "zzz", None, 0.5, 2), ("python", "Python", "", 0.1, 6)],
        "competences STRING, titre STRING, description STRING, score DOUBLE, rang INT")
    a, b, c = recommend.explain_matches(df, names=["python", "kafka", "aws", "docker"]).collect()
    assert a.explication.points_forts == ["Compétence 'python' requise et présente"]
    assert a.explication.points_amelioration == ["À acquérir : 'kafka'", "À acquérir : 'aws'"]
    assert a.explication.conseil == "Score de 87.4% — candidature recommandée !" and a.score_pct == 87.4
    assert b.explication.points_forts == ["Profil pertinent"] and b.explication.points_amelioration == ["Personnaliser la candidature"]
    assert c.explication is None


def test_recommendation_end_to_end(spark):
    rows = postings(spark, [dict(description="spark kafka airflow pipelines"), dict(description="cuisine restaurant chef"), dict(description=None)])
    tables = star.build_star(rows)
    shown = recommend.posting_rows(tables.fact, tables.dim_place, tables.dim_company).withColumn("texte", recommend.posting_text())
    model = recommend.fit_text_vectors(shown)
    people = spark.createDataFrame([(1, "spark", "expert spark et kafka"), (2, "", "chef de cuisine")], "candidat_id LONG, competences STRING, texte STRING")
    out = recommend.recommend(recommend.text_vectors(people, model), recommend.text_vectors(shown, model), k=1)
    assert {r.candidat_id: r.offre_id for r in out.collect()} == {1: "0", 2: "1"}
    first = out.filter("candidat_id = 1").first()
    assert first.ville == "Non renseigné" and first.salaire_min == 0 and 0 < first.score_pct <= 100


def test_recommendations_compare_pairs_once(spark):
    postings = spark.createDataFrame([(str(i), f"t{i}", "d", "", "", "FR", "", "", "", 0, 0, "", "s", "u", [1.0, float(i)]) for i in range(9)],
                                     "offre_id string, titre string, description string, type_contrat string, ville string, pays string, entreprise string, "
                                     "secteur string, experience string, salaire_min int, salaire_max int, rome_libelle string, source string, url_offre string, "
                                     "vector array<float>")
    people = spark.createDataFrame([(1, "sql", [1.0, 0.0]), (2, "java", [0.0, 1.0])], "candidat_id bigint, competences string, vector array<float>")
    out = recommend.recommend(people, postings, k=2)
    assert plan_of(out).count("MapInArrow") <= 1  # the search for skills; the top-k is at rest
    assert sorted((r.candidat_id, r.offre_id, r.rang) for r in out.collect()) == [(1, "0", 1), (1, "1", 2), (2, "7", 2), (2, "8", 1)]


def test_only_new_postings_reach_star_and_bridge(spark, tmp_path):
    """A second load gets the new rows alone, reads no text of known postings, and adds what they bring."""
    lake = pipeline.Lake(str(tmp_path / "lake"))
    first = postings(spark, [dict(offre_id="1", titre="Dev Python", description="sql", entreprise="A", date_creation=dt.datetime(2026, 1, 5)),
                             dict(offre_id="2", titre="Dev Java", description="docker", entreprise="B", date_creation=dt.datetime(2026, 2, 5))])
    second = first.unionByName(postings(spark, [dict(offre_id="3", titre="Dev Kafka", description="python", entreprise="A", date_creation=dt.datetime(2026, 2, 6))]))
    for rows, new in ((first, ["1", "2"]), (second, ["3"]), (second, [])):
        rows.write.mode("overwrite").parquet(lake.unified)
        fresh = pipeline.load_raw(spark, lake)
        assert sorted(r.offre_id for r in fresh.collect()) == new
        tables = pipeline.load_star(spark, lake, fresh)
        pipeline.load_skills(spark, lake, fresh, tables.fact)
    known = read_current(spark, lake.table("raw_offres"))
    plan = plan_of(new_rows(known, sanitise(spark.read.parquet(lake.unified))))
    assert "ReadSchema: struct<offre_id:string>" in plan  # of the table of known postings
    assert tables.fact.count() == 3 and tables.dim_company.count() == 2 and tables.dim_date.count() == 3
    skills_ = {r.nom: (r.competence_id, r.nb_offres) for r in read_current(spark, lake.table("dim_competence")).collect()}
    assert skills_["Python"][1] == 2 and skills_["Kafka"][1] == 1
    ids = [i for i, _ in skills_.values()]
    assert len(ids) == len(set(ids)) and skills_["Kafka"][0] == max(ids)
    pairs = read_current(spark, lake.table("bridge_offre_competence"))
    assert pairs.count() == pairs.distinct().count() and {r.offre_id for r in pairs.filter(F.col("competence_id") == skills_["Python"][0]).collect()} == {"1", "3"}


@pytest.mark.parametrize("stop", ["fact_offres", "bridge_offre_competence"])
def test_a_stopped_load_is_mended_by_the_next(spark, tmp_path, monkeypatch, stop):
    """A run that stops before it writes a table: the next one brings in its postings, nothing lost or counted twice."""
    lake = pipeline.Lake(str(tmp_path / "lake"))
    rows = postings(spark, [dict(offre_id="1", titre="Dev Kafka", description="python", entreprise="B"), dict(offre_id="2", titre="Chef"),
                            dict(offre_id="3", titre=None, description="scala")])
    rows.coalesce(1).write.parquet(lake.unified)

    def load():
        fresh = pipeline.load_raw(spark, lake)
        pipeline.load_skills(spark, lake, fresh, pipeline.load_star(spark, lake, fresh).fact)

    def stopping(write):
        def wrapped(df, path, *args, **kwargs):
            if path.endswith("/" + stop):
                raise RuntimeError(stop)
            return write(df, path, *args, **kwargs)
        return wrapped

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match=stop):
        for name in ("append_current", "publish"):
            m.setattr(pipeline, name, stopping(getattr(pipeline, name)))
        load()
    load()
    assert sorted(r.offre_id for r in read_current(spark, lake.table("fact_offres")).collect()) == ["1", "2"]
    skills_ = {r.competence_id: (r.nom, r.nb_offres) for r in read_current(spark, lake.table("dim_competence")).collect()}
    assert {"Python": 1, "Kafka": 1, "Scala": 1}.items() <= dict(skills_.values()).items() and max(n for _, n in skills_.values()) == 1
    pairs = sorted((r.offre_id, skills_[r.competence_id][0]) for r in read_current(spark, lake.table("bridge_offre_competence")).collect())
    assert pairs == [("1", "Kafka"), ("1", "Python")]


def test_predictions_from_model_to_fact(spark, tmp_path):
    from test_salary_model import SMALL, rows

    lake, at = pipeline.Lake(str(tmp_path / "lake")), F.lit("2026-06-01").cast("timestamp")
    postings(spark, [r | {"date_creation": dt.datetime(2026, 1 + i % 3, 5)} for i, r in enumerate(rows())]).write.parquet(lake.unified)
    pipeline.load_star(spark, lake, pipeline.load_raw(spark, lake))
    fact = lake.table("fact_offres")
    unknown = pipeline.read_star(spark, lake).fact.filter("salaire_min IS NULL").count()
    assert unknown == 40 and pipeline.predict_salaries(spark, lake, at, settings=SMALL) == unknown
    done = pipeline.read_star(spark, lake).fact
    assert done.count() == 160 and done.filter("salaire_predit_eur IS NOT NULL AND salaire_confiance = 'moyenne'").count() == unknown
    assert read_current(spark, f"{lake.gold}/salaires_predits").count() == unknown
    files = {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(fact) for f in names}
    assert pipeline.predict_salaries(spark, lake, at, settings=SMALL) == 0
    assert files == {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(fact) for f in names}


def test_one_current_vector_for_each_posting(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path / "lake"))
    rows = postings(spark, [dict(description="un"), dict(description="deux"), dict(description="trois")])
    assert pipeline.refresh_vectors(spark, lake, rows) == 3 and pipeline.refresh_vectors(spark, lake, rows) == 0
    before = {r.offre_id: r.vector for r in pipeline.current_vectors(spark, lake, rows).collect()}
    changed = rows.withColumn("description", F.when(F.col("offre_id") == "0", "deux trois").otherwise(F.col("description")))
    assert pipeline.refresh_vectors(spark, lake, changed) == 1
    after = {r.offre_id: r.vector for r in pipeline.current_vectors(spark, lake, changed).collect()}
    assert len(after) == 3 and after["1"] == before["1"] and after["0"] != before["0"]
    assert pipeline.current_vectors(spark, lake, changed).count() == 3
    assert pipeline.refresh_vectors(spark, lake, changed, refit=True) == 3 and pipeline.current_vectors(spark, lake, changed).count() == 3


def test_candidate_table(spark, tmp_path):
    lake, now = pipeline.Lake(str(tmp_path / "lake")), F.lit("2026-06-01").cast("timestamp")
    columns = "nom STRING, prenom STRING, email STRING, texte_cv STRING, updated_at TIMESTAMP"
    pipeline.register_candidates(spark, lake, spark.createDataFrame([("A", "a", "a@x", "python", None)], columns), now)
    out = pipeline.register_candidates(spark, lake, spark.createDataFrame([("B", "b", "b@x", "sql", None), ("A2", "a", "a@x", "java", None)], columns), now)
    rows = {r.email: r for r in out.collect()}
    assert (rows["a@x"].nom, rows["a@x"].competences, rows["b@x"].competences) == ("A2", "java", "sql")
    assert tuple(out.columns) == tuple(CANDIDATE_SCHEMA.names) and all(r.candidat_id is not None for r in rows.values())


def test_salary_market_reads_the_fact_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    staged = star.stage(postings(spark, [dict(salaire_min=10 + i % 3, ville=f"v{i % 2}") for i in range(20)]))
    star.fact_by_hash(staged).write.parquet(path)
    star.dim_place(staged).write.parquet(path + "-places")
    out = marts.salary_market(spark.read.parquet(path), spark.read.parquet(path + "-places"))
    assert out.count() == 2
    out.collect()
    final = plan_of(out).split("== Initial Plan ==")[0]
    scans = [line for line in final.split("\n") if "Scan parquet" in line and "salaire_min" in line]
    assert len(scans) == 1, final


def test_vector_refresh_encodes_new_and_changed(spark):
    rows = postings(spark, [dict(description="un"), dict(description="deux"), dict(description="trois")])
    text = recommend.posting_text()
    model = recommend.fit_text_vectors(rows.select(text.alias("texte")))
    stored = recommend.refresh_vectors(rows.limit(0).unionByName(rows.filter("offre_id < '2'")), spark.createDataFrame([], "offre_id STRING, texte_hash STRING"), model, text)
    assert stored.count() == 2
    changed = rows.withColumn("description", F.when(F.col("offre_id") == "0", "neuf").otherwise(F.col("description")))
    assert sorted(r.offre_id for r in recommend.refresh_vectors(changed, stored, model, text).collect()) == ["0", "2"]


def test_salary_estimate_only_where_unknown(spark):
    df = spark.createDataFrame([("1", 10, 20), ("2", 0, 20), ("3", None, None)], "offre_id STRING, salaire_min INT, salaire_max INT")
    predicted = spark.createDataFrame([(str(i), 1000.0, "haute") for i in range(1, 4)], "offre_id STRING, salaire_predit_eur DOUBLE, salaire_confiance STRING")
    out = {r.offre_id: r.salaire_predit_eur for r in recommend.with_salary_estimate(df, predicted).collect()}
    assert out == {"1": None, "2": 1000.0, "3": 1000.0}


def test_hot_company_is_split_in_the_join(spark):
    """With broadcasts off, the join of a company that holds a third of the postings runs as several tasks."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("offre_id"), F.lit("t").alias("titre"), F.expr("repeat(uuid(), 3)").alias("description"),
        F.expr("IF(id % 3 = 0, 'hot', CAST(id % 997 AS STRING))").alias("entreprise"),
        F.expr("CAST(id % 89 AS STRING)").alias("ville"), F.expr("CAST(id % 5 AS STRING)").alias("pays"))
    from vacantia.sources.tables import align

    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tables = star.build_star(align(rows))
        out = marts.flat_postings(tables).select("offre_id", "description", "entreprise", "ville")
        assert len(out.collect()) == 60_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_landings_open_new_files_only(spark, landed, tmp_path, monkeypatch):
    from vacantia.plans import landing

    root, opened, read = str(tmp_path / "landing"), [], landing.envelopes.read_envelopes

    def watched(session, paths):
        opened.append(sorted(os.path.basename(p) for p in paths))
        return read(session, paths)

    def titles(source=LABOUR_API):
        return {r.offre_id: r.titre for r in landing.clean_postings(spark, source, root).collect()}

    monkeypatch.setattr(landing.envelopes, "read_envelopes", watched)
    folder, files = tmp_path / "bronze" / LABOUR_API, {LABOUR_API: landed[LABOUR_API]}

    def put(name, *records):
        (folder / name).write_text(json.dumps({"source": LABOUR_API, "offres": list(records)}))

    assert landing.land(spark, files, root) == {LABOUR_API: 3} and set(titles()) == {"A1", "A3"}
    put("second.json", labour("A4", "Data Steward", "2026-05-04T10:00:00Z"))
    put("data.json", labour("A1", "Data Engineer II", "2026-05-01T10:00:00Z"))
    landing.read_new_files(spark, LABOUR_API, files[LABOUR_API], root)  # a run that is cut off
    assert set(titles()) == {"A1", "A3"}
    assert landing.land(spark, files, root) == {LABOUR_API: 2} and opened[-1] == ["data.json", "second.json"]
    assert titles() == {"A1": "Data Engineer II", "A4": "Data Steward"}
    assert landing.land(spark, files, root) == {LABOUR_API: 0} and len(opened) == 3
    put("third.json", labour("A5", "Data Owner", "2026-05-04T10:00:00Z"))
    os.remove(folder / "second.json")
    assert landing.land(spark, files, root) == {LABOUR_API: 2} and opened[-1] == ["third.json"]
    assert titles() == {"A1": "Data Engineer II", "A5": "Data Owner"}
    assert landing.land(spark, files, root) == {LABOUR_API: 0}
