import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from vacantia.plans import maintained, marts, pipeline
from vacantia.sources import commits, tables
from vacantia.sources.tables import append_current, publish, read_current, replace_in_partitions

SCHEMA = ("offre_id string, date_id bigint, entreprise_id bigint, lieu_id bigint, source string, rome_libelle string, description string, "
          "experience string, salaire_min int, salaire_max int, salaire_predit_eur decimal(18,2), salaire_confiance string, "
          "date_prediction timestamp_ntz, date_creation timestamp_ntz")


def row(i, day, company=1, place=1, source="a", job="x", low=None, high=None, predicted=None, text=None):
    at = day and dt.datetime(2024, *day, i % 24)
    return (str(i), 1, company, place, source, job, text, None, low, high, predicted and Decimal(predicted), None, None, at)


BATCHES = [
    [row(1, (1, 5), low=10, high=20, text="t"), row(2, (1, 6), company=2, source=None), row(3, (2, 1), place=2, job=None, low=7)],
    [row(4, (1, 5), company=3, source="b", job="y"), row(5, None, company=4, place=3, text="u"), row(6, (3, 9), predicted=50)],
    [row(7, (1, 8), company=None, place=None, low=9, high=11), row(8, (12, 31), source="b"), row(9, (2, 29), company=2)],
]


@pytest.fixture()
def dims(spark):
    companies = spark.createDataFrame([(i, "n" if i < 3 else f"n{i}", None, "PME") for i in range(1, 5)], "entreprise_id bigint, nom string, secteur string, taille string")
    places = spark.createDataFrame([(1, "P"), (2, "P"), (3, None)], "lieu_id bigint, ville string")
    return companies, places


def add(spark, path, rows):
    append_current(pipeline.with_month(spark.createDataFrame(rows, SCHEMA)), path, [pipeline.MONTH])


def same(left, right):
    names = sorted(right.columns)
    assert sorted(left.columns) == names
    rows = [sorted((tuple(r) for r in df.select(names).collect()), key=repr) for df in (left, right)]
    assert rows[0] == rows[1]


def check(spark, fact, root, dims):
    companies, places = dims
    rows = read_current(spark, fact)
    same(maintained.kpi_source(spark, root), marts.kpi_source(rows))
    same(maintained.kpi_global(spark, root, places), marts.kpi_global(rows, places))
    same(maintained.kpi_company(spark, root, companies), marts.kpi_company(rows, companies))
    as_of = F.lit(dt.date(2024, 7, 6))
    same(maintained.weekly_trend(spark, root, as_of), marts.weekly_trend(rows, as_of))


def test_batches_predictions_and_repeats(spark, tmp_path, dims):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    assert maintained.refresh(spark, fact, root) == 0  # no fact yet
    for rows in BATCHES:
        add(spark, fact, rows)
        assert maintained.refresh(spark, fact, root) == len(maintained.STATES)
        assert maintained.refresh(spark, fact, root) == 0
    check(spark, fact, root, dims)
    changed = read_current(spark, fact).filter("offre_id IN (2, 9)").withColumn("salaire_predit_eur", F.lit(33).cast("decimal(18,2)"))
    replace_in_partitions(pipeline._staged(changed, "changed"), fact, "offre_id", pipeline.MONTH)
    before = commits.read_version(spark, f"{root}/lieux").folders
    maintained.refresh(spark, fact, root)
    assert commits.read_version(spark, f"{root}/lieux").folders == before  # predictions change no place
    check(spark, fact, root, dims)
    assert maintained.compact(spark, root, lots=1) > 0
    assert maintained.compact(spark, root, lots=1) == 0
    check(spark, fact, root, dims)


def test_a_refresh_opens_only_what_has_come_or_gone(spark, tmp_path):
    fact = str(tmp_path / "fact")
    add(spark, fact, BATCHES[0])
    first = commits.read_version(spark, fact)
    add(spark, fact, BATCHES[1])
    second = commits.read_version(spark, fact)
    new = set(second.folders) - set(first.folders)
    read = maintained.changes(spark, fact, first, second).inputFiles()
    assert read and all(any(f"/{n}/" in f for n in new) for f in read)
    replace_in_partitions(pipeline._staged(pipeline.with_month(spark.createDataFrame([row(3, (2, 1), low=8)], SCHEMA)), "b"), fact, "offre_id", pipeline.MONTH)
    third = commits.read_version(spark, fact)
    delta = maintained.changes(spark, fact, second, third)
    assert all("mois_creation=2024-02" in f for f in delta.inputFiles())
    assert sorted((r.salaire_min, r._sign) for r in delta.collect()) == [(7, -1), (8, 1)]


def test_rows_that_all_go_leave_no_group(spark, tmp_path, dims):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    add(spark, fact, BATCHES[0] + BATCHES[1])
    maintained.refresh(spark, fact, root)
    publish(read_current(spark, fact).filter("source = 'a'"), fact, [pipeline.MONTH])
    maintained.refresh(spark, fact, root)
    assert {r.source for r in maintained.kpi_source(spark, root).collect()} == {"a"}
    check(spark, fact, root, dims)
    publish(read_current(spark, fact).limit(0), fact, [pipeline.MONTH])
    maintained.refresh(spark, fact, root)
    assert maintained.kpi_source(spark, root).count() == 0
    check(spark, fact, root, dims)


def test_a_forgotten_version_means_a_rebuild(spark, tmp_path, dims):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    add(spark, fact, BATCHES[0])
    maintained.refresh(spark, fact, root)
    for rows in BATCHES[1:]:
        add(spark, fact, rows)
    commits.forget(spark, fact, 1)
    maintained.refresh(spark, fact, root)
    check(spark, fact, root, dims)


def test_a_refresh_that_stops_or_meets_another(spark, tmp_path, dims, monkeypatch):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    add(spark, fact, BATCHES[0])
    maintained.refresh(spark, fact, root)
    add(spark, fact, BATCHES[1])
    real, calls = commits.commit, []

    def stops(*a):
        raise OSError("lost")

    monkeypatch.setattr(commits, "commit", stops)
    with pytest.raises(OSError):
        maintained.refresh(spark, fact, root)
    monkeypatch.undo()

    def beaten(spark_, path, version):
        """Another refresh is faster, the first time."""
        if not calls:
            calls.append(path)
            maintained.refresh(spark, fact, root)
        real(spark_, path, version)

    monkeypatch.setattr(commits, "commit", beaten)
    maintained.refresh(spark, fact, root)
    monkeypatch.undo()
    assert calls
    check(spark, fact, root, dims)


def test_an_append_leaves_a_file_for_each_partition(spark, tmp_path):
    fact = str(tmp_path / "fact")
    rows = pipeline.with_month(spark.createDataFrame([row(i, (1 + i % 6, 5)) for i in range(300)], SCHEMA).repartition(7))
    append_current(rows, fact, [pipeline.MONTH])
    append_current(rows, fact, [pipeline.MONTH])
    stored = read_current(spark, fact)
    assert stored.count() == 600 and len(stored.inputFiles()) == 12  # not one for each task, month and append
    assert stored.exceptAll(rows.unionByName(rows).select(stored.columns)).count() == 0


def test_companies_are_shuffled_to_their_names_once(spark, tmp_path, dims):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    add(spark, fact, BATCHES[0] + BATCHES[2])
    maintained.refresh(spark, fact, root)
    plan = plan_of(maintained.kpi_company(spark, root, dims[0]))
    assert plan.count("Join") == 1  # with the names; the two states are put under each other
    check(spark, fact, root, dims)


def test_a_refresh_after_a_replacement_reads_the_rows_replaced(spark, tmp_path, dims, monkeypatch):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "states")
    add(spark, fact, [row(i, (1 + i % 3, 5), low=i) for i in range(60)])
    maintained.refresh(spark, fact, root)
    first = commits.read_version(spark, fact)

    def put(*rows):
        replace_in_partitions(pipeline._staged(pipeline.with_month(spark.createDataFrame(rows, SCHEMA)), "b"), fact, "offre_id", pipeline.MONTH)

    put(row(3, (1, 5), low=100), row(4, (3, 9), low=200), row(70, None, low=300))  # 4 was in another month
    second = commits.read_version(spark, fact)
    read = maintained.changes(spark, fact, first, second)
    assert sorted((int(r.offre_id), r.salaire_min, r._sign) for r in read.collect()) == [
        (3, 3, -1), (3, 100, 1), (4, 4, -1), (4, 200, 1), (70, 300, 1)]  # and not the 60 rows of the months, twice
    assert not any("-kept/" in f for f in read.inputFiles())
    add(spark, fact, BATCHES[0])
    monkeypatch.setattr(tables, "HASHED_KEYS", 0)
    put(row(3, (2, 5), low=101), row(6, (1, 5), company=2))
    assert read_current(spark, fact).filter("offre_id = '3'").count() == 1
    maintained.refresh(spark, fact, root)
    check(spark, fact, root, dims)
    put(row(6, (1, 6), company=3))
    maintained.refresh(spark, fact, root)
    check(spark, fact, root, dims)
    commits.forget(spark, fact, 1)  # what the last version left out is still named by it
    assert commits.read_table(spark, fact, replace(second, folders=commits.read_version(spark, fact).gone)).count() == 1
    check(spark, fact, root, dims)
