import dataclasses
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import DataFrameReader, functions as F

from helpers import plan_of
from vacantia.schema import LABOUR_RECORD, POSTING_COLUMNS
from vacantia.sources import commits, envelopes, pages, tables


def write(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, indent=2), encoding="utf-8")


def envelope(source, *records):
    return {"source": source, "keyword": "data", "date_collecte": "2026-05-04_000000", "nb_offres": len(records), "offres": list(records)}


def test_bad_and_empty_files(spark, tmp_path):
    folder = tmp_path / "landed"
    write(folder, "a.json", envelope("s", {"id": "1", "intitule": "x", "lieuTravail": {"libelle": "Paris"}}))
    write(folder, "b.json", envelope("s"))
    write(folder, "c.json", json.dumps(envelope("s", {"id": "2"}))[:-20])
    write(folder, "d.json", "")
    write(folder, "e.json", envelope("s", {"id": "3", "entreprise": "ACME", "lieuTravail": {"latitude": "48.85", "longitude": "far"}}, "none", None, {"id": 4}))
    read = envelopes.read_envelopes(spark, f"{folder}/*.json")
    rows = sorted(envelopes.records(read, LABOUR_RECORD).collect(), key=lambda r: r.id)
    assert [(r.id, r.lieuTravail and r.lieuTravail.libelle, r.entreprise, r.source) for r in rows] == [
        ("1", "Paris", None, "s"), ("3", None, None, "s"), ("4", None, None, "s")]
    assert (rows[1].lieuTravail.latitude, rows[1].lieuTravail.longitude) == ("48.85", "far")
    report = {r.fichier.rsplit("/", 1)[1]: (r.lisible, r.nb_lues, r.nb_rejetees) for r in envelopes.landing_report(spark, f"{folder}/*.json").collect()}
    assert report == {"a.json": (True, 1, 0), "b.json": (True, 0, 0), "c.json": (False, 0, 0), "d.json": (False, 0, 0), "e.json": (True, 2, 2)}
    bad = envelopes.rejected(envelopes.landing_report(spark, f"{folder}/*.json"))
    assert sorted(r.fichier.rsplit("/", 1)[1] for r in bad.collect()) == ["c.json", "d.json", "e.json"]


def test_envelopes_are_bounded_and_round_trip(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("k").alias("keyword"),
                                  F.col("id"), F.struct((F.col("id") * 2).alias("x")).alias("nested"))
    packed = envelopes.to_envelopes(df, "2026", records_per_envelope=50)
    sizes = [(r.nb_offres, len(r.offres)) for r in packed.collect()]
    assert all(n == m <= 50 for n, m in sizes) and sum(n for n, _ in sizes) == 1000
    small = envelopes.to_envelopes(df, "2026", bytes_per_envelope=500)
    assert all(sum(len(json.dumps(o.asDict(True), separators=(",", ":"))) for o in r.offres) <= 600 for r in small.collect())
    assert small.agg(F.sum("nb_offres")).first()[0] == 1000 and small.count() < 200
    envelopes.write_envelopes(packed, str(tmp_path / "out"))
    back = envelopes.records(envelopes.read_envelopes(spark, str(tmp_path / "out")), df.drop("source", "keyword").schema)
    assert sorted((r.source, r.id, r.nested.x) for r in back.collect()) == sorted(
        ("a" if i % 3 == 0 else "b", i, 2 * i) for i in range(1000))


def test_flatten(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'd', array(2)) AS a, 3 AS e")
    out = envelopes.flatten(df)
    assert out.columns == ["a.b.c", "a.d", "e"] and tuple(out.first()) == (1, [2], 3)


CARD = """<div class="{cls}"><div class="inner"><h3><a href="/offre/1">Data &amp; IA <b>Engineer</b></a></h3>
<a class="x card-job-company y" href="/c">ACME</a></div><ul><li>Niveau d´études requis : <strong>Bac+5</strong></li>
<li>Contrat proposé : <strong>CDI</strong></li><li>Région de : <strong>Rabat</strong></li><li>Compétences clés : </li></ul>
<time datetime="2026">18.05.2026</time></div>"""


def test_cards(spark):
    page = "<html><ul><li>Région : <strong>no</strong></li></ul>" + CARD.format(cls="card card-job-detail") \
        + '<div class="card-job-detail"><p>empty</p></div><div class="card-job-details"><h3>other</h3></div>' \
        + "<footer><li>Région : <strong>footer</strong></li><time>x</time></footer></html>"
    df = spark.createDataFrame([(1, page), (2, "<html>none</html>"), (3, None)], "id INT, html STRING")
    first, second = pages.extract_cards(df).orderBy("id", "position").collect()
    assert (first.titre, first.entreprise, first.niveau_etudes, first.type_contrat, first.region) == (
        "Data & IA Engineer", "ACME", "Bac+5", "CDI", "Rabat")
    assert (first.competences, first.experience, first.date_publication, first.ville) == ("", "Non precise", "18.05.2026", "Rabat")
    assert first.url_offre == "https://www.emploi.ma/offre/1" and first.pays == "Maroc"
    assert (second.titre, second.region, second.date_publication, second.url_offre) == ("Non precise", "Non precise", "Non precise", "")


def test_unclosed_card_is_kept(spark):
    df = spark.createDataFrame([('<div class="card-job-detail"><h3>Titre long</h3><div>x',)], "html STRING")
    assert [r.titre for r in pages.extract_cards(df).collect()] == ["Titre long"]


def test_align_and_read_sources(spark, tmp_path):
    spark.createDataFrame([("1", "t", "12")], "offre_id STRING, titre STRING, salaire_min STRING").write.parquet(str(tmp_path / "a"))
    out = tables.read_sources(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "absent")})
    assert tuple(out.columns) == POSTING_COLUMNS and out.first().salaire_min == 12
    with pytest.raises(ValueError):
        tables.read_sources(spark, {"b": str(tmp_path / "absent")})


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("1", "s", "FR"), ("2", "s", None), ("3", "t", "MA")], "offre_id STRING, source STRING, pays STRING")
    tables.write_partitioned(df, path, ["source", "pays"])
    read = spark.read.parquet(path).filter("source = 't'")
    assert [r.offre_id for r in read.collect()] == ["3"]
    assert "PartitionFilters: [isnotnull(source" in plan_of(read)


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC"])
def test_a_rebuild_replaces_all_partitions(spark, tmp_path, mode):
    path, df = str(tmp_path / "p"), spark.createDataFrame([("1", "a"), ("2", "b")], "offre_id STRING, source STRING")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        tables.write_partitioned(df, path, ["source"])
        tables.write_partitioned(df.filter("source = 'a'"), path, ["source"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert [r.offre_id for r in spark.read.parquet(path).collect()] == ["1"]


def test_append_with_other_columns_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        tables.publish(spark.range(i, i + 1), path)
    assert commits.version_numbers(spark, path) == [3, 4, 5] and len(list((tmp_path / "t").glob("_lot=*"))) == 3
    tables.append_current(spark.createDataFrame([(9, "x")], "id LONG, extra STRING"), path)
    assert sorted((r.id, r.extra) for r in tables.read_current(spark, path).collect()) == [(4, None), (9, "x")]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_current(spark, path) is None
    tables.publish(spark.range(3), path)
    tables.publish(tables.read_current(spark, path).filter("id > 0"), path)  # computed from the version before
    assert tables.read_current(spark, path).count() == 2
    tables.append_current(spark.range(10, 11), path)
    assert sorted(r.id for r in tables.read_current(spark, path).collect()) == [1, 2, 10]
    commits.write_lot(spark.range(50), path)  # a write that did not finish
    assert tables.read_current(spark, path).count() == 3
    assert not tables.reload_if_any(spark.range(0), path) and tables.read_current(spark, path).count() == 3


def test_named_writes_skip_empty(spark, tmp_path):
    written = tables.write_named({"a": spark.range(1), "b": spark.range(0)}, str(tmp_path), skip_empty=["b"])
    assert written == ["a"] and tables.try_read(spark, str(tmp_path / "b")) is None


def test_replace_touches_concerned_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = "offre_id STRING, n INT, mois STRING"
    tables.append_current(spark.createDataFrame([("1", 0, "2024-01"), ("2", 0, "2024-01"), ("3", 0, "2024-02"), ("4", 0, "2024-03"), ("5", 0, None)],
                                                columns), path, ["mois"])
    untouched = [f for f in commits.read_version(spark, path).folders if f.endswith("mois=2024-03")]
    batch = spark.createDataFrame([("2", 1, "2024-04"), ("3", 1, "2024-01"), ("5", 1, "2024-04"), ("6", 1, "2024-04")], columns)
    for _ in range(2):  # a second run changes nothing
        tables.replace_in_partitions(batch, path, "offre_id", "mois")
        rows = sorted(tuple(r) for r in tables.read_current(spark, path).collect())
        assert rows == [("1", 0, "2024-01"), ("2", 1, "2024-04"), ("3", 1, "2024-01"), ("4", 0, "2024-03"), ("5", 1, "2024-04"),
                        ("6", 1, "2024-04")]
    assert [f for f in commits.read_version(spark, path).folders if f.endswith("mois=2024-03")] == untouched


def test_bucketed_table_is_not_shuffled_for_known_keys(spark, tmp_path):
    from vacantia.operators.merge import new_rows

    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}/db'")
    rows = spark.range(100).select(F.col("id").cast("string").alias("offre_id"), F.lit("t").alias("titre"))
    try:
        tables.append_bucketed(rows, "bucketed.raw", "offre_id", 4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        batch = spark.range(90, 110).select(F.col("id").cast("string").alias("offre_id"), F.lit("t").alias("titre"))
        fresh = new_rows(spark.table("bucketed.raw"), batch)
        assert plan_of(fresh).count("Exchange hashpartitioning") == 1  # the batch, not the table
        assert fresh.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS bucketed CASCADE")


def test_a_snapshot_stays_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_current(spark.range(3), path)
    before = tables.read_current(spark, path)
    tables.append_current(spark.range(10, 12), path)
    tables.publish(spark.range(20, 21), path)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert [sorted(r.id for r in tables.read_current(spark, path, v).collect()) for v in (1, 2, 3)] == [[0, 1, 2], [0, 1, 2, 10, 11], [20]]


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3), path)
    base = commits.read_version(spark, path)
    lot = commits.write_lot(spark.range(100, 101), path)  # a slow writer, who began from version 1
    tables.append_current(spark.range(10, 11), path)
    with pytest.raises(commits.Conflict):
        commits.commit(spark, path, dataclasses.replace(base, number=2, folders=tuple(lot)))
    with pytest.raises(commits.Conflict):
        tables.publish(spark.range(5), path, based_on=1)
    assert sorted(r.id for r in tables.read_current(spark, path).collect()) == [0, 1, 2, 10]
    assert not list((tmp_path / "t" / "_versions").glob(".*-*")) and commits.remove_unnamed(spark, path, hours=0) == 2
    assert commits.remove_unnamed(spark, path, hours=0) == 0 and tables.read_current(spark, path).count() == 4


def test_appends_at_once_are_all_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: tables.append_current(spark.range(i, i + 1), path), range(6)))
    assert sorted(r.id for r in tables.read_current(spark, path).collect()) == list(range(6))
    for _ in range(2):
        tables.append_current(spark.range(7, 8), path, write="once")
    assert tables.read_current(spark, path).count() == 7


def test_a_replacement_starts_again_behind_a_faster_writer(spark, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "t"), "offre_id STRING, n INT, mois STRING"
    tables.append_current(spark.createDataFrame([("1", 0, "a"), ("2", 0, "b")], columns), path, ["mois"])
    write, once = commits.write_lot, []

    def slow(df, at, *args, **kwargs):
        if not once:
            once.append(True)
            tables.append_current(spark.createDataFrame([("3", 0, "a")], columns), path, ["mois"])
        return write(df, at, *args, **kwargs)

    monkeypatch.setattr(commits, "write_lot", slow)
    tables.replace_in_partitions(spark.createDataFrame([("1", 5, "a")], columns), path, "offre_id", "mois")
    assert sorted(map(tuple, tables.read_current(spark, path).collect())) == [("1", 5, "a"), ("2", 0, "b"), ("3", 0, "a")]


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.createDataFrame([], "a INT, mois STRING"), path, ["mois"])
    assert tables.read_current(spark, path).schema.simpleString() == "struct<a:int,mois:string>"
    tables.append_current(spark.createDataFrame([(1, "x")], "a INT, mois STRING"), path)
    assert [tuple(r) for r in tables.read_current(spark, path).collect()] == [(1, "x")]


def test_files_are_listed_without_a_call_for_each(spark, tmp_path, monkeypatch):
    for i in range(60):
        (tmp_path / f"é {i}.json").write_text('{"source": "s", "offres": [{"id": 1}]}' if i % 3 else "")
    calls, gateway = [], spark.sparkContext._gateway._gateway_client
    send = gateway.send_command
    monkeypatch.setattr(gateway, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    files = envelopes.landing_report(spark, str(tmp_path)).groupBy("lisible").agg(F.count("*"), F.sum("octets"))
    few = len(calls)
    assert sorted(map(tuple, files.collect())) == [(False, 20, 0), (True, 40, 40 * 38)]
    for i in range(60, 1060):
        (tmp_path / f"é {i}.json").write_text("")
    calls.clear()
    envelopes.landing_report(spark, str(tmp_path)).groupBy("lisible").agg(F.count("*"), F.sum("octets"))
    assert len(calls) < few + 1000


def test_documents_in_one_file_and_a_mark_of_byte_order(spark, tmp_path):
    one = '{"source": "é", "nb_offres": "many", "offres": [{"id": 1.00, "x": {"a": "ü"}}, "no"]}'
    (tmp_path / "list.json").write_text(f" [{one}, {one}]", encoding="utf-8")
    for name in ("utf-8-sig", "utf-8"):
        (tmp_path / f"{name}.json").write_text(one, encoding=name)
    got = envelopes.read_envelopes(spark, str(tmp_path)).select("source", "offres").collect()
    assert len(got) == 4 and {(r.source, *r.offres) for r in got} == {("é", '{"id": 1.00, "x": {"a": "ü"}}', "no")}


def test_records_cost_no_seek_in_their_file(spark, tmp_path, monkeypatch):
    options, plain = {}, DataFrameReader.option
    monkeypatch.setattr(DataFrameReader, "option", lambda self, k, v: options.update({k: v}) or plain(self, k, v))
    (tmp_path / "a.json").write_text('{\n"source": "s",\r\n"offres": [{"id":\n 1.50}]}')
    assert [tuple(r.offres) for r in envelopes.read_envelopes(spark, str(tmp_path)).collect()] == [('{"id":\n 1.50}',)]
    assert "multiLine" not in options
