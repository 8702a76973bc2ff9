import datetime as dt

import pytest
from pyspark.sql import functions as F

from vacantia.functions import cast, dates, labels, measures, salary, text
from vacantia.sources import pages


def values(spark, rows, kind, *columns):
    """Evaluate columns over rows of one column ``x``; rows come back in order."""
    data = [(i, r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"i INT, x {kind}").orderBy("i").select(*columns)
    out = [tuple(r) for r in df.collect()]
    return [r[0] for r in out] if len(columns) == 1 else out


@pytest.fixture(scope="module")
def x(spark):
    return F.col("x")


def test_clean_text(spark, x):
    assert values(spark, ["  Data \t  Engineer \n", None], "string", text.clean_text(x)) == ["Data Engineer", None]


def test_strip_takes_every_white_space(spark, x):
    assert values(spark, [" \t a b \n"], "string", text.strip(x)) == ["a b"]


def test_contract_label(spark, x):
    words = [" permanent ", "full-time", "Contract", "INTERN", "apprentissage", "self_employed", "xyz", None]
    expected = ["CDI", "CDI", "CDD", "Stage", "Alternance", "Freelance", "Autre", "Autre"]
    assert values(spark, words, "string", labels.contract_label(x)) == expected


def test_salary_range(spark, x):
    texts = ["30000 - 45000 EUR", "2 500 – 3 000", "A négocier", "99999999999 - 5", None]
    assert values(spark, texts, "string", *salary.salary_range(x)) == [
        (30000, 45000), (2500, 3000), (None, None), (None, 5), (None, None)]


def test_salary_from_text(spark, x):
    texts = ["Annuel de 35000.0 Euros à 45000.0 Euros", "Mensuel de 2 500,50 Euros", "Horaire de 12,5 Euros", None, "none"]
    got = values(spark, texts, "string", F.round(salary.salary_from_text(x), 2))
    assert got == [3333.33, 2500.5, None, None, None]


@pytest.mark.parametrize("low, high, words, expected", [
    (2000, 3000, None, 2500.0), (36000, 48000, None, 3500.0), (36000, None, None, 3000.0), (0, 2400, None, 2400.0),
    (None, None, None, None), (None, None, "2 000 - 3 000 EUR", 2500.0), (-5, None, "Horaire de 12", None)])
def test_monthly_target(spark, low, high, words, expected):
    row = spark.createDataFrame([(low, high, words)], "a INT, b INT, t STRING")
    assert row.select(salary.monthly_target(F.col("a"), F.col("b"), F.col("t"))).first()[0] == expected


def test_md5_key(spark):
    row = spark.createDataFrame([("Data Analyst", "ACME", "https://x/1", None)], "a STRING, b STRING, c STRING, n STRING")
    a, b, c, n = (F.col(k) for k in "abcn")
    got = row.select(text.key_md5(a, b, c), text.key_md5(a, n, c), text.key_md5(a, c, n)).first()
    assert got[0] == "c0bc79a4120a5ac2889122f910079e51"
    assert got[1] != got[2]


def test_normalised_title(spark, x):
    assert values(spark, ["Data-Engineer (H/F) é 2"], "string", text.normalise_title(x)) == ["dataengineer hf é 2"]


def test_keyword_flags(spark, x):
    titles = ["Lead Data Engineer", "Leader", "Sr. Dev", "débutant", None]
    assert values(spark, titles, "string", labels.keyword_flag(x, labels.SENIOR_WORDS)) == [1, 0, 1, 0, 0]
    assert values(spark, titles, "string", labels.keyword_flag(x, labels.JUNIOR_WORDS)) == [0, 0, 0, 1, 0]


def test_safe_casts(spark, x):
    assert values(spark, ["nan", " None ", "", " x "], "string", cast.safe_string(x)) == [None, None, None, "x"]
    assert values(spark, ["abcdef"], "string", cast.safe_string(x, 3)) == ["abc"]
    numbers = ["12.9", "-3.7", "3000000000", "abc", "NaN"]
    assert values(spark, numbers, "string", cast.safe_int(x)) == [12, -3, None, None, None]
    assert values(spark, ["1.5", "NaN", "z"], "string", cast.safe_double(x)) == [1.5, None, None]


def test_timestamps(spark, x):
    got = values(spark, ["18.05.2026", "Non precise"], "string", cast.safe_timestamp(x, "dd.MM.yyyy"))
    assert got == [dt.datetime(2026, 5, 18), None]
    iso = values(spark, ["2026-05-01T10:00:00Z", "2026-05-01T12:00:00+02:00", "soon"], "string",
                 cast.safe_timestamp(x).cast("string"))
    assert iso == ["2026-05-01 10:00:00", "2026-05-01 10:00:00", None]


def test_calendar(spark, x):
    days = [dt.date(2026, 5, 18), dt.date(2027, 1, 1)]
    assert values(spark, days, "date", dates.weekday_name(x), F.weekofyear(x)) == [("Monday   ", 21), ("Friday   ", 53)]
    moments = [dt.datetime(2026, 5, 20, 10)]
    assert values(spark, moments, "timestamp", dates.week_start(x).cast("string"), dates.month_label(x)) == [
        ("2026-05-18 00:00:00", "2026-05")]


def test_whole_days(spark):
    row = spark.sql("SELECT TIMESTAMP '2026-05-01 23:00' AS a, TIMESTAMP '2026-05-03 01:00' AS b")
    assert row.select(dates.whole_days_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_estimate_and_large_bounds(spark):
    rows = spark.createDataFrame(
        [(30000, 45000, 1.0), (30000, None, 3000.0), (None, None, None), (2147483647, 2147483647, None)],
        "a INT, b INT, p DOUBLE")
    got = [r[0] for r in rows.select(salary.estimate(F.col("a"), F.col("b"), F.col("p"))).collect()]
    assert got == [37500.0, 3000.0, None, 2147483647.0]


def test_rounding(spark, x):
    assert values(spark, [2.5], "double", F.round(x, 0), F.bround(x, 0)) == [(3.0, 2.0)]
    assert values(spark, [0.87349], "double", salary.score_percent(x)) == [87.3]


def test_percent(spark):
    rows = spark.createDataFrame([(1, 3), (1, 8), (0, 5), (5, 5), (1, 0), (1, 2000)], "a INT, b INT")
    got = [r[0] for r in rows.select(measures.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [33.3, 12.5, 0.0, 100.0, None, 0.1]


def test_confidence(spark):
    rows = spark.createDataFrame(
        [("france", "cdi", "inconnu", "x"), ("france", "cdi", "it", "x"), ("", None, "it", "x"), ("inconnu", "cdi", "it", "y" * 101)],
        "p STRING, c STRING, s STRING, t STRING")
    got = [r[0] for r in rows.select(salary.confidence(*[F.col(k) for k in "pcst"])).collect()]
    assert got == ["moyenne", "haute", "basse", "haute"]


def test_lists(spark, x):
    assert values(spark, ["a,b", "", None], "string", text.split_list(x)) == [["a", "b"], [], []]


def test_search_text_keeps_the_whole_description(spark):
    row = spark.createDataFrame([("Titre", None, "Senior", "D" * 700)], "a STRING, b STRING, c STRING, d STRING")
    columns = [F.col(k) for k in "abcd"]
    assert row.select(text.search_text(*columns)).first()[0] == "titre  senior " + "d" * 700
    assert row.select(text.search_text(*columns, max_chars=500)).first()[0] == "titre  senior " + "d" * 500


def test_unescape(spark, x):
    raw = ["Caf&eacute; &amp; th&#233; &#x2019;", "&amp;lt;", "a & b &#; &#99999999;", None, "plain", "&#128512; &oelig; &deg;&NotEqualTilde;", "&#xD800;&#0;",
           "&nosuchname; &eacute &#x1F600;x", "&", "&&amp;"]
    assert values(spark, raw, "string", text.unescape_html(x)) == [
        "Café & thé ’", "&lt;", "a & b &#; \ufffd", None, "plain", "\U0001F600 œ °≂̸", "\ufffd\ufffd", "&nosuchname; &eacute \U0001F600x", "&", "&&"]


def test_links(spark, x):
    assert values(spark, ["/o/1", "", None], "string", text.absolute_link("https://s", x)) == ["https://s/o/1", "", ""]


def test_fold_accents(spark, x):
    assert values(spark, ["Développeur ÇÀ"], "string", text.fold_accents(x)) == ["Developpeur CA"]


def test_tags_are_removed_once_however_often_the_text_is_used(spark):
    df = spark.createDataFrame([("a &amp; <b>b</b> &#233;",)], "x string").select(pages.plain_text(F.col("x")).alias("t"))
    assert df.first().t == "a & b é"
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1


def test_once_computes_the_value_before_branches(spark):
    df = spark.range(3).select(text.once(F.col("id") + 1, lambda v: F.when(v > 1, v * v).otherwise(-v)).alias("v"))
    assert [r.v for r in df.collect()] == [-1, 4, 9]
