import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vacantia.llm import language_id as L

SOUNDS = {"en": ["th", "ing", "er", "wh", "ou"], "fr": ["eau", "oi", "è", "ux", "qu"], "de": ["sch", "ung", "ü", "ei", "pf"], "es": ["ción", "ñ", "ll", "os", "ez"]}


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def taught():
    rng = random.Random(2)
    return [(i, prose(lang, 60, rng), lang, f"s{i % 3}") for i, lang in enumerate(sorted(SOUNDS) * 15)]


@pytest.mark.parametrize("url,want", [
    ("https://User@www.Foo.co.uk:80/x?y#z", ("www.foo.co.uk", "co.uk", "uk")), ("http://a.de", ("a.de", "a.de", "de")), (None, ("", "", "")),
    ("nonsense", ("", "", "")), ("ftp://localhost/x", ("localhost", "localhost", "localhost"))])
def test_address_parts(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(*L.address_parts(F.col("u")).values())
    assert tuple(df.first()) == want


@pytest.mark.parametrize("html,want", [("<!DOCTYPE html><HTML class='x' lang='de-AT'>", "de"), ('<html xml:lang="fr">', "fr"), ("<html>", ""), (None, ""), ("<html lang=en>", "en")])
def test_declared(spark, html, want):
    assert spark.createDataFrame([(html,)], "h string").select(L.declared_language(F.col("h"))).first()[0] == want


def test_visible_text(spark):
    html = "<p>one</p><script>var a='<p>no</p>';</script><!-- no --><style>no</style>two&nbsp;three"
    got = spark.createDataFrame([(html,)], "h string").select(L.visible_text(F.col("h"))).first()[0]
    assert got.split() == ["one", "two", "three"]


def test_evidence_by_hand(spark, documents, taught):
    """Log likelihoods are sums over trigrams by the square root of their number, whatever the texts around."""
    settings = L.Evidence()
    table = L.learn_trigrams(documents(taught), settings)
    assert table.shape == (1 << settings.gram_bits, 5)
    for k in range(4):
        assert math.isclose(sum(math.exp(x) for x in table[:, k]), 1, rel_tol=1e-9)
    texts = [t for _, t, _, _ in taught[:6]] + ["", None, "é", "x" * 9]
    df = documents(list(enumerate(texts))).repartition(3).select("doc_id", L.text_evidence(F.col("text"), table, settings).alias("e"))
    for r in df.collect():
        grams = [g for _, g, _ in L._grams([texts[r.doc_id] or ""], settings.gram_bits)][0]
        want = [sum(table[g, k] for g in grams) / math.sqrt(max(len(grams), 1)) for k in range(5)]
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for a, b in zip(r.e, want))


def plain_fusion(rows, settings):
    """rows: (share, text logs, declared, host, domain, suffix) -> posteriors."""
    width = len(settings.all)
    own, by_domain, by_suffix, whole = (defaultdict(lambda: [0.0] * width) for _ in range(4))
    declared = defaultdict(lambda: [0.0] * width)
    kinds = (*settings.languages, "other", "")
    for share, _, said, host, domain, suffix in rows:
        kind = said if said in (*settings.languages, "") else "other"
        for table, key in ((own, host), (by_domain, domain), (by_suffix, suffix), (whole, 0), (declared, kind)):
            table[key] = [a + b for a, b in zip(table[key], share)]

    def smooth(counts, above):
        total = sum(counts) + settings.strength
        return [(c + settings.strength * p) / total for c, p in zip(counts, above)]

    logs = {k: [declared[k][j] + (settings.trust if k == x else settings.trust / len(kinds) / 2) for j, x in enumerate(settings.all)] for k in kinds}
    totals = [sum(logs[k][j] for k in kinds) for j in range(width)]
    out = []
    for share, text, said, host, domain, suffix in rows:
        prior = smooth(whole[0], [1 / width] * width)
        country = [settings.suffix_texts if L.SUFFIX_LANGUAGE.get(suffix) == x else 0.0 for x in settings.all]
        prior = smooth([a + b for a, b in zip(by_suffix[suffix], country)], prior)
        prior = smooth(by_domain[domain], prior)
        prior = smooth([max(a - b, 0.0) for a, b in zip(own[host], share)], prior)
        kind = said if said in (*settings.languages, "") else "other"
        joint = [t + math.log(logs[kind][j] / totals[j]) + math.log(prior[j]) for j, t in enumerate(text)]
        top = max(joint)
        weights = [math.exp(x - top) for x in joint]
        out.append([w / sum(weights) for w in weights])
    return out


def test_fusion_as_brute_force(spark):
    settings, rng = L.Evidence(strength=3.0), random.Random(6)
    rows = []
    for i in range(80):
        text = [rng.uniform(-4, 0) for _ in range(5)]
        weights = [math.exp(t) for t in text]
        host = rng.choice(["a.x.de", "b.x.de", "c.y.fr", "hot.z.com", "hot.z.com", "hot.z.com", ""])
        rows.append(([w / sum(weights) for w in weights], text, rng.choice(["en", "fr", "de", "", "xx", "es"]), host,
                     ".".join(host.split(".")[-2:]), host.split(".")[-1]))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, __share array<double>, __text array<double>, declared string, host string, domain string, suffix string")
    out = L.fused(df, L.host_priors(df, settings), L.declaration_table(df, settings), settings).collect()
    want = plain_fusion(rows, settings)
    for r in out:
        best = max(want[r.i])
        assert math.isclose(r.probability, best, rel_tol=1e-9) and r.language == settings.all[want[r.i].index(best)]
        assert r.kept == (r.language != "und" and r.probability >= 0.5)


def page(lang, text, url):
    return f'<html lang="{lang}"><body><p>{text}</p></body></html>', url


def test_pages(spark, documents, taught):
    rng = random.Random(5)
    rows = [(i, *page("en" if i % 7 == 0 else lang, prose(lang, 30, rng), f"http://{lang}.site.org/{i}"))
            for i, lang in enumerate(sorted(SOUNDS) * 10)]
    rows += [(100, None, None), (101, "", ""), (102, "<html lang=fr></html>", "http://fr.site.org/x"), (102, "<html lang=fr></html>", "http://fr.site.org/x")]
    pages = spark.createDataFrame([(i, u, h) for i, h, u in rows], "page_id bigint, url string, html string").withColumn("language", F.lit("clash"))
    out = L.identify_pages(pages, documents(taught)).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    assert all(got[i].language == lang for i, lang in enumerate(sorted(SOUNDS) * 10))
    assert got[102].language == "fr" and all(0 <= r.probability <= 1 for r in out)
    assert L.identify_pages(pages.limit(0), documents(taught)).count() == 0
    assert L.identify_pages(pages, documents(taught).limit(0)).count() == len(rows)


def test_keep_identified(spark, documents, taught):
    other = [(500 + i, "".join(chr(0x4E00 + (i * 37 + k * 101) % 5000) for k in range(400)), "zh", "far") for i in range(8)]
    docs = documents(taught + other + [(900, None, "en", "s0"), (901, "", None, None), (902, prose("de", 40, random.Random(1)), None, None)]).withColumn("host", F.lit("clash"))
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, *_ in taught} <= ids and 902 in ids and not ids & {i for i, *_ in other}
    assert {r["host"] for r in kept.collect()} == {"clash"}
    assert L.keep_identified(docs.limit(0)).count() == 0
