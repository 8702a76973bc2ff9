"""Each registered query: operators of the library over the bound tables, all rows and whole texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.bindings import CORPUS_SKILLS, CVS, POSTINGS, TEXT_POSTINGS, bind, table
from vacantia.functions.labels import contract_label
from vacantia.functions.salary import confidence, estimate, monthly_target, salary_from_text, salary_range
from vacantia.functions.text import clean_text, key_md5, normalise_title
from vacantia.operators.dedup import best_source_per_posting, latest_per_key
from vacantia.operators.keys import hash_key, settle_keys
from vacantia.operators.merge import delete_insert, insert_ignore, new_rows, sync_schema, update_predictions, \
    upsert_candidates
from vacantia.operators.profile import field_profile, row_counts
from vacantia.operators.pruned_topk import pruned_top_k
from vacantia.operators.topk import top_k_similar
from vacantia.plans import conform, gold, landing as landing_plan, maintained, marts, pipeline, recommend, salary_model, skills, star
from vacantia.schema import LABOUR_API, LISTING_API, POSTING_SCHEMA, RECORD_SCHEMAS, SCRAPED_SITE
from vacantia.session import shared_folder, ship_package, staged as at_rest, staging_path
from vacantia.sources import commits, envelopes, ledger, pages
from vacantia.sources.tables import align, append_current, publish, read_current, replace_in_partitions, write_partitioned
from vacantia.streaming import landing

AS_OF = "2001-08-01"
TARGET_UNTIL, BATCH_FROM = "2000-06-01", "2000-01-01"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers that may be NULL as doubles and dates as text, which every client reads alike."""
    maybe_null = ("salaire_min", "salaire_max", "bas", "haut", "niveau")
    kinds = dict(df.dtypes)
    casts = {c: "double" for c in maybe_null if kinds.get(c) == "int"}
    casts |= {c: "string" for c, kind in kinds.items() if kind == "date"}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return comparable(f(spark, sf_dir))

    QUERIES[f.__name__] = run
    return run


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, POSTINGS)


def text_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, TEXT_POSTINGS)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stage(postings(spark, sf_dir))


def fact_table(rows: DataFrame) -> DataFrame:
    return star.fact_by_hash(rows, with_predictions=True)


# --- views over the star -------------------------------------------------------------------------

@query
def salary_market(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return marts.salary_market(fact_table(rows), star.dim_place(rows))


@query
def kpi_global(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return marts.kpi_global(fact_table(rows), star.dim_place(rows))


@query
def kpi_source(spark, sf_dir):
    return marts.kpi_source(fact_table(staged(spark, sf_dir)))


@query
def kpi_company(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return marts.kpi_company(fact_table(rows), star.dim_company(rows))


@query
def weekly_trend(spark, sf_dir):
    return marts.weekly_trend(fact_table(staged(spark, sf_dir)), F.to_date(F.lit(AS_OF)))


@query
def data_quality(spark, sf_dir):
    return marts.data_quality(fact_table(staged(spark, sf_dir)))


@query
def silver_quality(spark, sf_dir):
    return marts.silver_quality(postings(spark, sf_dir))


@query
def flat_postings(spark, sf_dir):
    return marts.flat_postings(star.build_star(staged(spark, sf_dir), with_predictions=True))


@query
def salary_fallback(spark, sf_dir):
    return marts.salary_fallback(fact_table(staged(spark, sf_dir)))


@query
def market_stats(spark, sf_dir):
    return marts.market_stats(fact_table(staged(spark, sf_dir)))


@query
def source_distribution(spark, sf_dir):
    return marts.distribution(postings(spark, sf_dir), "source")


@query
def table_counts(spark, sf_dir):
    s = star.build_star(staged(spark, sf_dir), with_predictions=True)
    return row_counts({"fact_offres": s.fact, "dim_date": s.dim_date, "dim_entreprise": s.dim_company,
                       "dim_lieu": s.dim_place, "vw_entreprises_kpi": marts.kpi_company(s.fact, s.dim_company)})


# --- star ------------------------------------------------------------------------------------------

@query
def dim_date(spark, sf_dir):
    return star.dim_date(postings(spark, sf_dir), dense=True)


@query
def dim_company(spark, sf_dir):
    return star.dim_company(postings(spark, sf_dir), dense=True)


@query
def dim_place(spark, sf_dir):
    return star.dim_place(postings(spark, sf_dir), dense=True)


def plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def _fact(spark, sf_dir, match):
    fact = star.build_star(star.stage(postings(spark, sf_dir)), dense=True, match=match, with_predictions=True).fact
    return plain_times(fact)


@query
def fact_full_key(spark, sf_dir):
    return _fact(spark, sf_dir, "full")


@query
def fact_name_key(spark, sf_dir):
    return _fact(spark, sf_dir, "name")


@query
def staging(spark, sf_dir):
    raw = postings(spark, sf_dir).drop("salaire_confiance", "salaire_predit_eur")
    blank = raw.withColumn("titre", F.when(F.col("experience") == "1-URGENT", None).otherwise(F.col("titre")))
    texts = blank.withColumns({c: F.col(c).cast("string") for c in ("latitude", "longitude", "salaire_min", "date_creation")})
    return plain_times(star.stage(texts.drop("region").withColumn("extra", F.length("offre_id"))))


@query
def colliding_keys(spark, sf_dir):
    """Places under keys of 8 bits, half of the postings first: each keeps a key of its own, and the first ones theirs."""
    rows = staged(spark, sf_dir)
    early = rows.filter(F.col("date_creation") < F.lit(TARGET_UNTIL).cast("date"))
    first = settle_keys(star.dim_place(early), star.PLACE_KEY, "lieu_id", bits=8)
    place = F.struct(*star.PLACE_KEY)
    new = star.dim_place(rows).withColumn("_p", place).join(first.select(place.alias("_p")), "_p", "left_anti")
    places = first.unionByName(settle_keys(new, star.PLACE_KEY, "lieu_id", first, bits=8))
    fact = star.fact_by_hash(rows, exceptions={"lieu_id": places.filter("essai > 0")}, bits=8)
    counts = fact.groupBy("lieu_id").agg(F.count("*").alias("nb_offres"))
    return places.join(counts, "lieu_id").select(*star.PLACE_KEY, "nb_offres")


# --- keyed writes --------------------------------------------------------------------------------

def _old_and_new(spark, sf_dir):
    rows = postings(spark, sf_dir).select("offre_id", "titre", "experience", "date_creation")
    old = rows.filter(F.col("date_creation") < F.lit(TARGET_UNTIL).cast("date"))
    new = rows.filter(F.col("date_creation") >= F.lit(BATCH_FROM).cast("date"))
    return old, new.withColumn("titre", F.concat(F.lit("v2 "), "titre"))


@query
def fact_incremental(spark, sf_dir):
    fact = fact_table(staged(spark, sf_dir)).select("offre_id", "source", "titre", "salaire_min", "date_creation")
    built = fact.filter(F.col("date_creation") < F.lit(TARGET_UNTIL).cast("date"))
    return new_rows(built, fact)


@query
def insert_new(spark, sf_dir):
    return insert_ignore(*_old_and_new(spark, sf_dir))


@query
def replace_batch(spark, sf_dir):
    return delete_insert(*_old_and_new(spark, sf_dir))


@query
def schema_sync(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return sync_schema(old, new.drop("experience").withColumn("niveau", F.length("titre")))


@query
def prediction_update(spark, sf_dir):
    rows = postings(spark, sf_dir)
    fact = rows.select(
        "offre_id", "salaire_min", "salaire_predit_eur",
        F.when(F.col("rome_code") == "1", "basse (fallback)").when(F.col("rome_code") == "2", "haute").alias("salaire_confiance"),
        F.lit(None).cast("timestamp_ntz").alias("date_prediction"))
    predictions = rows.filter("pays IS NOT NULL").select("offre_id", F.length("titre").cast("double").alias("salaire_predit_eur"))
    return update_predictions(fact, predictions, F.lit("2024-01-01").cast("timestamp_ntz"))


# --- kept aggregates -------------------------------------------------------------------------------

def _kept(spark, sf_dir, *names):
    """States after three batches of postings, a refresh after each, and a run of predictions that rewrites months. Returns where
    they are and the staged postings."""
    rows, lake = staged(spark, sf_dir), pipeline.Lake(staging_path(spark, "kept"))
    facts, at = lake.table("fact_offres"), lake.states
    whole = pipeline.with_month(fact_table(rows))
    for part in range(3):
        append_current(whole.filter(F.crc32(F.encode("offre_id", "utf-8")) % 3 == part), facts, [pipeline.MONTH])
        maintained.refresh(spark, facts, at, names)
    predictions = rows.filter("pays IS NOT NULL").select("offre_id", F.length("titre").cast("double").alias("salaire_predit_eur"))
    updated = update_predictions(read_current(spark, facts), predictions, F.lit("2024-01-01").cast("timestamp_ntz"))
    changed = staging_path(spark, "changed")
    updated.filter("modifie").drop("modifie").write.parquet(changed)
    replace_in_partitions(spark.read.parquet(changed), facts, "offre_id", pipeline.MONTH)
    maintained.refresh(spark, facts, at, names)
    maintained.compact(spark, at, names, lots=2)
    return at, rows


@query
def kept_global(spark, sf_dir):
    at, rows = _kept(spark, sf_dir, "jours_metiers", "jours_entreprises", "lieux")
    return maintained.kpi_global(spark, at, star.dim_place(rows))


@query
def kept_source(spark, sf_dir):
    at, _ = _kept(spark, sf_dir, "jours_metiers", "jours_entreprises")
    return maintained.kpi_source(spark, at)


@query
def kept_company(spark, sf_dir):
    at, rows = _kept(spark, sf_dir, "jours_entreprises", "entreprises_metiers")
    return maintained.kpi_company(spark, at, star.dim_company(rows))


@query
def kept_trend(spark, sf_dir):
    at, _ = _kept(spark, sf_dir, "jours_metiers")
    return maintained.weekly_trend(spark, at, F.to_date(F.lit(AS_OF)))


# --- gold ------------------------------------------------------------------------------------------

def _gold(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark, sf_dir):
        return f(postings(spark, sf_dir))

    run.__name__ = name
    query(run)


_gold("gold_source", gold.by_source)
_gold("gold_contract", gold.by_contract)
_gold("gold_city", gold.by_city)
_gold("gold_salary", gold.salaries)
_gold("gold_month", gold.by_month)
_gold("gold_sector", gold.by_sector)


# --- conforming --------------------------------------------------------------------------------------

@query
def contract_norm(spark, sf_dir):
    return postings(spark, sf_dir).select("offre_id", contract_label(F.col("type_contrat")).alias("type_contrat"))


@query
def salary_text(spark, sf_dir):
    low, high = salary_range(F.col("salaire_libelle"))
    return postings(spark, sf_dir).select(
        "offre_id", low.alias("bas"), high.alias("haut"),
        F.round(salary_from_text(F.col("salaire_libelle")), 2).alias("mensuel"))


@query
def salary_target(spark, sf_dir):
    target = monthly_target(F.col("salaire_min"), F.col("salaire_max"), F.col("salaire_libelle"))
    guess = estimate(F.col("salaire_min"), F.col("salaire_max"), F.col("salaire_predit_eur"))
    return postings(spark, sf_dir).select("offre_id", F.round(target, 2).alias("cible"), guess.alias("estime"))


@query
def clean_title(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(clean_text(F.col("text"))).alias("propre"), F.md5(normalise_title(F.col("text"))).alias("norme"),
        key_md5(F.col("lang"), F.lit(None), F.col("source")).alias("cle"))


@query
def dedup_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", "ts", [F.col("event_id")])


@query
def dedup_cross_source(spark, sf_dir):
    rows = text_postings(spark, sf_dir).withColumn("entreprise", F.col("pays")).select(
        "offre_id", "titre", "entreprise", "ville", "source")
    return best_source_per_posting(rows, ["src3", "src1", "src2"]).select("offre_id", "source")


@query
def conform_union(spark, sf_dir):
    rows = postings(spark, sf_dir)
    parts = [rows.filter("source = 'src_a'").drop("experience"), rows.filter("source = 'src_b'").drop("region", "pays"),
             rows.filter("source = 'src_c'").drop("salaire_max")]
    aligned = [align(p) for p in parts]
    merged = aligned[0].unionByName(aligned[1]).unionByName(aligned[2])
    return plain_times(conform.keep_valid(merged))


@query
def conform_listing(spark, sf_dir):
    rows = postings(spark, sf_dir)
    raw = rows.select(
        F.col("offre_id").alias("id"), F.concat(F.lit("  "), "titre", F.lit("\t ")).alias("title"),
        F.col("type_contrat").alias("contract_type"), "description",
        F.struct(F.col("ville").alias("display_name"),
                 F.when(F.col("region").isNull(), F.array().cast("array<string>")).otherwise(F.array("region", "pays")).alias("area")
                 ).alias("location"),
        "latitude", "longitude", F.struct(F.col("entreprise").alias("display_name")).alias("company"),
        F.struct(F.col("secteur").alias("label")).alias("category"),
        (F.col("salaire_min") + 0.9).alias("salary_min"), (F.col("salaire_max") * 1e6).alias("salary_max"),
        F.col("url_offre").alias("redirect_url"),
        F.when(F.col("rome_code") == "3", "Non precise").otherwise(F.date_format("date_creation", "yyyy-MM-dd'T'HH:mm:ss")).alias("created"))
    return plain_times(conform.clean_source(conform.listing_postings(raw)))


@query
def conform_labour(spark, sf_dir):
    rows = postings(spark, sf_dir)
    raw = rows.select(
        F.col("offre_id").alias("id"), F.concat(F.lit(" "), "titre").alias("intitule"), F.col("type_contrat").alias("typeContrat"),
        F.col("experience").alias("experienceLibelle"), "description",
        F.struct(F.col("ville").alias("libelle"), F.col("code_postal").alias("codePostal"), "latitude", "longitude").alias("lieuTravail"),
        F.struct(F.col("entreprise").alias("nom")).alias("entreprise"), F.col("secteur").alias("secteurActiviteLibelle"),
        F.struct(F.col("salaire_libelle").alias("libelle")).alias("salaire"),
        F.date_format("date_creation", "yyyy-MM-dd'T'HH:mm:ss").alias("dateCreation"))
    again = raw.withColumn("dateCreation", F.lit("1990-01-01T00:00:00")).withColumn("intitule", F.lit("older copy"))
    return plain_times(conform.clean_source(conform.labour_postings(raw.unionByName(again))))


def _lenient(raw, source):
    return plain_times(conform.clean_lenient(conform.lenient_postings(raw, source)))


@query
def conform_lenient(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return _lenient(rows.select(
        F.col("offre_id").alias("id"), F.concat(F.lit(" "), "titre").alias("title"), F.col("type_contrat").alias("contract_type"),
        F.struct(F.col("ville").alias("display_name"), F.array("region").alias("area")).alias("location"),
        F.col("salaire_min").cast("string").alias("salary_min")), LISTING_API)


@query
def lenient_labour(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return _lenient(rows.select(
        F.col("offre_id").alias("id"), F.col("titre").alias("intitule"), F.col("type_contrat").alias("typeContrat"),
        F.struct(F.col("ville").alias("libelle"), F.concat("latitude", F.lit(" ")).alias("latitude")).alias("lieuTravail"),
        F.struct(F.col("salaire_libelle").alias("libelle")).alias("salaire"), F.col("rome_code").alias("romeCode"),
        F.date_format("date_creation", "yyyy-MM-dd'T'HH:mm:ss").alias("dateCreation")), LABOUR_API)


@query
def lenient_scraped(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return _lenient(rows.select(
        "titre", "entreprise", "experience", "type_contrat", "region", F.col("url_offre").alias("url"),
        F.date_format("date_creation", "dd.MM.yyyy").alias("date_publication")), SCRAPED_SITE)


@query
def partitioned_roundtrip(spark, sf_dir):
    path = staging_path(spark, "postings")
    write_partitioned(postings(spark, sf_dir), path, ["source", "pays"])
    return spark.read.parquet(path)


@query
def partitioned_rebuild(spark, sf_dir):
    """The second write has fewer sources and countries, and replaces the first whatever the session says."""
    path, rows = staging_path(spark, "postings"), postings(spark, sf_dir)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        for session, part in (("STATIC", rows), ("DYNAMIC", rows.filter("source <> 'src_b'")), ("DYNAMIC", rows.filter("source = 'src_a' AND pays IS NOT NULL"))):
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", session)
            write_partitioned(part, path, ["source", "pays"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    return spark.read.parquet(path)


@query
def landing_stream(spark, sf_dir):
    source, target, state = (staging_path(spark, n) for n in ("landed", "raw", "state"))
    align(postings(spark, sf_dir)).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        landing.land_new_postings(landing.stream_table(spark, source, POSTING_SCHEMA), target, state).awaitTermination()
    return plain_times(landing.landed(spark, target))


@query
def weekly_stream(spark, sf_dir):
    """The weekly trend kept by a stream, with a restart between two landings; the second one holds late postings."""
    source, table_at, state = (staging_path(spark, n) for n in ("landed", "trend", "state"))
    rows = align(postings(spark, sf_dir))
    for part in (rows.filter("offre_id % 2 = 0"), rows.filter("offre_id % 2 = 1")):
        part.write.mode("append").parquet(source)
        landing.keep_weekly_trend(landing.stream_table(spark, source, POSTING_SCHEMA), table_at, state).awaitTermination()
    return read_current(spark, table_at).select(F.date_format("semaine", "yyyy-MM-dd").alias("semaine"), "source", "metier", "nb_offres",
                                                "salaire_moyen_min", "salaire_moyen_max")


@query
def conform_scraped(spark, sf_dir):
    rows = postings(spark, sf_dir)
    raw = rows.select(
        "titre", "entreprise", "experience", "type_contrat", "region", F.col("secteur").alias("competences"),
        F.date_format("date_creation", "dd.MM.yyyy").alias("date_publication"),
        F.when(F.col("rome_code") == "1", None).otherwise(F.col("url_offre")).alias("url_offre"),
        F.col("url_offre").alias("url"), F.lit("Maroc").alias("pays"))
    return plain_times(conform.clean_source(conform.scraped_postings(raw)))


def _junk(spark, sf_dir):
    rows = postings(spark, sf_dir)
    return rows.select(
        "offre_id", F.concat(F.lit("  "), "titre", F.lit("\t ")).alias("titre"),
        F.when(F.col("ville").isNull(), " nan ").otherwise(F.col("ville")).alias("ville"),
        F.when(F.col("pays") == "ASIA", "None").when(F.col("pays") == "AFRICA", "").otherwise(F.repeat("pays", 20)).alias("pays"),
        F.concat("longitude", F.lit(" ")).alias("longitude"),
        F.when(F.col("salaire_min") % 3 == 0, F.concat("salaire_min", F.lit(".9")))
        .when(F.col("salaire_min") % 3 == 1, F.concat("salaire_min", F.lit("000000"))).otherwise("NaN").alias("salaire_min"),
        F.when(F.col("rome_code") == "2", "bientôt").otherwise(F.date_format("date_creation", "yyyy-MM-dd HH:mm:ss")).alias("date_creation"))


@query
def sanitise(spark, sf_dir):
    return plain_times(conform.sanitise(_junk(spark, sf_dir)))


@query
def sanitise_rejects(spark, sf_dir):
    return conform.sanitise_rejects(_junk(spark, sf_dir))


@query
def envelope_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("keyword"),
        "event_id", "user_id", "value", "props")
    path = staging_path(spark, "envelopes")
    packed = envelopes.to_envelopes(events, "2024-01-31_000000", records_per_envelope=1000)
    envelopes.write_envelopes(packed, path)
    record = events.drop("source", "keyword").schema
    return envelopes.records(envelopes.read_envelopes(spark, path), record)


def _landed_folder(spark, sf_dir):
    """Envelopes as text: numbers that are words, a struct that is a word, records that are none, a cut file, a blank one."""
    rows = postings(spark, sf_dir).withColumn("k", F.col("offre_id").cast("bigint"))
    sound = F.to_json(F.struct(
        F.col("offre_id").alias("id"), F.col("titre").alias("title"), "latitude", F.col("salaire_min").alias("salary_min"),
        F.struct(F.col("entreprise").alias("display_name")).alias("company")))
    odd = F.to_json(F.struct(
        F.col("offre_id").alias("id"), F.col("titre").alias("title"), F.col("latitude").cast("string").alias("latitude"),
        F.lit("on request").alias("salary_min"), F.col("entreprise").alias("company")))
    text = F.when(F.col("k") % 50 == 1, F.lit('"no record"')).when(F.col("k") % 5 == 2, odd).otherwise(sound)
    chunk = F.concat("source", F.lit("_"), F.floor(F.col("k") / 1000))  # a bounded number of records each
    files = rows.groupBy(chunk.alias("keyword"), "source").agg(F.array_join(F.collect_list(text), ",").alias("offres")).select(
        F.col("source").alias("dossier"),
        F.concat(F.lit('{"source": "'), "source", F.lit('", "keyword": "'), "keyword", F.lit('", "nb_offres": "many", "offres": ['), "offres", F.lit("]}")).alias("value"))
    files = at_rest(files, "files")  # the cut and the blank one are made from it too
    cut = files.limit(1).select(F.lit("cut").alias("dossier"), F.expr("left(value, length(value) - 9)").alias("value"))
    blank = files.limit(1).select(F.lit("blank").alias("dossier"), F.lit("").alias("value"))
    path = staging_path(spark, "landed")
    files.unionByName(cut).unionByName(blank).write.option("maxRecordsPerFile", 1).partitionBy("dossier").text(path)
    return path


@query
def landed_records(spark, sf_dir):
    read = envelopes.records(envelopes.read_envelopes(spark, _landed_folder(spark, sf_dir)), RECORD_SCHEMAS[LISTING_API])
    return conform.listing_postings(read).select("offre_id", "titre", "latitude", "salaire_min", "entreprise")


@query
def landed_files(spark, sf_dir):
    report = envelopes.landing_report(spark, _landed_folder(spark, sf_dir))
    folder = F.regexp_extract("fichier", "dossier=([^/]*)/", 1).alias("dossier")
    return report.groupBy(folder, "lisible").agg(F.count("*").alias("nb_fichiers"), F.sum("nb_lues").alias("nb_lues"),
                                                 F.sum("nb_rejetees").alias("nb_rejetees"))


def _land_listing(spark, rows, at, of_file):
    """Write listing records as envelopes, one file for each value of a column, in a folder of its name; a folder is replaced."""
    text = F.to_json(F.struct(F.col("offre_id").alias("id"), F.col("titre").alias("title"), "latitude", F.col("salaire_min").alias("salary_min"),
                              F.struct(F.col("entreprise").alias("display_name")).alias("company"),
                              F.date_format("date_creation", "yyyy-MM-dd'T'HH:mm:ss").alias("created")))
    files = rows.groupBy(of_file.alias("dossier")).agg(F.array_join(F.sort_array(F.collect_list(text)), ",").alias("offres")).select(
        "dossier", F.concat(F.lit('{"source": "adzuna", "keyword": "k", "offres": ['), "offres", F.lit("]}")).alias("value"))
    files.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1).partitionBy("dossier").text(at)


@query
def incremental_landing(spark, sf_dir):
    """Four landings: the first files; more files, one of them changed, by a run that stops before it counts; the same again; none."""
    rows = postings(spark, sf_dir).withColumn("k", F.floor(F.col("offre_id").cast("bigint") / 1000))
    root, at = staging_path(spark, "lake"), staging_path(spark, "bronze")
    files = {LISTING_API: f"{at}/*/*.txt"}
    _land_listing(spark, rows.filter("k % 3 < 2"), at, F.col("k"))
    landing_plan.land(spark, files, root)
    renewed = rows.filter("k % 3 = 2 OR k % 6 = 0").withColumn("titre", F.when(F.col("k") % 6 == 0, F.concat(F.lit("v2 "), "titre")).otherwise(F.col("titre")))
    _land_listing(spark, renewed.filter("k % 6 <> 0 OR CAST(offre_id AS BIGINT) % 2 = 0"), at, F.col("k"))
    landing_plan.read_new_files(spark, LISTING_API, files[LISTING_API], root)  # and stops here
    landing_plan.land(spark, files, root)
    landing_plan.land(spark, files, root)
    read = ledger.read_ledger(spark, landing_plan.ledger_path(root)).groupBy("fichier").agg(F.count("octets").alias("lu"))
    times = read.select(F.regexp_extract("fichier", "dossier=([0-9]+)/", 1).cast("bigint").alias("k"), "lu")
    now = landing_plan.clean_postings(spark, LISTING_API, root).withColumn("k", F.floor(F.col("offre_id").cast("bigint") / 1000))
    files_read = times.groupBy(F.floor("k").alias("k")).agg(F.sum("lu").alias("lectures"))
    return now.join(files_read, "k").select("offre_id", "titre", "latitude", "salaire_min", "entreprise", "lectures")


@query
def table_commits(spark, sf_dir):
    """A table over versions: a first load, an append, a write that stops before its commit, two writers from one version, and a
    replacement by key in the months concerned."""
    old, new = (df.select("offre_id", "titre", F.date_format("date_creation", "yyyy-MM").alias("mois")) for df in _old_and_new(spark, sf_dir))
    path = staging_path(spark, "commits")
    publish(old.filter("mois < '1996'"), path, ["mois"])
    append_current(old.filter("mois >= '1996'"), path, ["mois"], write="1996")
    append_current(old.filter("mois >= '1996'"), path, ["mois"], write="1996")  # the same write again
    commits.write_lot(new, path, ["mois"])  # stops here
    try:
        publish(new, path, ["mois"], based_on=1)  # began from version 1
    except commits.Conflict:
        pass
    replace_in_partitions(new.filter("offre_id % 3 = 0"), path, "offre_id", "mois")
    parts = [read_current(spark, path, v).select(F.lit(v).alias("version"), "offre_id", "titre", "mois") for v in (1, 2, 3)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("version", "mois").agg(F.count("*").alias("n"), F.count_if(F.startswith("titre", F.lit("v2"))).alias("remplaces"),
                                               F.sum(F.col("offre_id").cast("bigint")).alias("somme"))


@query
def flatten_nested(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("type"), "value").alias("action")).alias("user"))
    flat = envelopes.flatten(rows)
    return flat.select("event_id", *[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in flat.columns if c != "event_id"])


@query
def html_cards(spark, sf_dir):
    layout = pages.CardLayout(tag="article", css_class=None, title_tag="h1")
    cards = pages.extract_cards(table(spark, sf_dir, "pages"), layout)
    return cards.select("page_id", "position", "titre", "entreprise", "region", "url_offre")


@query
def html_links(spark, sf_dir):
    layout = pages.CardLayout(tag="ul", css_class=None, title_tag="li", base="https://site.example")
    cards = pages.extract_cards(table(spark, sf_dir, "pages"), layout)
    return cards.select("page_id", "position", "titre", "url_offre")


@query
def job_cards(spark, sf_dir):
    """Pages of five cards with all parts, some of them missing, nested elements, and an unclosed last card on every fourth page."""
    rows = postings(spark, sf_dir).withColumn("k", F.col("offre_id").cast("bigint"))

    def item(label: str, value) -> Column:
        return F.coalesce(F.concat(F.lit(f"<li>{label} : <strong> "), F.trim(value), F.lit(" </strong></li>")), F.lit(""))

    company = F.coalesce(F.concat(F.lit("<div><a class='x card-job-company' href='/c'>"), "entreprise", F.lit("</a></div>")), F.lit(""))
    card = F.concat(
        F.lit('<div id="j" class="row card-job-detail y"><div><div class="in"><h3><a href="/offre/'), "offre_id", F.lit('">'), "titre",
        F.lit(" &amp; <b>co</b></a></h3></div></div>"), company, F.lit("<ul>"), item("Niveau d´études requis", F.col("taille_entreprise")),
        item("Niveau d'expérience", F.col("experience")), item("Contrat proposé", F.col("type_contrat")), item("Région de", F.col("region")),
        item("Compétences clés", F.col("secteur")), F.lit("</ul><time>"), F.date_format("date_creation", "dd.MM.yyyy"), F.lit("</time>"))
    page = F.floor(F.col("k") / 5)
    html = rows.groupBy(page.alias("page_id")).agg(F.sort_array(F.collect_list(F.struct("k", card.alias("card")))).alias("c")).select(
        "page_id", F.concat(F.lit("<html><body><li>Région : <strong>none</strong></li>"), F.array_join(F.col("c.card"), "</div>\n"),
                            F.when(F.col("page_id") % 4 == 0, "").otherwise("</div><footer><time>never</time></footer></body></html>")).alias("html"))
    return pages.extract_cards(html)


@query
def raw_field_profile(spark, sf_dir):
    return field_profile(table(spark, sf_dir, "events"), "props")


# --- skills and candidates ---------------------------------------------------------------------------

_DICTIONARY = skills.dictionary(CORPUS_SKILLS)


def _text_star(spark, sf_dir):
    return star.build_star(star.stage(text_postings(spark, sf_dir)), with_predictions=True)


@query
def skill_bridge(spark, sf_dir):
    return skills.skill_bridge(text_postings(spark, sf_dir), _DICTIONARY)


@query
def skill_words(spark, sf_dir):
    return skills.skill_words(text_postings(spark, sf_dir), skills.skill_table(spark, _DICTIONARY))


@query
def skill_large_dictionary(spark, sf_dir):
    """Names held as a table: the dictionary, and some thousand more out of the words of the benchmark."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("w"))
    more = words.filter(F.length("w").between(2, 9)).select("w")
    names = skills.skill_table(spark, _DICTIONARY).select("nom").union(more)
    numbered = names.select(F.lower("nom").alias("nom")).distinct().select(F.conv(F.left(F.md5("nom"), F.lit(13)), 16, 10).cast("bigint").alias("competence_id"), "nom")
    pairs = skills.skill_contains(text_postings(spark, sf_dir), numbered)
    return pairs.groupBy("offre_id").agg(F.count("*").alias("n"), F.sum(F.col("competence_id") % 1000003).alias("somme"))


@query
def skill_top(spark, sf_dir):
    fact = fact_table(star.stage(text_postings(spark, sf_dir)))
    bridge = skills.skill_bridge(fact, _DICTIONARY, unique_ids=True, amounts=True)
    return skills.skill_top(bridge, skills.skill_table(spark, _DICTIONARY), fact)


@query
def skill_top_joined(spark, sf_dir):
    fact = fact_table(star.stage(text_postings(spark, sf_dir)))
    return skills.skill_top(skills.skill_bridge(fact, _DICTIONARY), skills.skill_table(spark, _DICTIONARY), fact)


@query
def skill_demand(spark, sf_dir):
    bridge = skills.skill_bridge(text_postings(spark, sf_dir), _DICTIONARY)
    return skills.skill_demand(bridge, skills.skill_table(spark, _DICTIONARY))


@query
def skill_summary(spark, sf_dir):
    return skills.skill_summary(text_postings(spark, sf_dir), _DICTIONARY)


@query
def skill_categories(spark, sf_dir):
    return marts.distribution(skills.skill_summary(text_postings(spark, sf_dir), _DICTIONARY), "categorie")


@query
def skill_matrix(spark, sf_dir):
    s = _text_star(spark, sf_dir)
    bridge = skills.skill_bridge(s.fact, _DICTIONARY)
    return skills.skill_matrix(bridge, skills.skill_table(spark, _DICTIONARY), s.fact, s.dim_place, s.dim_company)


def _cvs(spark, sf_dir):
    return skills.with_cv_skills(bind(spark, sf_dir, CVS))


@query
def cv_skills(spark, sf_dir):
    return _cvs(spark, sf_dir).select("candidat_id", "competences")


@query
def candidate_skills(spark, sf_dir):
    rows = _cvs(spark, sf_dir).withColumn("created_at", F.col("updated_at"))
    return skills.candidate_skills(rows).drop("created_at")


@query
def candidate_lookup(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").filter("turn >= 2").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("@cv.example")).alias("email"))
    return skills.lookup_candidates(_cvs(spark, sf_dir), asked).select("candidat_id", "email", "competences")


@query
def candidate_upsert(spark, sf_dir):
    rows = _cvs(spark, sf_dir)
    existing = rows.filter("turn = 0").withColumn("created_at", F.col("updated_at"))
    out = upsert_candidates(existing, rows.filter("turn > 0"), F.to_timestamp(F.lit("2024-06-01")))
    known = F.when(F.col("candidat_id") == hash_key(F.col("email")), "hash").otherwise(F.col("candidat_id").cast("string"))
    return out.select(known.alias("candidat_id"), "email", "nom", "prenom", F.md5("texte_cv").alias("cv"), "competences",
                      F.to_date("created_at").alias("created_at"), F.to_date("updated_at").alias("updated_at"))


# --- matching ----------------------------------------------------------------------------------------

@query
def recommend_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    best = top_k_similar(vectors, vectors, 10, "vec_id", "vec_id", "embedding", "embedding")
    return best.select(F.col("query_id").alias("candidat_id"), F.col("item_id").alias("offre_id"), "rang",
                       "score")


@query
def recommend_pruned(spark, sf_dir):
    """As recommend_topk, without the pairs that bounds rule out."""
    vectors = table(spark, sf_dir, "embeddings")
    best = pruned_top_k(vectors, vectors, 10, "vec_id", "vec_id", "embedding", "embedding").rows
    return best.select(F.col("query_id").alias("candidat_id"), F.col("item_id").alias("offre_id"), "rang", "score")


@query
def vector_refresh(spark, sf_dir):
    rows = text_postings(spark, sf_dir)
    text = recommend.posting_text()
    stored = rows.filter("pays <> 'es'").select(
        "offre_id", F.sha2(F.when(F.col("pays") == "de", F.lit("old")).otherwise(text), 256).alias("texte_hash"))
    return recommend.to_encode(rows, stored, text).select("offre_id", "texte_hash")


@query
def vector_store(spark, sf_dir):
    """Refreshed twice: some texts change and some postings are new the second time. One vector of today's text for each."""
    rows, lake = text_postings(spark, sf_dir), pipeline.Lake(staging_path(spark, "lake"))
    old = rows.filter("pays <> 'es'").withColumn("description", F.when(F.col("pays") == "de", F.lit("old")).otherwise(F.col("description")))
    first = pipeline.refresh_vectors(spark, lake, old)
    second = pipeline.refresh_vectors(spark, lake, rows)
    current = pipeline.current_vectors(spark, lake, rows)
    return current.select("offre_id", F.size("vector").cast("bigint").alias("taille"), F.lit(first).cast("bigint").alias("premiers"),
                          F.lit(second).cast("bigint").alias("ensuite"))


@query
def candidate_table(spark, sf_dir):
    """Registered in two goes; the later CV of a person replaces the earlier one."""
    lake, people = pipeline.Lake(staging_path(spark, "lake")), bind(spark, sf_dir, CVS).withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    now = F.to_timestamp(F.lit("2024-06-01"))
    pipeline.register_candidates(spark, lake, people.filter("turn = 0"), now)
    out = pipeline.register_candidates(spark, lake, people.filter("turn > 0"), now)
    return out.select("email", "nom", "prenom", F.md5("texte_cv").alias("cv"), "competences")


@query
def explain_match(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").agg(F.count_distinct("conv_id")).scalar()
    rows = text_postings(spark, sf_dir).select("offre_id", "titre", "description", F.length("description").alias("n")).withColumn(
        "conv_id", F.col("offre_id").cast("bigint") % talks)
    rows = recommend.with_wanted(rows)
    people = _cvs(spark, sf_dir).select("candidat_id", "competences", "conv_id", "turn")
    pairs = people.join(rows, "conv_id").withColumn("score", (F.col("n") % 997) / 1000).withColumn("rang", F.col("turn") + 1)
    out = recommend.explain_matches(pairs)
    return out.select("candidat_id", "offre_id", "rang", F.col("explication.points_forts").alias("forts"),
                      F.col("explication.points_amelioration").alias("ameliorer"), F.col("explication.conseil").alias("conseil")
                      ).withColumns({c: F.array_join(c, "; ") for c in ("forts", "ameliorer")})


@query
def text_vectors(spark, sf_dir):
    rows = text_postings(spark, sf_dir).select("offre_id", recommend.posting_text().alias("texte"))
    out = recommend.text_vectors(rows, recommend.fit_text_vectors(rows))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    return out.select("offre_id", F.round(norm, 4).alias("norme"), F.size("vector").alias("taille"))


@query
def recommend_postings(spark, sf_dir):
    s = _text_star(spark, sf_dir)
    rows = recommend.posting_rows(s.fact, s.dim_place, s.dim_company).withColumn("texte", recommend.posting_text())
    model = recommend.fit_text_vectors(rows)
    people = _cvs(spark, sf_dir).select("candidat_id", "competences", F.col("texte_cv").alias("texte"))
    out = recommend.recommend(recommend.text_vectors(people, model), recommend.text_vectors(rows, model), k=10)
    return out.select("candidat_id", "offre_id", "rang", "score_pct", "ville", "pays", "entreprise",
                      F.col("explication.conseil").alias("conseil"))


# --- salary model --------------------------------------------------------------------------------------

@query
def salary_features(spark, sf_dir):
    rows = text_postings(spark, sf_dir).unionByName(postings(spark, sf_dir).withColumn(
        "date_creation", F.col("date_creation").cast("timestamp")))
    out = salary_model.engineer_features(rows)
    return out.select("offre_id", F.md5("texte").alias("texte"), *salary_model.CATEGORIES, *salary_model.FLAGS,
                      F.round(salary_model.TARGET, 2).alias("cible"))


@query
def salary_terms(spark, sf_dir):
    features = salary_model.engineer_features(text_postings(spark, sf_dir))
    out = salary_model.term_weights(features)
    return out.select("offre_id", "term", F.round("weight", 6).alias("weight"))


@query
def salary_flags(spark, sf_dir):
    k = F.col("offre_id").cast("bigint")
    rows = postings(spark, sf_dir).withColumn("titre", F.concat(
        "titre", F.when(k % 3 == 0, " senior").otherwise(""), F.when(k % 7 == 0, " junior").otherwise(""), F.when(k % 5 == 0, " python").otherwise("")))
    out = salary_model.scaled_flags(salary_model.engineer_features(rows))
    return out.select("offre_id", *[F.round(f, 6).alias(f) for f in salary_model.FLAGS])


@query
def confidence_levels(spark, sf_dir):
    rows = postings(spark, sf_dir)
    level = confidence(F.col("pays"), F.coalesce("experience", F.lit("inconnu")), F.col("secteur"), F.col("description"))
    return rows.select("offre_id", level.alias("confiance"))


def _model(spark, sf_dir) -> salary_model.SalaryModel:
    """The model with its documented settings. It is trained once for a table and stored below the shared folder under a key
    made from the table's rows, so it is never older than they are."""
    rows = postings(spark, sf_dir)
    content = rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()[0]
    return salary_model.train_or_load(rows, f"{shared_folder(spark)}/salary-model-{content}")


@query
def salary_train(spark, sf_dir):
    return spark.createDataFrame([{k: float(v) for k, v in _model(spark, sf_dir).metrics.items()}])


@query
def salary_predict(spark, sf_dir):
    out = salary_model.predict_batch(_model(spark, sf_dir), postings(spark, sf_dir))
    return out.select("offre_id", salary_model.TARGET, salary_model.PREDICTED)


@query
def salary_record(spark, sf_dir):
    return salary_model.prediction_records(_model(spark, sf_dir), postings(spark, sf_dir))


@query
def salary_export(spark, sf_dir):
    out = salary_model.predict_batch(_model(spark, sf_dir), postings(spark, sf_dir))
    return salary_model.prediction_export(out, F.lit("2024-01-01T00:00:00"))


@query
def salary_for_recommended(spark, sf_dir):
    rows = postings(spark, sf_dir)
    records = salary_model.prediction_records(_model(spark, sf_dir), rows)
    predicted = records.select("offre_id", F.col("salaire_estime_eur").alias("salaire_predit_eur"),
                               F.col("confiance").alias("salaire_confiance"))
    return recommend.with_salary_estimate(rows.select("offre_id", "salaire_min", "salaire_max"), predicted)
