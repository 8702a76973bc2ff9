"""The daily job: landed files to unified postings, warehouse tables and gold aggregates."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia.operators.keys import settle_keys
from vacantia.operators.merge import known_keys, new_rows, update_predictions, upsert_candidates
from vacantia.plans import gold, landing, maintained, marts, recommend, salary_model, skills, star
from vacantia.plans.conform import sanitise, unify
from vacantia.plans.maintained import MONTH
from vacantia.schema import CANDIDATE_SCHEMA, POSTING_SCHEMA
from vacantia.session import staging_path
from vacantia.sources import envelopes
from vacantia.sources.tables import (align, append_current, current_version, publish, read_current, read_sources,
                                     replace_in_partitions, try_read, write_named, write_partitioned)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """Where the tables are."""

    root: str

    def source(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def unified(self) -> str:
        return f"{self.root}/silver/unified"

    def table(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    @property
    def states(self) -> str:
        return f"{self.root}/warehouse/etats"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


def landing_rejects(spark: SparkSession, landed: Mapping[str, str]) -> DataFrame:
    """Files of all sources that could not be read, or not in whole, with the number of records rejected."""
    parts = []
    for source, files in landed.items():
        try:
            report = envelopes.rejected(envelopes.landing_report(spark, files))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(report.select(F.lit(source).alias("source"), "*"))
    return reduce(DataFrame.unionByName, parts)


def build_silver(spark: SparkSession, landed: Mapping[str, str], lake: Lake) -> list[str]:
    """Read the files that are new or have changed, then write the sources concerned and the unified table. A source without files
    is skipped; without any it fails. Where no file is new, nothing is written."""
    read = landing.land(spark, landed, lake.landing)
    for source in landed:
        if source not in read:
            log.warning("no files for %s", source)
    stale = {s for s, n in read.items() if n or try_read(spark, lake.source(s)) is None}
    for source in stale:
        postings = landing.clean_postings(spark, source, lake.landing)
        if postings is None:  # files, but all without a byte or a record
            postings = spark.createDataFrame([], POSTING_SCHEMA)
        write_partitioned(postings, lake.source(source), ["source"])
    if stale or try_read(spark, lake.unified) is None:
        unified = unify(read_sources(spark, {s: lake.source(s) for s in read}))
        write_partitioned(unified, lake.unified, ["source", "pays"])
    return list(read)


def load_raw(spark: SparkSession, lake: Lake) -> DataFrame:
    """Append unified postings with unseen ids to the raw table. Returns the rows to load: those appended, and those that a
    run before has appended and not brought into the fact."""
    raw, batch = lake.table("raw_offres"), sanitise(spark.read.parquet(lake.unified))
    known = read_current(spark, raw)
    fresh = new_rows(batch.limit(0) if known is None else known, batch, order=(F.col("date_creation").desc_nulls_last(),))
    staged = staging_path(spark, "fresh")  # the table they are found against is about to hold them
    fresh.write.parquet(staged)
    fresh = spark.read.schema(fresh.schema).parquet(staged)
    append_current(fresh, raw)
    titled = read_current(spark, raw).filter(F.col("titre").isNotNull())  # the fact holds no others
    return fresh.unionByName(_left_over(titled, read_current(spark, lake.table("fact_offres")), fresh).select(fresh.columns))


def _left_over(raw: DataFrame, done: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Rows of the raw table that are neither done nor new. Only ids are compared; other columns are read if a run before has
    stopped half-way and left some."""
    ids = raw.select("offre_id").join(known_keys(fresh, "offre_id"), "offre_id", "left_anti")
    ids = _staged(ids if done is None else ids.join(known_keys(done, "offre_id"), "offre_id", "left_anti"), "left_over")
    return raw.limit(0) if ids.isEmpty() else raw.join(ids, "offre_id", "left_semi")


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_star(spark: SparkSession, lake: Lake, fresh: DataFrame) -> star.Star:
    """Append what new postings bring to the dimensions and to the fact. Hash keys tie old and new rows alike; postings
    that are known are not read."""
    staged = star.stage(fresh)
    dims = {"dim_date": star.dim_date(staged), "dim_entreprise": star.dim_company(staged),
            "dim_lieu": star.dim_place(staged)}
    exceptions = {}
    for name, df in dims.items():
        known, key = read_current(spark, lake.table(name)), df.columns[0]
        found = _add_to_dimension(spark, lake, name, df, known, key)
        if found is not None:
            exceptions[key] = found
    fact = lake.table("fact_offres")
    rows = with_month(star.fact_by_hash(staged, exceptions=exceptions))
    known = read_current(spark, fact)
    append_current(rows if known is None else new_rows(known, rows), fact, [MONTH])
    return read_star(spark, lake)


def _add_to_dimension(spark: SparkSession, lake: Lake, name: str, df: DataFrame, known: DataFrame | None, key: str) -> DataFrame | None:
    """Add the rows that a dimension does not hold, each with a key of its own. Returns the natural keys whose key is not their
    first hash, if there are any; they are stored before the dimension, so a run that stops between leaves no row without them."""
    natural, path = star.NATURAL[key], lake.table(f"cles_{name}")
    row = F.struct(*natural)
    new = df.withColumn("_row", row)
    if known is not None:
        new = new.join(known.select(row.alias("_row")), "_row", "left_anti")
    keys = _staged(settle_keys(new, natural, key, known), "settled")
    odd = keys.filter("essai > 0")
    if not odd.isEmpty():
        append_current(odd, path)
    fresh = new.drop(key).join(keys.select(key, row.alias("_row")), "_row").select(df.columns)
    append_current(fresh, lake.table(name))
    stored = read_current(spark, path)
    if stored is None:
        return None
    held = read_current(spark, lake.table(name)).select(key, row.alias("_row"))  # a run that stopped may have stored others
    return stored.withColumn("_row", row).join(held, [key, "_row"], "left_semi").select(stored.columns).distinct()


def with_month(fact: DataFrame) -> DataFrame:
    """The fact with the month it is partitioned by."""
    return fact.withColumn(MONTH, F.date_format("date_creation", "yyyy-MM"))


def load_skills(spark: SparkSession, lake: Lake, fresh: DataFrame, fact: DataFrame) -> bool:
    """Add the skills of new postings to the skill dimension and the bridge; nothing found changes nothing.

    Only postings not searched before are. Skills keep their number; one not seen before gets the next ones. A run that stops
    half-way is mended by the next: ``offres_comptees`` names the version of the dimension that counts a posting, before that
    version is there, and ``offres_reliees`` the postings whose pairs are in the bridge. Tables without these two are filled anew.
    """
    dim, log_path = lake.table("dim_competence"), lake.table("offres_comptees")
    known, log_, version = read_current(spark, dim), read_current(spark, log_path), current_version(spark, dim)
    raw = read_current(spark, lake.table("raw_offres"))
    done = None if log_ is None else log_.filter(F.col("version") <= version)
    new = fresh if done is None else fresh.join(known_keys(done, "offre_id"), "offre_id", "left_anti")
    rows = new.unionByName(_left_over(raw, done, fresh).select(fresh.columns))
    found = _staged(skills.skill_summary(rows, skills.dictionary()), "found")
    changes = not found.isEmpty()
    ids = _staged(rows.select("offre_id", F.lit(version + 1 if changes else version).alias("version")), "searched")
    if not ids.isEmpty():
        append_current(ids, log_path)
    if changes:
        if known is not None and log_ is None:
            known = known.withColumn("nb_offres", F.lit(0).cast("bigint"))
        publish(found if known is None else skills.add_counts(known, found), dim)
    linked = read_current(spark, dim) is not None and _link_skills(spark, lake, fact)
    return changes or linked


def _link_skills(spark: SparkSession, lake: Lake, fact: DataFrame) -> bool:
    """Add the pairs of the postings that the bridge has not had yet."""
    bridge, log_path = lake.table("bridge_offre_competence"), lake.table("offres_reliees")
    known, log_ = read_current(spark, bridge), read_current(spark, log_path)
    ids = fact.select("offre_id")
    ids = _staged(ids if log_ is None else ids.join(known_keys(log_, "offre_id"), "offre_id", "left_anti"), "to_link")
    if ids.isEmpty():
        return False
    pairs = skills.skill_bridge(fact.join(ids, "offre_id", "left_semi"), skills.read_dictionary(read_current(spark, lake.table("dim_competence"))))
    if known is None or log_ is None:
        publish(pairs, bridge)
    else:  # a run before may have written some and not logged them
        held = known.join(ids, "offre_id", "left_semi").select("offre_id", "competence_id")
        append_current(pairs.join(held, ["offre_id", "competence_id"], "left_anti").select(known.columns), bridge)
    append_current(ids, log_path)
    return True


def apply_predictions(spark: SparkSession, lake: Lake, predictions: DataFrame, at: Column) -> int:
    """Write predictions into the fact; returns the number of rows changed. Only months with changed rows are written anew."""
    fact = lake.table("fact_offres")
    updated = update_predictions(read_current(spark, fact), predictions, at)
    staged = staging_path(spark, "changed")
    updated.filter("modifie").drop("modifie").write.parquet(staged)
    changed = spark.read.parquet(staged)
    n = changed.count()
    if n:
        replace_in_partitions(changed, fact, "offre_id", MONTH)
    maintain(spark, lake)
    return n


def maintain(spark: SparkSession, lake: Lake) -> None:
    """Bring the kept aggregates up to the fact. Only folders of the fact that have come or gone since are read."""
    maintained.refresh(spark, lake.table("fact_offres"), lake.states)
    maintained.compact(spark, lake.states)


def predict_salaries(spark: SparkSession, lake: Lake, at: Column, force: bool = False,
                     settings: salary_model.ModelSettings = salary_model.ModelSettings()) -> int:
    """Train or load the model, predict the postings without a salary, export the predictions to gold and write them into the
    fact. Returns the number of postings changed."""
    raw = read_current(spark, lake.table("raw_offres"))
    model = salary_model.train_or_load(raw, lake.table("modele_salaire"), force, settings)
    predicted = salary_model.predict_batch(model, raw).filter(F.col(salary_model.PREDICTED).isNotNull())
    export = salary_model.prediction_export(predicted, at)
    written = publish(export, f"{lake.gold}/salaires_predits")
    return apply_predictions(spark, lake, written, at)


def refresh_vectors(spark: SparkSession, lake: Lake, postings: DataFrame, refit: bool = False) -> int:
    """Encode the postings whose text has no vector of the current model yet, and append the vectors. Returns their number.

    The text model is stored with the vectors and carries on until ``refit`` asks for a new one.
    """
    path = lake.table("modele_texte")
    version, model = recommend.train_or_load_text_model(spark, postings, path, refit)
    stored = read_current(spark, lake.table("vecteurs"))
    text = recommend.posting_text()
    known = postings.sparkSession.createDataFrame([], "offre_id string, texte_hash string") if stored is None else \
        stored.filter(F.col("modele") == version)
    fresh = recommend.refresh_vectors(postings, known, model, text).withColumn("modele", F.lit(version))
    staged = staging_path(spark, "vectors")
    fresh.write.parquet(staged)
    written = spark.read.schema(fresh.schema).parquet(staged)
    append_current(written, lake.table("vecteurs"))
    return written.count()


def current_vectors(spark: SparkSession, lake: Lake, postings: DataFrame) -> DataFrame:
    """(offre_id, vector): one for each posting with a vector of its current text by the current model."""
    stored = read_current(spark, lake.table("vecteurs"))
    version = recommend.text_model_version(spark, lake.table("modele_texte"))
    today = recommend.hashed_texts(postings, recommend.posting_text()).select("offre_id", "texte_hash").distinct()
    return stored.filter(F.col("modele") == version).join(today, ["offre_id", "texte_hash"], "left_semi").select("offre_id", "vector")


def register_candidates(spark: SparkSession, lake: Lake, incoming: DataFrame, now: Column) -> DataFrame:
    """Insert or update candidates by email in the stored table; returns the table."""
    path = lake.table("candidats")
    known = read_current(spark, path)
    existing = spark.createDataFrame([], CANDIDATE_SCHEMA) if known is None else known
    return publish(align(upsert_candidates(existing, skills.with_cv_skills(incoming), now), CANDIDATE_SCHEMA), path)


def run_daily(spark: SparkSession, landed: Mapping[str, str], lake: Lake) -> dict[str, object]:
    """All stages in order. Returns the sources built, the landed files that were rejected in whole or in part, the gold
    tables written, the quality of the unified table and the rows per source in the raw table."""
    sources = build_silver(spark, landed, lake)
    fresh = load_raw(spark, lake)
    tables = load_star(spark, lake, fresh)
    load_skills(spark, lake, fresh, tables.fact)
    maintain(spark, lake)
    unified = spark.read.parquet(lake.unified)
    written: Sequence[str] = write_named(gold.gold_tables(unified), lake.gold, gold.SKIP_WHEN_EMPTY)
    return {"sources": sources, "rejects": landing_rejects(spark, landed), "gold": list(written),
            "quality": marts.silver_quality(unified),
            "rows": marts.distribution(read_current(spark, lake.table("raw_offres")), "source")}


def read_star(spark: SparkSession, lake: Lake) -> star.Star:
    names = ("fact_offres", "dim_date", "dim_entreprise", "dim_lieu")
    fact, *dims = [read_current(spark, lake.table(n)) for n in names]
    return star.Star(fact.drop(MONTH), *dims)


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    return try_read(spark, f"{lake.gold}/{name}")
