"""Reporting views over the star, and quality checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions.dates import day_label, month_label, week_start, whole_days_between
from vacantia.functions.labels import flag, or_label
from vacantia.functions.measures import (EXACT, count_null, count_present, exact_sum, percent, rounded_mean,
                                         rounded_ratio)
from vacantia.functions.salary import estimate, mid_point
from vacantia.operators.median import aggregate_with_median
from vacantia.operators.profile import null_rates, quality_report
from vacantia.plans.star import Star
from vacantia.schema import DEFAULT_COUNTRY

# Prediction band used where a bound is unknown.
LOW_BAND, HIGH_BAND = "0.9", "1.1"

def flat_postings(star: Star) -> DataFrame:
    """Every posting with the attributes of its date, place and company."""
    fact, dates, places, companies = star.fact, star.dim_date, star.dim_place, star.dim_company
    joined = (
        fact.join(dates.select("date_id", "annee", "mois", "jour_semaine"), "date_id", "left")
        .join(places.select("lieu_id", "ville", "region", "pays", "latitude", "longitude"), "lieu_id", "left")
        .join(companies.select("entreprise_id", F.col("nom").alias("entreprise"), "secteur",
                               F.col("taille").alias("taille_entreprise")), "entreprise_id", "left")
    )
    return joined.select(
        "offre_id", "titre", "description", "type_contrat", "experience", "salaire_min", "salaire_max",
        "salaire_predit_eur", "salaire_confiance", F.col("rome_libelle").alias("metier"), "source", "url_offre",
        "date_creation", "annee", "mois", month_label(F.col("date_creation")).alias("annee_mois"), "jour_semaine",
        or_label(F.col("ville")).alias("ville"), or_label(F.col("region")).alias("region"),
        or_label(F.col("pays"), DEFAULT_COUNTRY).alias("pays"), "latitude", "longitude",
        or_label(F.col("entreprise")).alias("entreprise"), or_label(F.col("secteur")).alias("secteur"),
        or_label(F.col("taille_entreprise")).alias("taille_entreprise"),
        flag(F.col("salaire_min").isNotNull() & F.col("salaire_max").isNotNull()).alias("a_salaire_connu"),
        flag(F.col("salaire_predit_eur").isNotNull()).alias("a_salaire_predite"),
        estimate(F.col("salaire_min"), F.col("salaire_max"), F.col("salaire_predit_eur")).alias("salaire_estime"),
    )


def salary_market(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Salaries by occupation, country, city, contract and experience: means, means with the predicted band
    as fallback, and the exact median of the estimate.

    Postings are counted once, by place id and their three amounts, before they meet the places: all means and the median
    follow from these counts, so both branches read one shuffle of narrow rows, and a place holding much of the table is one
    row per value. Groups are formed on the raw place values: a NULL and its printed label are two groups.
    """
    amounts = ["salaire_min", "salaire_max", "salaire_predit_eur"]
    counted = (
        fact.filter(F.col("salaire_min").isNotNull() | F.col("salaire_predit_eur").isNotNull())
        .groupBy("rome_libelle", "lieu_id", "type_contrat", "experience", *amounts).agg(F.count("*").alias("n"))
    )
    placed = counted.join(places.select("lieu_id", "pays", "ville"), "lieu_id", "left")
    keys = ["rome_libelle", "pays", "ville", "type_contrat", "experience"]
    valued = placed.withColumn("_v", estimate(*[F.col(a) for a in amounts]))
    medians = aggregate_with_median(valued, keys, "_v", "_median", weight="n")

    low, high, predicted = (F.col(c).cast(EXACT) for c in amounts)
    parts = {
        "min": low, "max": high, "pred": predicted,
        "emin": F.coalesce(low, (predicted * F.lit(LOW_BAND).cast("decimal(2,1)")).cast(EXACT)),
        "emax": F.coalesce(high, (predicted * F.lit(HIGH_BAND).cast("decimal(2,1)")).cast(EXACT)),
    }
    n = F.col("n")
    means = placed.groupBy(*keys).agg(F.sum(n).alias("nb_offres"), *[
        rounded_ratio(F.sum(c * n), F.sum(F.when(c.isNotNull(), n))).alias(f"_{name}") for name, c in parts.items()])
    group = F.struct(*keys)  # compares NULL parts as equal
    out = means.withColumn("_g", group).join(medians.select(group.alias("_g"), "_median"), "_g")
    return out.select(
        F.col("rome_libelle").alias("metier"), or_label(F.col("pays"), DEFAULT_COUNTRY).alias("pays"),
        or_label(F.col("ville")).alias("ville"), "type_contrat", "experience", "nb_offres",
        F.col("_min").alias("salaire_moyen_min"), F.col("_max").alias("salaire_moyen_max"),
        F.col("_emin").alias("salaire_moyen_estime_min"), F.col("_emax").alias("salaire_moyen_estime_max"),
        F.col("_pred").alias("salaire_predit_moyen"), F.round("_median", 0).alias("salaire_mediane"))


def _means() -> list[Column]:
    return [rounded_mean(F.col("salaire_min")).alias("salaire_moyen_min"),
            rounded_mean(F.col("salaire_max")).alias("salaire_moyen_max")]


def _predicted_mean() -> Column:
    return rounded_mean(F.col("salaire_predit_eur")).alias("salaire_predit_moyen")


def kpi_global(fact: DataFrame, places: DataFrame) -> DataFrame:
    """One row of totals, distinct counts, means and coverage. Cities are counted over the distinct place
    ids, so postings are not joined."""
    used = fact.select("lieu_id").distinct().join(places.select("lieu_id", "ville"), "lieu_id")
    cities = used.agg(F.count_distinct("ville").alias("n")).scalar()
    n = F.count("*")
    totals = fact.agg(
        n.alias("total_offres"), F.count_distinct("source").alias("nb_sources"),
        F.count_distinct("entreprise_id").alias("nb_entreprises"),
        F.count_distinct("rome_libelle").alias("nb_metiers"), *_means(), _predicted_mean(),
        count_null(F.col("salaire_min")).alias("offres_sans_salaire"),
        count_present(F.col("salaire_predit_eur")).alias("offres_avec_prediction"),
        F.max("date_creation").alias("date_derniere_offre"),
        percent(count_present(F.col("salaire_min")), n).alias("pct_salaire_connu"),
        percent(count_present(F.col("salaire_predit_eur")), n).alias("pct_salaire_predite"),
    )
    return totals.withColumn("nb_villes", cities)


def kpi_source(fact: DataFrame) -> DataFrame:
    """Volume, salaries and fill rates per source."""
    n = F.count("*")
    return fact.groupBy("source").agg(
        n.alias("nb_offres"), F.count_distinct("entreprise_id").alias("nb_entreprises"),
        F.count_distinct("rome_libelle").alias("nb_metiers"), *_means(),
        count_null(F.col("salaire_min")).alias("nb_sans_salaire"),
        percent(count_null(F.col("salaire_min")), n).alias("pct_sans_salaire"),
        count_present(F.col("salaire_predit_eur")).alias("nb_avec_prediction"),
        F.min("date_creation").alias("date_premiere_offre"), F.max("date_creation").alias("date_derniere_offre"),
        percent(count_present(F.col("description")), n).alias("pct_avec_description"),
        percent(count_present(F.col("experience")), n).alias("pct_avec_experience"),
    )


def weekly_trend(fact: DataFrame, as_of: Column, months: int = 6) -> DataFrame:
    """Postings and salaries per week, source and occupation since ``months`` before ``as_of`` (a date)."""
    since = F.add_months(as_of, -months)
    return (
        fact.filter(F.col("date_creation") >= since)
        .groupBy(week_start(F.col("date_creation")).alias("semaine"), "source",
                 F.col("rome_libelle").alias("metier"))
        .agg(F.count("*").alias("nb_offres"), *_means(), _predicted_mean())
        .withColumn("semaine_label", day_label(F.col("semaine")))
    )


def kpi_company(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Volume, occupations, salaries and days on the market per company.

    Postings are first aggregated by company id and occupation; the companies join those rows.
    """
    pre = fact.groupBy("entreprise_id", "rome_libelle").agg(
        F.count("*").alias("n"), exact_sum(F.col("salaire_min")).alias("s_min"), F.count("salaire_min").alias("n_min"),
        exact_sum(F.col("salaire_max")).alias("s_max"), F.count("salaire_max").alias("n_max"),
        F.min("date_creation").alias("first"), F.max("date_creation").alias("last"))
    joined = pre.join(companies.select("entreprise_id", "nom", "secteur", "taille"), "entreprise_id", "left")
    return joined.groupBy("nom", "secteur", "taille").agg(
        F.sum("n").alias("nb_offres"), F.count_distinct("rome_libelle").alias("nb_metiers_differents"),
        rounded_ratio(F.sum("s_min"), F.sum("n_min")).alias("salaire_moyen_min"),
        rounded_ratio(F.sum("s_max"), F.sum("n_max")).alias("salaire_moyen_max"),
        F.max("last").alias("derniere_offre"),
        whole_days_between(F.min("first"), F.max("last")).alias("duree_presence_jours"),
    ).select(or_label(F.col("nom")).alias("entreprise"), or_label(F.col("secteur")).alias("secteur"),
             or_label(F.col("taille")).alias("taille"), "nb_offres", "nb_metiers_differents", "salaire_moyen_min",
             "salaire_moyen_max", "derniere_offre", "duree_presence_jours")


# Columns of the two quality tables; place and company are checked by their key.
FACT_QUALITY: Mapping[str, str] = {
    "titre": "titre", "description": "description", "salaire_min": "salaire_min",
    "salaire_predit_eur": "salaire_predit_eur", "experience": "experience", "ville": "lieu_id",
    "entreprise": "entreprise_id",
}
SILVER_QUALITY = ("titre", "entreprise", "ville", "type_contrat", "date_creation")


def data_quality(fact: DataFrame) -> DataFrame:
    return null_rates(fact, FACT_QUALITY)


def silver_quality(postings: DataFrame) -> DataFrame:
    return quality_report(postings, SILVER_QUALITY)


def salary_fallback(fact: DataFrame) -> DataFrame:
    """For postings without salary: median of their occupation and contract, else the global median.

    The global median takes every posting with a lower bound, a group's only those with both bounds (a
    missing bound gives no mid-point, so both see the same values). NULL occupation or contract matches no
    group. Medians are joined by occupation and contract, a table no larger than the number of their pairs.
    """
    middle = mid_point(F.col("salaire_min"), F.col("salaire_max"))
    known = fact.filter("salaire_min IS NOT NULL").select("rome_libelle", "type_contrat", middle.alias("_v"))
    pair = ["rome_libelle", "type_contrat"]
    medians = aggregate_with_median(known.filter("_v IS NOT NULL"), pair, "_v", "_median")
    overall = aggregate_with_median(known, [], "_v", "_all").select("_all").scalar()
    missing = fact.filter("salaire_min IS NULL").select("offre_id", *pair)
    return missing.join(medians, pair, "left").select(
        "offre_id", F.coalesce("_median", overall).alias("salaire_estime_fallback"))


def market_stats(fact: DataFrame, top: int = 5) -> DataFrame:
    """Total, postings by source, and the most frequent contracts, as (mesure, libelle, nb_offres)."""
    total = fact.agg(F.count("*").alias("nb_offres")).select(
        F.lit("total").alias("mesure"), F.lit(None).cast("string").alias("libelle"), "nb_offres")
    sources = fact.groupBy(F.col("source").alias("libelle")).agg(F.count("*").alias("nb_offres"))
    contracts = (
        fact.filter("type_contrat IS NOT NULL").groupBy(F.col("type_contrat").alias("libelle"))
        .agg(F.count("*").alias("nb_offres")).orderBy(F.desc("nb_offres"), "libelle").limit(top)
    )
    return (
        total.unionByName(sources.select(F.lit("source").alias("mesure"), "libelle", "nb_offres"))
        .unionByName(contracts.select(F.lit("contrat").alias("mesure"), "libelle", "nb_offres"))
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("nb"))
