"""The six gold aggregates over unified postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions.dates import month_label
from vacantia.functions.labels import or_label
from vacantia.functions.measures import exact_sum
from vacantia.schema import UNKNOWN

# Lengths of the two rankings.
TOP_CITIES, TOP_SECTORS = 30, 20


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("offre_id").alias("nb_offres"))


def by_source(postings: DataFrame) -> DataFrame:
    """Per source and country. Labels are given after counting, so NULL and its label stay two rows."""
    return _counted(postings, "source", "pays").select(
        or_label(F.col("source"), UNKNOWN).alias("source"), or_label(F.col("pays")).alias("pays"), "nb_offres")


def by_contract(postings: DataFrame) -> DataFrame:
    counted = _counted(postings, "type_contrat")
    return counted.select(or_label(F.col("type_contrat")).alias("type_contrat"), "nb_offres").orderBy(
        F.desc("nb_offres"), "type_contrat")


def by_city(postings: DataFrame, top: int = TOP_CITIES) -> DataFrame:
    counted = _counted(postings.filter("ville IS NOT NULL"), "ville", "pays")
    return counted.orderBy(F.desc("nb_offres"), "ville", "pays").limit(top)


def salaries(postings: DataFrame) -> DataFrame:
    """Mean bounds per source over postings with a positive lower bound, half to even."""
    def mean(name: str) -> Column:
        c = F.col(name)
        return F.bround(F.try_divide(exact_sum(c).cast("double"), F.count(c).cast("double")), 0)

    return (
        postings.filter("salaire_min > 0 AND source IS NOT NULL").groupBy("source")
        .agg(mean("salaire_min").alias("salaire_min_moyen"), mean("salaire_max").alias("salaire_max_moyen"),
             F.count("offre_id").alias("nb_offres_avec_salaire"))
    )


def by_month(postings: DataFrame) -> DataFrame:
    dated = postings.filter("date_creation IS NOT NULL AND source IS NOT NULL")
    return _counted(dated.withColumn("annee_mois", month_label(F.col("date_creation"))), "annee_mois", "source").orderBy(
        "annee_mois", "source")


def by_sector(postings: DataFrame, top: int = TOP_SECTORS) -> DataFrame:
    counted = _counted(postings.filter("secteur IS NOT NULL"), "secteur")
    return counted.orderBy(F.desc("nb_offres"), "secteur").limit(top)


def gold_tables(postings: DataFrame) -> dict[str, DataFrame]:
    return {
        "offres_par_source": by_source(postings),
        "offres_par_contrat": by_contract(postings),
        "offres_par_ville": by_city(postings),
        "salaires": salaries(postings),
        "offres_par_mois": by_month(postings),
        "offres_par_secteur": by_sector(postings),
    }


SKIP_WHEN_EMPTY = ("salaires",)
