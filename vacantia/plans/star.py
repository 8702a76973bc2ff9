"""Star schema: staging, dimensions, fact."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions.dates import weekday_name
from vacantia.functions.labels import or_label
from vacantia.operators.keys import dense_ids, exact_keys, family_key, hash_key
from vacantia.schema import DEFAULT_COUNTRY, POSTING_SCHEMA

COMPANY_KEY = ("nom", "secteur", "taille")
PLACE_KEY = ("ville", "region", "pays", "code_postal", "latitude", "longitude")
FACT_COLUMNS = (
    "offre_id", "date_id", "entreprise_id", "lieu_id", "source", "titre", "type_contrat", "salaire_min",
    "salaire_max", "salaire_libelle", "salaire_predit_eur", "salaire_confiance", "date_prediction", "rome_code",
    "rome_libelle", "experience", "description", "url_offre", "date_creation",
)


class Star(NamedTuple):
    fact: DataFrame
    dim_date: DataFrame
    dim_company: DataFrame
    dim_place: DataFrame


def stage(raw: DataFrame) -> DataFrame:
    """Typed postings with id and title. Posting columns are cast, or NULL where absent; further columns are kept."""
    others = [c for c in raw.columns if c not in POSTING_SCHEMA.names]
    typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in raw.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in POSTING_SCHEMA.fields], *others)
    return typed.filter(F.col("offre_id").isNotNull() & F.col("titre").isNotNull())


def _company() -> dict[str, Column]:
    return {"nom": or_label(F.col("entreprise")), "secteur": or_label(F.col("secteur")),
            "taille": or_label(F.col("taille_entreprise"))}


def _place() -> dict[str, Column]:
    return {"ville": or_label(F.col("ville")), "region": F.col("region"),
            "pays": or_label(F.col("pays"), DEFAULT_COUNTRY), "code_postal": F.col("code_postal"),
            "latitude": F.col("latitude").cast("double"), "longitude": F.col("longitude").cast("double")}


def _date() -> Column:
    return F.to_date("date_creation")


def _numbered(rows: DataFrame, key: tuple[str, ...], id_name: str, dense: bool) -> DataFrame:
    if dense:
        return dense_ids(rows, key, id_name)
    return rows.select(hash_key(*[F.col(k) for k in key]).alias(id_name), *key)


def dim_date(staged: DataFrame, dense: bool = False) -> DataFrame:
    dates = staged.filter(F.col("date_creation").isNotNull()).select(_date().alias("date_full")).distinct()
    day = F.col("date_full")
    return _numbered(dates, ("date_full",), "date_id", dense).select(
        "date_id", "date_full", F.year(day).alias("annee"), F.month(day).alias("mois"),
        F.weekofyear(day).alias("semaine"), weekday_name(day).alias("jour_semaine"))


def dim_company(staged: DataFrame, dense: bool = False) -> DataFrame:
    rows = staged.select(*[c.alias(n) for n, c in _company().items()]).distinct()
    return _numbered(rows, COMPANY_KEY, "entreprise_id", dense)


def dim_place(staged: DataFrame, dense: bool = False) -> DataFrame:
    rows = staged.select(*[c.alias(n) for n, c in _place().items()]).distinct()
    return _numbered(rows, PLACE_KEY, "lieu_id", dense)


def _fact_columns(df: DataFrame, with_predictions: bool) -> DataFrame:
    empty = {"salaire_predit_eur": "decimal(10,2)", "salaire_confiance": "string", "date_prediction": "timestamp"}

    def column(name: str) -> Column:
        if name in empty and not (with_predictions and name in df.columns):
            return F.lit(None).cast(empty[name]).alias(name)
        if name in df.columns:
            return F.col(name)
        return F.lit(None).cast(POSTING_SCHEMA[name].dataType).alias(name)

    return df.select(*[column(n) for n in FACT_COLUMNS])


#: The natural keys of the dimensions, by the name of the id.
NATURAL: dict[str, tuple[str, ...]] = {"date_id": ("date_full",), "entreprise_id": COMPANY_KEY, "lieu_id": PLACE_KEY}


def _natural() -> dict[str, dict[str, Column]]:
    return {"date_id": {"date_full": _date()}, "entreprise_id": _company(), "lieu_id": _place()}


def fact_by_hash(staged: DataFrame, with_predictions: bool = False, exceptions: Mapping[str, DataFrame] | None = None,
                 bits: int = 64) -> DataFrame:
    """The fact with hash keys. They are computed from the row, so nothing is joined or shuffled; only where two natural keys have
    had one hash are the few ``exceptions``, by the name of the id, looked up."""
    keyed = staged.withColumns({name: family_key(0, list(parts.values()), bits) for name, parts in _natural().items()})
    for name, listed in (exceptions or {}).items():
        keyed = exact_keys(keyed, name, _natural()[name], listed)
    keyed = keyed.withColumn("date_id", F.when(_date().isNotNull(), F.col("date_id")))
    return _fact_columns(keyed, with_predictions)


def fact_by_join(staged: DataFrame, dates: DataFrame, companies: DataFrame, places: DataFrame,
                 match: str = "full", with_predictions: bool = False) -> DataFrame:
    """The fact with the ids of given dimensions.

    ``match="full"`` joins on the whole natural key and gives one row per posting. ``match="name"`` joins
    the company on its name and the place on city and country only; a posting is then repeated for each
    dimension row of that name. Only keys and ids of the dimensions are read. Whether a dimension is small
    enough to broadcast, and how hot names are split, is decided at run time from the sizes seen.
    """
    if match not in ("full", "name"):
        raise ValueError(f"match must be 'full' or 'name', not {match!r}")
    company = _company() if match == "full" else {"nom": _company()["nom"]}
    place = _place() if match == "full" else {k: _place()[k] for k in ("ville", "pays")}
    out = staged.withColumn("_d", _date()).join(
        dates.select("date_id", F.col("date_full").alias("_d")), "_d", "left")
    # A struct compares NULL parts as equal, which optional parts of the place key need.
    for key, dim, id_name in ((company, companies, "entreprise_id"), (place, places, "lieu_id")):
        out = out.withColumn("_k", F.struct(*[c.alias(n) for n, c in key.items()]))
        out = out.join(dim.select(id_name, F.struct(*key).alias("_k")), "_k", "left")
    return _fact_columns(out, with_predictions)


def build_star(staged: DataFrame, dense: bool = False, match: str = "full",
               with_predictions: bool = False) -> Star:
    """All four tables. Hash keys by default: stable between runs, so an incremental fact keeps its links."""
    dims = dim_date(staged, dense), dim_company(staged, dense), dim_place(staged, dense)
    if dense or match == "name":
        fact = fact_by_join(staged, *dims, match=match, with_predictions=with_predictions)
    else:
        fact = fact_by_hash(staged, with_predictions)
    return Star(fact, *dims)
