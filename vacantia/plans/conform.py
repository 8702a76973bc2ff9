"""From raw records of each source to the 22-column posting, and from sources to one table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.functions.cast import safe_double, safe_int, safe_string, safe_timestamp
from vacantia.functions.labels import contract_label
from vacantia.functions.salary import salary_range
from vacantia.functions.text import clean_text, key_md5
from vacantia.operators.dedup import best_source_per_posting, first_per_key, latest_per_key
from vacantia.schema import (DEFAULT_COUNTRY, LABOUR_API, LISTING_API, POSTING_COLUMNS, POSTING_SCHEMA, SCRAPED_SITE,
                             TEXT_WIDTHS)
from vacantia.sources.tables import align


# Where each posting column is found in the records of a source. Columns not listed have
# their own name there, or do not exist.
FIELDS: dict[str, dict[str, str]] = {
    LABOUR_API: {
        "offre_id": "id", "titre": "intitule", "type_contrat": "typeContrat", "experience": "experienceLibelle",
        "ville": "lieuTravail.libelle", "code_postal": "lieuTravail.codePostal",
        "latitude": "lieuTravail.latitude", "longitude": "lieuTravail.longitude", "entreprise": "entreprise.nom",
        "secteur": "secteurActiviteLibelle", "taille_entreprise": "trancheEffectifEtab",
        "salaire_libelle": "salaire.libelle", "rome_code": "romeCode", "rome_libelle": "romeLibelle",
        "url_offre": "origineOffre.urlOrigine", "date_creation": "dateCreation",
    },
    LISTING_API: {
        "offre_id": "id", "titre": "title", "type_contrat": "contract_type", "ville": "location.display_name",
        "entreprise": "company.display_name", "secteur": "category.label", "salaire_min": "salary_min",
        "salaire_max": "salary_max", "url_offre": "redirect_url", "date_creation": "created",
    },
    SCRAPED_SITE: {"url_offre": "url", "date_creation": "date_publication"},
}
LENIENT_COUNTRY = {LABOUR_API: "France", LISTING_API: "France", SCRAPED_SITE: "Maroc"}
SCRAPED_DATES = "dd.MM.yyyy"


def _scalar(schema: T.StructType, path: str) -> bool:
    """Whether a dotted path leads to a plain value."""
    at: T.DataType = schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.names:
            return False
        at = at[name].dataType
    return not isinstance(at, (T.StructType, T.ArrayType, T.MapType))


def raw_field(records: DataFrame, fields: Mapping[str, str], name: str) -> Column:
    """A posting column as landed: under its own name, else under the name of the source, else NULL."""
    present = [F.col(p) for p in (name, fields.get(name)) if p and _scalar(records.schema, p)]
    return F.coalesce(*present) if present else F.lit(None)


def _postings(records: DataFrame, source: str, computed: Callable[[dict[str, Column]], dict[str, Column]]) -> DataFrame:
    """Postings of one source: landed fields, replaced by the computed ones, in posting order and types. The file that a record
    was read from goes with it."""
    landed = {name: raw_field(records, FIELDS[source], name) for name in POSTING_COLUMNS}
    landed |= {name: safe_double(landed[name]) for name in ("latitude", "longitude")}
    landed |= {name: safe_int(landed[name]) for name in ("salaire_min", "salaire_max")}
    columns = {**landed, "titre": clean_text(landed["titre"]), "type_contrat": contract_label(landed["type_contrat"]),
               "source": F.lit(source), **computed(landed)}
    carried = [c for c in ("fichier",) if c in records.columns]
    return align(records.select(*[c.alias(name) for name, c in columns.items()], *carried), keep=carried)


def labour_postings(records: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Records of the labour-office API: the salary bounds are read from a text."""
    def computed(landed: dict[str, Column]) -> dict[str, Column]:
        low, high = salary_range(landed["salaire_libelle"])
        return {"salaire_min": low, "salaire_max": high, "pays": F.lit(country),
                "date_creation": safe_timestamp(landed["date_creation"])}

    return _postings(records, LABOUR_API, computed)


def listing_postings(records: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Records of the listing API: the first area is the region."""
    return _postings(records, LISTING_API, lambda landed: {
        "region": F.get("location.area", F.lit(0)), "pays": F.lit(country),
        "date_creation": safe_timestamp(landed["date_creation"])})


def scraped_postings(records: DataFrame, country: str | None = None) -> DataFrame:
    """Records of the scraped site: id from title, company and link; the region stands for the city; the
    skills text fills the sector; no description."""
    return _postings(records, SCRAPED_SITE, lambda landed: {
        "offre_id": key_md5(landed["titre"], landed["entreprise"], landed["url_offre"]),
        "description": F.lit(None), "ville": landed["region"], "secteur": F.col("competences"),
        "date_creation": safe_timestamp(landed["date_creation"], SCRAPED_DATES),
        **({} if country is None else {"pays": F.lit(country)})})


def keep_valid(df: DataFrame) -> DataFrame:
    """Postings with an id and a title of more than three characters."""
    return df.filter(F.col("offre_id").isNotNull() & (F.length("titre") > 3))


CONFORMERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    LABOUR_API: labour_postings, LISTING_API: listing_postings, SCRAPED_SITE: scraped_postings}


def clean_source(postings: DataFrame) -> DataFrame:
    """Valid postings of one source, the latest row per id."""
    return latest_per_key(keep_valid(postings))


def unify(sources: DataFrame) -> DataFrame:
    """Postings of all sources without cross-source copies."""
    return best_source_per_posting(sources)


def lenient_postings(records: DataFrame, source: str, fields: Mapping[str, str] | None = None,
                     country: str | None = None) -> DataFrame:
    """Rename what is there, leave the rest NULL. Values stay as landed, only typed (no contract labels,
    no salary parsing, no region from the area). A scraped record gets the hash id."""
    fields = FIELDS.get(source, {}) if fields is None else fields
    country = LENIENT_COUNTRY.get(source) if country is None else country
    columns = {name: raw_field(records, fields, name) for name in POSTING_COLUMNS}
    columns |= {"source": F.lit(source), "pays": F.lit(country)}
    scraped = source == SCRAPED_SITE
    if scraped:
        columns["offre_id"] = key_md5(columns["titre"], columns["entreprise"], columns["url_offre"])
    columns["date_creation"] = safe_timestamp(columns["date_creation"], SCRAPED_DATES if scraped else None)
    for number in ("latitude", "longitude"):
        columns[number] = safe_double(columns[number])
    for whole in ("salaire_min", "salaire_max"):
        columns[whole] = safe_int(columns[whole])
    return align(records.select(*[c.alias(name) for name, c in columns.items()]))


def clean_lenient(postings: DataFrame) -> DataFrame:
    """Stripped titles of more than three characters, 'None' and 'nan' dropped; one row per id (latest)."""
    titled = postings.withColumn("titre", F.trim("titre")).filter(
        (F.length("titre") > 3) & ~F.col("titre").isin("None", "nan"))
    return first_per_key(titled, ["offre_id"], [F.col("date_creation").desc_nulls_last()])


def sanitised_columns(df: DataFrame) -> list[Column]:
    """The columns of ``sanitise``, in order."""
    def column(field: T.StructField) -> Column:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in TEXT_WIDTHS:
            return safe_string(c, TEXT_WIDTHS[field.name])
        if isinstance(field.dataType, T.IntegerType):
            return safe_int(c)
        if isinstance(field.dataType, T.DoubleType):
            return safe_double(c)
        return safe_timestamp(c)

    return [column(f).alias(f.name) for f in POSTING_SCHEMA.fields]


def sanitise(df: DataFrame) -> DataFrame:
    """Postings ready for the warehouse table: stripped, null words gone, cut to width, safely typed."""
    return df.select(*sanitised_columns(df))


def sanitise_rejects(df: DataFrame) -> DataFrame:
    """How many values of each typed column ``sanitise`` has to give up: those that hold something and fit no value of the type.
    One pass over all columns."""
    typed = [f.name for f in POSTING_SCHEMA.fields if f.name not in TEXT_WIDTHS and f.name in df.columns]
    clean_of = dict(zip(POSTING_SCHEMA.names, sanitised_columns(df)))
    lost = [F.count_if(safe_string(F.col(c)).isNotNull() & clean_of[c].isNull()).alias(c) for c in typed]
    counts = df.agg(*lost)
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(c).alias("nb_rejetees")) for c in typed])).alias("r")
                         ).select("r.*")
