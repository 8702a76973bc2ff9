"""Fixed schemas: landed records per source, the 22-column posting, the star, and load widths."""

from __future__ import annotations

from pyspark.sql import types as T

# The `source` labels found in landed data, best source first. The position is the
# priority when the same posting comes from several sources.
LABOUR_API = "france_travail"
LISTING_API = "adzuna"
SCRAPED_SITE = "emploima"
SOURCE_PRIORITY = (LABOUR_API, LISTING_API, SCRAPED_SITE)

# Labels that stand for a missing value.
UNSPECIFIED = "Non renseigné"
UNKNOWN = "inconnu"
SCRAPED_MISSING = "Non precise"
DEFAULT_COUNTRY = "France"


TEXT, WHOLE, NUMBER, TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*texts: str, **others: T.DataType) -> T.StructType:
    """A struct of text fields, then the other fields."""
    fields = {**dict.fromkeys(texts, TEXT), **others}
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_POSTING_TYPES = {"latitude": NUMBER, "longitude": NUMBER, "salaire_min": WHOLE, "salaire_max": WHOLE,
                  "date_creation": TIME}
POSTING_COLUMNS = (
    "offre_id", "titre", "type_contrat", "experience", "description", "ville", "region", "code_postal", "latitude",
    "longitude", "pays", "entreprise", "secteur", "taille_entreprise", "salaire_libelle", "salaire_min",
    "salaire_max", "rome_code", "rome_libelle", "url_offre", "date_creation", "source",
)
POSTING_SCHEMA = T.StructType([T.StructField(n, _POSTING_TYPES.get(n, TEXT)) for n in POSTING_COLUMNS])

# Width of each text column in the warehouse table; None is unbounded text.
TEXT_WIDTHS = {
    "offre_id": 200, "titre": 500, "type_contrat": 50, "experience": 100, "description": None,
    "ville": 200, "region": 200, "code_postal": 20, "pays": 50, "entreprise": 300, "secteur": 200,
    "taille_entreprise": 100, "salaire_libelle": 300, "rome_code": 20, "rome_libelle": 200,
    "url_offre": None, "source": 50,
}

# Numbers of landed records are read as text: one that does not fit its type must not cost its record.
LABOUR_RECORD = _struct(
    "id", "intitule", "typeContrat", "experienceLibelle", "description", "secteurActiviteLibelle",
    "trancheEffectifEtab", "romeCode", "romeLibelle", "dateCreation",
    lieuTravail=_struct("libelle", "codePostal", "latitude", "longitude"), entreprise=_struct("nom"),
    salaire=_struct("libelle"), origineOffre=_struct("urlOrigine"),
)
LISTING_RECORD = _struct(
    "id", "title", "contract_type", "description", "redirect_url", "created", "latitude", "longitude", "salary_min",
    "salary_max", location=_struct("display_name", area=T.ArrayType(TEXT)), company=_struct("display_name"),
    category=_struct("label"),
)
SCRAPED_RECORD = _struct(
    "titre", "entreprise", "niveau_etudes", "experience", "type_contrat", "region", "competences",
    "date_publication", "url_offre", "url", "source", "pays", "ville",
)
RECORD_SCHEMAS = {LABOUR_API: LABOUR_RECORD, LISTING_API: LISTING_RECORD, SCRAPED_SITE: SCRAPED_RECORD}


# One landed document: header fields and the records, each still as JSON text.
ENVELOPE = _struct("source", "keyword", "date_collecte", "nb_offres", offres=T.ArrayType(TEXT))


CANDIDATE_SCHEMA = T.StructType([
    T.StructField("candidat_id", T.LongType()), *_struct("nom", "prenom", "email", "texte_cv", "competences").fields,
    T.StructField("created_at", TIME), T.StructField("updated_at", TIME)])
