"""The given tables seen as postings, candidates and raw records.

Each text runs in Spark SQL and in ANSI engines alike; ``{name}`` stands for a table. The given tables
hold no NULLs, so the bindings make some on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

POSTINGS = """
SELECT CAST(o.o_orderkey AS STRING) AS offre_id,
  concat(c.c_mktsegment, ' ', o.o_orderpriority) AS titre,
  CASE o.o_orderstatus WHEN 'F' THEN 'permanent' WHEN 'O' THEN ' Contract ' ELSE 'other' END AS type_contrat,
  nullif(o.o_orderpriority, '5-LOW') AS experience,
  CASE WHEN o.o_custkey % 9 = 0 THEN NULL ELSE concat(c.c_name, ' (', n.n_name, ')') END AS description,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE n.n_name END AS ville,
  CASE WHEN c.c_nationkey % 4 = 0 THEN NULL ELSE concat('R', CAST(c.c_nationkey % 6 AS STRING)) END AS region,
  CASE WHEN c.c_nationkey % 5 = 0 THEN NULL ELSE CAST(10000 + c.c_nationkey AS STRING) END AS code_postal,
  CAST(c.c_nationkey AS DOUBLE) / 2 AS latitude,
  CASE WHEN c.c_nationkey % 3 = 0 THEN NULL ELSE CAST(c.c_nationkey AS DOUBLE) / 4 END AS longitude,
  CASE WHEN c.c_nationkey = 3 THEN NULL ELSE r.r_name END AS pays,
  CASE WHEN o.o_custkey % 11 = 0 THEN NULL ELSE c.c_name END AS entreprise,
  CASE WHEN o.o_custkey % 13 = 0 THEN NULL ELSE c.c_mktsegment END AS secteur,
  CASE WHEN c.c_acctbal < 2000 THEN NULL WHEN c.c_acctbal < 6000 THEN 'PME' ELSE 'GE' END AS taille_entreprise,
  CASE WHEN o.o_orderkey % 6 = 1 THEN concat(CAST(20000 + o.o_orderkey % 900 * 10 AS STRING), ' - ',
    CAST(30000 + o.o_orderkey % 900 * 10 AS STRING), ' EUR')
    WHEN o.o_orderkey % 6 = 2 THEN 'Horaire de 12,5 Euros' END AS salaire_libelle,
  CASE WHEN o.o_orderkey % 6 = 0 THEN CAST(floor(o.o_totalprice / 10) AS INT) END AS salaire_min,
  CASE WHEN o.o_orderkey % 6 = 0 AND o.o_orderkey % 4 <> 0
    THEN CAST(floor(o.o_totalprice / 10) AS INT) + 5000 END AS salaire_max,
  CASE WHEN o.o_orderkey % 6 <> 0 AND o.o_orderkey % 5 <> 0
    THEN CAST(floor(o.o_totalprice / 120) AS DOUBLE) END AS salaire_predit_eur,
  CASE WHEN o.o_orderkey % 4 = 1 THEN 'haute' END AS salaire_confiance,
  substring(o.o_orderpriority, 1, 1) AS rome_code,
  nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS rome_libelle,
  concat('https://postings.example/', CAST(o.o_orderkey AS STRING)) AS url_offre,
  o.o_orderdate AS date_creation,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'src_a' WHEN 1 THEN 'src_b' ELSE 'src_c' END AS source
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# Documents as postings with long text. The title is the first line.
TEXT_POSTINGS = """
SELECT CAST(doc_id AS STRING) AS offre_id, split_part(text, chr(10), 1) AS titre, 'CDI' AS type_contrat,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'senior' END AS experience, text AS description,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS ville, CAST(NULL AS STRING) AS region,
  CAST(NULL AS STRING) AS code_postal, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
  lang AS pays, source AS entreprise, lang AS secteur, CAST(NULL AS STRING) AS taille_entreprise,
  CAST(NULL AS STRING) AS salaire_libelle,
  CASE WHEN doc_id % 5 < 2 THEN CAST(20000 + n_chars AS INT) END AS salaire_min,
  CASE WHEN doc_id % 5 = 1 THEN CAST(30000 + n_chars AS INT) END AS salaire_max,
  CASE WHEN doc_id % 5 = 2 THEN CAST(2000 + n_chars AS DOUBLE) END AS salaire_predit_eur,
  CAST(NULL AS STRING) AS salaire_confiance, CAST(NULL AS STRING) AS rome_code, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS rome_libelle,
  concat('https://postings.example/', CAST(doc_id AS STRING)) AS url_offre,
  CAST('2024-01-01' AS TIMESTAMP) AS date_creation, source
FROM {documents}
"""

# Every user turn is a CV handed in by the person of that conversation; later turns are newer versions.
CVS = """
SELECT conv_id * 10000 + turn AS candidat_id, concat('N', CAST(conv_id AS STRING)) AS nom,
  concat('P', CAST(turn AS STRING)) AS prenom, concat('c', CAST(conv_id AS STRING), '@cv.example') AS email,
  text AS texte_cv, CAST(CAST('2024-02-01' AS DATE) + CAST(turn AS INT) AS TIMESTAMP) AS updated_at, conv_id, turn
FROM {conversations} WHERE role = 'user'
"""

# Skills that occur in the documents, added to the dictionary.
CORPUS_SKILLS = (("License", "Corpus"), ("Apache", "Corpus"), ("The", "Corpus"), ("Der", "Corpus"), ("Go", "Corpus"))


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read once per folder."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def bind(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A binding as a DataFrame over the Parquet files."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def plain(text: str) -> str:
    """A binding as SQL over tables of the same names."""
    return text.format(**{t: t for t in TABLES})
