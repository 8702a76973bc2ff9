"""Skill detection in postings and CVs, and the views over it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vacantia.functions.measures import exact_sum, percent, rounded_ratio
from vacantia.functions.text import found_names, join_list, split_list
from vacantia.operators.substrings import found_in, pairs_in
from vacantia.session import ship_package

# Skills looked for in postings, by category, in order.
SKILLS_BY_CATEGORY: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Langage", ("Python", "SQL", "Scala", "Java", "R", "Bash", "Pandas", "NumPy")),
    ("Big Data", ("Apache Spark", "Spark", "Hadoop", "Kafka", "Hive", "Flink")),
    ("Orchestration", ("Airflow",)),
    ("Transformation", ("dbt", "Talend", "Informatica")),
    ("Cloud", ("AWS", "Azure", "GCP", "S3")),
    ("Stockage", ("MinIO", "HDFS")),
    ("Base de données", ("PostgreSQL", "MySQL", "MongoDB", "Cassandra", "Redis")),
    ("Data Warehouse", ("Snowflake", "BigQuery", "Redshift")),
    ("ML", ("Machine Learning", "Deep Learning", "NLP", "TensorFlow", "PyTorch", "Scikit-learn", "MLflow",
            "Hugging Face")),
    ("Visualisation", ("Power BI", "Tableau", "Looker", "Grafana", "Matplotlib")),
    ("DevOps", ("Docker", "Kubernetes", "Git", "CI/CD", "Terraform")),
    ("API", ("FastAPI", "Flask", "REST")),
)

# Skills looked for in CVs, in order.
CV_SKILLS: tuple[str, ...] = (
    "python", "java", "scala", "r", "sql", "nosql", "bash", "javascript", "typescript", "c++", "go", "rust", "julia",
    "spark", "pyspark", "hadoop", "kafka", "airflow", "dbt", "luigi", "nifi", "flink", "beam", "databricks",
    "delta lake",
    "postgresql", "mysql", "mongodb", "cassandra", "redis", "elasticsearch", "snowflake", "bigquery", "redshift",
    "hive", "hbase",
    "aws", "azure", "gcp", "google cloud", "s3", "ec2", "lambda", "kubernetes", "docker", "terraform", "ansible",
    "machine learning", "deep learning", "tensorflow", "pytorch", "keras", "scikit-learn", "nlp", "llm",
    "transformers", "bert", "gpt", "computer vision", "mlflow", "kubeflow",
    "power bi", "tableau", "looker", "metabase", "grafana", "matplotlib", "seaborn", "plotly", "d3.js",
    "etl", "elt", "data warehouse", "data lake", "data mesh", "lakehouse", "agile", "scrum", "ci/cd", "git",
    "github", "gitlab",
    "analyse de données", "modélisation", "statistiques", "data quality", "data governance", "api rest",
    "microservices",
)

BRIDGE_FIELD = "description"


class Skill(NamedTuple):
    competence_id: int
    nom: str
    categorie: str


def dictionary(extra: Sequence[tuple[str, str]] = ()) -> list[Skill]:
    """The skills numbered from 1; ``extra`` (name, category) pairs follow."""
    pairs = [(name, category) for category, names in SKILLS_BY_CATEGORY for name in names] + list(extra)
    return [Skill(i, name, category) for i, (name, category) in enumerate(pairs, start=1)]


def skill_table(spark: SparkSession, skills: Sequence[Skill]) -> DataFrame:
    return spark.createDataFrame(list(skills), "competence_id INT, nom STRING, categorie STRING")


def read_dictionary(table: DataFrame) -> list[Skill]:
    """A stored skill dimension as a dictionary that travels with the plan. A larger one stays a table: ``skill_contains``."""
    return sorted(Skill(*r) for r in table.select("competence_id", "nom", "categorie").collect())


def skill_words(postings: DataFrame, skills: DataFrame, keep: Sequence[str] = ("offre_id",)) -> DataFrame:
    """One row per posting and skill found as whole words, for dictionaries of any size. Texts are scanned once and don't travel.

    Names without a letter or digit are never found. ``skills`` has competence_id and nom.
    """
    names = skills.select("competence_id", F.lower("nom").alias("_nom")).filter(F.col("_nom").rlike(r"(?U)\w"))
    return pairs_in(_searched(postings, keep), "_text", names, "_nom", "competence_id", keep, whole=True).distinct()


def skill_contains(postings: DataFrame, skills: DataFrame, keep: Sequence[str] = ("offre_id",)) -> DataFrame:
    """One row per posting and skill whose name it contains anywhere, for dictionaries of any size."""
    names = skills.select("competence_id", F.lower("nom").alias("_nom"))
    return pairs_in(_searched(postings, keep), "_text", names, "_nom", "competence_id", keep)


def _searched(postings: DataFrame, keep: Sequence[str], per_field: bool = True) -> DataFrame:
    """Title and description as one lower-cased text. A line break, which no name holds, keeps a match from spanning both."""
    blank = F.lit("")
    joined = F.concat(F.coalesce("titre", blank), F.lit("\n" if per_field else " "), F.coalesce("description", blank))
    return postings.select(*keep, F.lower(joined).alias("_text"))


def skill_matches(postings: DataFrame, skills: Sequence[Skill], keep: Sequence[str] = ("offre_id",),
                  per_field: bool = True, boundary: bool = False) -> DataFrame:
    """One row per posting and skill found, with the columns to keep.

    The dictionary travels with the tasks, so postings are read once and not joined. Title and description are searched as one
    text; with ``per_field`` a line break keeps a match from spanning both. ``boundary`` asks for whole words; the default is
    plain containment, which finds 'r' in 'spark'.
    """
    ship_package(postings.sparkSession)
    found = found_in(F.col("_text"), [s.nom.lower() for s in skills], boundary)
    ids = F.array(*[F.lit(s.competence_id) for s in skills])
    at = _searched(postings, keep, per_field).select(*keep, F.explode(found).alias("_at"))
    return at.select(*keep, F.get(ids, "_at").alias("competence_id"))


AMOUNTS = ("salaire_min", "salaire_max", "salaire_predit_eur")


def skill_bridge(postings: DataFrame, skills: Sequence[Skill], unique_ids: bool = False, boundary: bool = False,
                 amounts: bool = False) -> DataFrame:
    """Posting id and skill id, each pair once.

    With ``unique_ids`` postings have one row per id and the pairs need no shuffle to be distinct. Such a
    bridge may carry the salary columns (``amounts``), which spares ``skill_top`` the join to the fact.
    """
    if amounts and not unique_ids:
        raise ValueError("amounts can be carried only when posting ids are unique")
    pairs = skill_matches(postings, skills, ("offre_id", *(AMOUNTS if amounts else ())), boundary=boundary)
    pairs = pairs if unique_ids else pairs.distinct()
    return pairs.withColumn("source_champ", F.lit(BRIDGE_FIELD))


def skill_top(bridge: DataFrame, skills: DataFrame, fact: DataFrame) -> DataFrame:
    """Skills by number of postings, with their share and mean salaries.

    A bridge that carries salaries is only aggregated; otherwise it is joined to the fact by posting id.
    Rows are aggregated by skill id before they meet the skill names.
    """
    total = fact.agg(F.count("*").alias("n")).scalar()
    if set(AMOUNTS) <= set(bridge.columns):
        rows, postings = bridge, F.count("offre_id")
    else:
        rows = bridge.select("offre_id", "competence_id").join(fact.select("offre_id", *AMOUNTS), "offre_id", "left")
        postings = F.count_distinct("offre_id")
    per_skill = rows.groupBy("competence_id").agg(
        postings.alias("nb_offres"),
        *[exact_sum(F.col(a)).alias(f"s_{a}") for a in AMOUNTS], *[F.count(a).alias(f"n_{a}") for a in AMOUNTS])
    named = per_skill.join(skills, "competence_id")
    return named.select(
        F.col("nom").alias("competence"), "categorie", "nb_offres",
        percent(F.col("nb_offres"), total).alias("pct_offres"),
        *[rounded_ratio(F.col(f"s_{a}"), F.col(f"n_{a}")).alias(out) for a, out in
          zip(AMOUNTS, ("salaire_moyen_min", "salaire_moyen_max", "salaire_predit_moyen"))],
    ).orderBy(F.desc("nb_offres"), "competence")


def skill_demand(bridge: DataFrame, skills: DataFrame) -> DataFrame:
    """All skills with the number of postings, zero included."""
    counts = bridge.groupBy("competence_id").agg(F.count_distinct("offre_id").alias("n"))
    return skills.join(counts, "competence_id", "left").select(
        F.col("nom").alias("competence"), "categorie", F.coalesce("n", F.lit(0)).alias("nb_offres_detectees"),
    ).orderBy(F.desc("nb_offres_detectees"), "competence")


def skill_summary(postings: DataFrame, skills: Sequence[Skill], boundary: bool = False) -> DataFrame:
    """Skills found at least once, renumbered in dictionary order, with the number of postings.

    The last step numbers at most one row per dictionary entry.
    """
    found = skill_matches(postings, skills, keep=(), per_field=False, boundary=boundary)
    counts = found.groupBy("competence_id").agg(F.count("*").alias("nb_offres"))
    names = skill_table(postings.sparkSession, skills)
    listed = counts.join(names, "competence_id").agg(
        F.sort_array(F.collect_list(F.struct("competence_id", "nom", "categorie", "nb_offres"))).alias("l"))
    return listed.select(F.posexplode("l").alias("at", "s")).select(
        (F.col("at") + 1).alias("competence_id"), "s.nom", "s.categorie", "s.nb_offres")


def add_counts(known: DataFrame, found: DataFrame) -> DataFrame:
    """A skill dimension with the counts of further postings added. Skills keep their number; new ones follow."""
    last = known.agg(F.coalesce(F.max("competence_id"), F.lit(0))).scalar()
    both = found.withColumnsRenamed({"competence_id": "_at", "nb_offres": "_more"}).join(known, ["nom", "categorie"], "full_outer")
    new = F.row_number().over(Window.partitionBy(F.col("competence_id").isNull()).orderBy("_at"))  # at most the dictionary
    return both.select(
        F.coalesce("competence_id", new + last).cast("int").alias("competence_id"), "nom", "categorie",
        (F.coalesce("nb_offres", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("nb_offres"))


def skill_matrix(bridge: DataFrame, skills: DataFrame, fact: DataFrame, places: DataFrame,
                 companies: DataFrame) -> DataFrame:
    """Posting and skill rows with posting, place and company attributes, for cross filtering."""
    return (
        bridge.select("offre_id", "competence_id").join(skills, "competence_id").join(fact, "offre_id")
        .join(places.select("lieu_id", "ville", "pays"), "lieu_id", "left")
        .join(companies.select("entreprise_id", F.col("nom").alias("entreprise"), "secteur"), "entreprise_id", "left")
        .select("offre_id", "titre", F.col("rome_libelle").alias("metier"), "source", "type_contrat", "experience",
                F.col("nom").alias("competence"), "categorie", "salaire_min", "salaire_max", "salaire_predit_eur",
                "salaire_confiance", "ville", "pays", "entreprise", "secteur")
    )


def with_cv_skills(candidates: DataFrame, names: Sequence[str] = CV_SKILLS, text: str = "texte_cv") -> DataFrame:
    """Add the skills found in the CV as a comma-joined list, in dictionary order."""
    lowered = candidates.withColumn("_cv", F.lower(text))
    found = F.coalesce(F.array_distinct(found_names(F.col("_cv"), names)), F.array().cast("array<string>"))
    return lowered.withColumn("competences", join_list(found)).drop("_cv")


def candidate_skills(candidates: DataFrame) -> DataFrame:
    """One row per candidate and listed skill, with the length of the CV."""
    return candidates.select(
        "candidat_id", "nom", "prenom", "email", "created_at",
        F.explode(split_list(F.col("competences"))).alias("competence"), F.length("texte_cv").alias("taille_cv"))


def lookup_candidates(candidates: DataFrame, emails: Sequence[str] | DataFrame) -> DataFrame:
    """Candidates by email: a list of emails is pushed to the scan, a table of emails is joined."""
    if isinstance(emails, DataFrame):
        return candidates.join(emails.select("email").distinct(), "email", "left_semi").select(*candidates.columns)
    return candidates.filter(F.col("email").isin(*emails))
