"""Vocabularies, default labels and keyword flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacantia.functions.text import strip
from vacantia.schema import UNKNOWN, UNSPECIFIED

# Contract words by common label.
CONTRACT_WORDS = {
    "CDI": ("CDI", "PERMANENT", "FULL_TIME", "FULL-TIME"),
    "CDD": ("CDD", "TEMPORARY", "CONTRACT"),
    "Stage": ("STAGE", "INTERNSHIP", "INTERN"),
    "Alternance": ("ALTERNANCE", "APPRENTISSAGE"),
    "Freelance": ("FREELANCE", "SELF_EMPLOYED", "CONTRACTOR"),
}
OTHER_CONTRACT = "Autre"

# Keyword patterns for the salary model.
SENIOR_WORDS = r"\b(senior|lead|principal|architect|head|director|chief|expert|sr\.?)\b"
JUNIOR_WORDS = r"\b(junior|jr\.?|intern|stagiaire|apprenti|débutant)\b"
TECH_WORDS = r"\b(spark|kubernetes|kafka|airflow|mlops|llm|gpt|cloud|aws|azure|gcp)\b"


def contract_label(c: Column) -> Column:
    """Map the contract words of all sources to one vocabulary; anything else, NULL too, is 'Autre'."""
    word = F.upper(F.trim(c))
    label = F.lit(None).cast("string")
    for name, words in CONTRACT_WORDS.items():
        label = F.coalesce(label, F.when(word.isin(*words), F.lit(name)))
    return F.coalesce(label, F.lit(OTHER_CONTRACT))


def or_label(c: Column, label: str = UNSPECIFIED) -> Column:
    return F.coalesce(c, F.lit(label))


def category(c: Column) -> Column:
    """Model category: filled, lower-cased, stripped (in this order)."""
    return strip(F.lower(F.coalesce(c, F.lit(UNKNOWN))))


def keyword_flag(c: Column, pattern: str) -> Column:
    """1 when a whole keyword occurs, 0 otherwise and for NULL."""
    return F.coalesce(F.lower(c).rlike("(?U)" + pattern), F.lit(False)).cast("int")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
