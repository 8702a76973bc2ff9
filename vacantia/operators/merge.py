"""Keyed writes on tables without a transaction log. Each function gives the new content as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions.text import NULL_MARK
from vacantia.operators.dedup import first_per_key
from vacantia.operators.keys import hash_key


def known_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys; repeated keys are combined before the shuffle, which then also serves the join."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def new_rows(target: DataFrame, batch: DataFrame, key: str = "offre_id", order: tuple[Column, ...] = ()) -> DataFrame:
    """Rows of the batch, one per key, whose key is not in the target yet (insert, ignore on conflict).

    Known rows go first, so that only new ones are ordered.
    """
    unknown = batch.join(known_keys(target, key), key, "left_anti").select(*batch.columns)
    return first_per_key(unknown, [key], list(order))


def insert_ignore(target: DataFrame, batch: DataFrame, key: str = "offre_id",
                  order: tuple[Column, ...] = ()) -> DataFrame:
    """Target plus the new rows of the batch."""
    return target.unionByName(new_rows(target, batch, key, order))


def delete_insert(target: DataFrame, batch: DataFrame, key: str = "offre_id") -> DataFrame:
    """Target without the keys of the batch, plus the whole batch."""
    kept = target.join(known_keys(batch, key), key, "left_anti")
    return kept.unionByName(batch)


def delete_insert_kinds(target: DataFrame, batch: DataFrame, key: str, kind: str, names: tuple[str, str, str], hashed: bool = False) -> DataFrame:
    """The rows of target and batch, with a column ``kind`` that says by one of three ``names`` whether a row stays, is new, or goes.
    Those that stay and the new ones are what ``delete_insert`` gives.

    ``hashed`` is for batches of many keys: the keys are distinct, so no task gets many more than others, and a hash of a task's
    keys spares the order of the target's whole rows. Else Spark decides by the size it sees.
    """
    stays, new, goes = (F.lit(n) for n in names)
    keys = known_keys(batch, key).withColumn("_hit", F.lit(True))
    met = target.join(keys.hint("shuffle_hash") if hashed else keys, key, "left")
    old = met.select(*target.columns, F.when(F.col("_hit"), goes).otherwise(stays).alias(kind))
    return old.unionByName(batch.withColumn(kind, new))


def sync_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target and batch under the columns of the batch: new columns are NULL in old rows, vanished ones go."""
    return target.unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def upsert_candidates(existing: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Insert candidates by email, or update name, text and skills. Id and creation time stay.

    New ids are hashes of the email, so they need neither a counter nor an order.
    """
    fresh = first_per_key(incoming.withColumn("updated_at", F.coalesce("updated_at", now)), ["email"],
                          [F.col("updated_at").desc_nulls_last()])
    fields = ["nom", "prenom", "texte_cv", "competences"]
    old, new = existing.alias("old"), fresh.alias("new")
    touched = F.col("new.email").isNotNull()
    return old.join(new, F.col("old.email") == F.col("new.email"), "full_outer").select(
        F.coalesce("old.candidat_id", hash_key(F.col("new.email"))).alias("candidat_id"),
        F.coalesce("new.email", "old.email").alias("email"),
        *[F.when(touched, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields],
        F.coalesce("old.created_at", "new.updated_at").alias("created_at"),
        F.when(touched, F.col("new.updated_at")).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )


# The confidence written with batch predictions, and the one they may replace.
BATCH_CONFIDENCE = "moyenne"
FALLBACK_CONFIDENCE = "basse (fallback)"


def update_predictions(fact: DataFrame, predictions: DataFrame, at: Column,
                       label: Column | str = BATCH_CONFIDENCE, replace_fallback: bool = True) -> DataFrame:
    """Write predictions where the salary is unknown and nothing better is stored.

    ``predictions`` has ``offre_id, salaire_predit_eur``. The extra column ``modifie`` marks the rows
    written, so a count of it is the number of updates.
    """
    label = F.lit(label) if isinstance(label, str) else label
    unique = first_per_key(
        predictions.filter("salaire_predit_eur IS NOT NULL").select("offre_id", F.col("salaire_predit_eur").alias("_p")),
        ["offre_id"], [])
    open_ = F.col("salaire_predit_eur").isNull()
    if replace_fallback:
        open_ = open_ | F.coalesce(F.col("salaire_confiance") == FALLBACK_CONFIDENCE, F.lit(False))
    joined = fact.join(unique, "offre_id", "left").withColumn(
        "modifie", F.col("_p").isNotNull() & F.col("salaire_min").isNull() & open_)
    kind = fact.schema["salaire_predit_eur"].dataType
    replaced = {
        "salaire_predit_eur": F.when(F.col("modifie"), F.col("_p").cast(kind)).otherwise(F.col("salaire_predit_eur")),
        "salaire_confiance": F.when(F.col("modifie"), label).otherwise(F.col("salaire_confiance")),
        "date_prediction": F.when(F.col("modifie"), at).otherwise(F.col("date_prediction")),
    }
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in fact.columns], "modifie")


def content_hash(*parts: Column) -> Column:
    """Tells whether a row's content changed."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]), 256)
