"""Aggregates of the fact that are kept up to date instead of being computed anew.

A state holds sums by group and year that can be added and taken back: numbers of rows, exact sums and counts of amounts. What
is no sum is a group of its own: distinct values, first and last days are the groups that still have rows, so they too can be
taken back. Views are computed from the states, which have a row for each group and not for each posting.

A refresh compares two versions of the fact, the one that a state holds and the latest, by their lists of folders. It reads the
folders that have come, adds their rows, and those that have gone, and takes their rows away: new postings cost a scan of
these postings, and the rest of the fact is not opened. Of a month rewritten to replace some rows only these rows are read, as
they were and as they are, for the fact's version says where they lie. The result is appended to the state in the same step that
notes the version, so a refresh that stops has done nothing, a repeated one does nothing more, and of two at once one starts
again. A state whose version of the fact is no longer there is built from all rows.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia.functions.dates import day_label, week_start, whole_days_between
from vacantia.functions.labels import or_label
from vacantia.functions.measures import EXACT, percent, rounded_ratio
from vacantia.sources import commits
from vacantia.sources.tables import read_current

MONTH, YEAR = "mois_creation", "annee"  # what the fact and the states are partitioned by
AMOUNTS = ("salaire_min", "salaire_max", "salaire_predit_eur")


@dataclass(frozen=True)
class State:
    """Groups of a state, the amounts it sums and the columns whose values it counts."""

    keys: tuple[str, ...]
    amounts: tuple[str, ...] = ()
    present: tuple[str, ...] = ()

    @property
    def measures(self) -> list[str]:
        return ["n", *[f"s_{a}" for a in self.amounts], *[f"n_{c}" for c in (*self.amounts, *self.present)]]


STATES: Mapping[str, State] = {
    "jours_metiers": State(("jour", "source", "rome_libelle"), AMOUNTS, ("description", "experience")),
    "jours_entreprises": State(("source", "entreprise_id", "date_creation")),
    "entreprises_metiers": State(("entreprise_id", "rome_libelle"), AMOUNTS[:2]),
    "lieux": State(("lieu_id",)),
}


def partial(rows: DataFrame, state: State, sign: str) -> DataFrame:
    """The measures of some rows by year and group; ``sign`` is 1 for rows that come and -1 for rows that go. Groups where both
    are equal are left out."""
    signed = F.col(sign).cast("bigint")

    def total(a: str) -> Column:
        if rows.schema[a].dataType == T.IntegerType():  # exact in 64 bits, without a decimal for each row
            x = F.col(a) * signed
        else:
            x = F.when(signed > 0, F.col(a)).otherwise(-F.col(a)).cast(EXACT)
        return F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,4)")

    sums = [F.sum(signed).alias("n"), *[total(a).alias(f"s_{a}") for a in state.amounts],
            *[F.coalesce(F.sum(F.when(F.col(c).isNotNull(), signed)), F.lit(0)).alias(f"n_{c}") for c in (*state.amounts, *state.present)]]
    grouped = rows.withColumns({"jour": F.to_date("date_creation"), YEAR: F.year("date_creation")}).groupBy(YEAR, *state.keys).agg(*sums)
    return _with_content(grouped, state)


def _with_content(df: DataFrame, state: State) -> DataFrame:
    return df.where(" OR ".join(f"{m} <> 0" for m in state.measures))


def merged(stored: DataFrame, state: State, by: Sequence[str]) -> DataFrame:
    """Stored rows of a state added up."""
    summed = stored.groupBy(*by).agg(*[F.sum(m).cast(stored.schema[m].dataType).alias(m) for m in state.measures])
    return _with_content(summed, state)


def _steps(spark: SparkSession, fact: str, since: commits.Version, now: commits.Version) -> list[commits.Version]:
    """The versions from one to another, or only these two, without the note of what has changed, where one between is missing or
    has other columns."""
    between = [commits.read_version(spark, fact, n) for n in range(since.number + 1, now.number)]
    steps = [since, *between, now]
    if any(v is None or v.columns != now.columns for v in steps):
        return [since, replace(now, gone=None, kept=())]
    return steps


def changes(spark: SparkSession, fact: str, since: commits.Version | None, now: commits.Version, sign: str = "_sign") -> DataFrame:
    """The rows that a version of the fact has and an earlier one has not, with sign 1, and the other way round with -1. Only
    folders that are not in both are read, and where a version says which rows it has replaced, only these rows."""
    steps = [replace(now, folders=()), replace(now, gone=None, kept=())] if since is None else _steps(spark, fact, since, now)
    signs: Counter[str] = Counter()
    for before, after in zip(steps, steps[1:]):
        old, new = set(before.folders), set(after.folders)
        signs.update(new - old - set(after.kept))
        signs.subtract(old - new if after.gone is None else after.gone)
    came, gone = (replace(v, folders=tuple(sorted(f for f, n in signs.items() if n == s))) for v, s in ((now, 1), (steps[0], -1)))
    parts = [commits.read_table(spark, fact, v).withColumn(sign, F.lit(s)) for v, s in ((came, 1), (gone, -1))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def _next_version(spark: SparkSession, path: str, step: Callable[[commits.Version | None], commits.Version | None]) -> bool:
    """Make the next version of a table by a step, which is taken again if another writer has come before. False if there is
    nothing to do."""
    for _ in range(commits.ATTEMPTS):
        new = step(commits.read_version(spark, path))
        if new is None:
            return False
        try:
            commits.commit(spark, path, new)
            return True
        except commits.Conflict:
            time.sleep(0.05)
    raise commits.Conflict(path)


def refresh(spark: SparkSession, fact: str, root: str, names: Sequence[str] = tuple(STATES)) -> int:
    """Bring states up to the latest version of the fact, a table partitioned by month. Returns how many were behind."""
    done = 0
    for name in names:
        state, path = STATES[name], f"{root}/{name}"

        def step(held: commits.Version | None) -> commits.Version | None:
            now = commits.read_version(spark, fact)
            at = int(held.writes[-1]) if held else 0
            if now is None or at >= now.number:
                return None
            since = commits.read_version(spark, fact, at) if at else None
            rows = partial(changes(spark, fact, since, now), state, "_sign")
            same = since is not None and set(since.folders) == set(now.folders)
            new = [] if same else commits.write_lot(rows, path, (YEAR,), rebalance=True)
            kept = held.folders if held and since else ()
            return commits.Version(held.number + 1 if held else 1, (*kept, *new), commits._stored(rows).json(), (YEAR,), (str(now.number),))

        done += _next_version(spark, path, step)
    return done


def compact(spark: SparkSession, root: str, names: Sequence[str] = tuple(STATES), lots: int = 8) -> int:
    """Add up the years that lie in more than so many lots. Returns the number of states changed. Views stay the same."""
    done = 0
    for name in names:
        state, path = STATES[name], f"{root}/{name}"

        def step(held: commits.Version | None) -> commits.Version | None:
            years: dict[str, list[str]] = {}
            for folder in held.folders if held else ():
                years.setdefault(folder.split("/", 1)[1], []).append(folder)
            many = {f for folders in years.values() if len(folders) > lots for f in folders}
            if not many:
                return None
            rows = commits.read_table(spark, path, replace(held, folders=tuple(sorted(many))))
            new = commits.write_lot(merged(rows, state, [YEAR, *state.keys]), path, (YEAR,), rebalance=True)
            return replace(held, number=held.number + 1, folders=(*[f for f in held.folders if f not in many], *new))

        done += _next_version(spark, path, step)
    return done


def read_state(spark: SparkSession, root: str, name: str, since: Column | None = None) -> DataFrame:
    """A state's groups over all years, or from the year of a date on."""
    stored = read_current(spark, f"{root}/{name}")
    if since is not None:
        stored = stored.where(F.col(YEAR) >= F.year(since))
    return merged(stored, STATES[name], STATES[name].keys)


def _mean(a: str) -> Column:
    return rounded_ratio(F.sum(f"s_{a}"), F.sum(f"n_{a}"))


def _means() -> list[Column]:
    return [_mean("salaire_min").alias("salaire_moyen_min"), _mean("salaire_max").alias("salaire_moyen_max")]


def kpi_global(spark: SparkSession, root: str, places: DataFrame) -> DataFrame:
    """One row of totals, as ``marts.kpi_global`` gives it."""
    used = read_state(spark, root, "lieux").join(places.select("lieu_id", "ville"), "lieu_id")
    seen = read_state(spark, root, "jours_entreprises")
    n, low, predicted = F.sum("n"), F.sum("n_salaire_min"), F.sum("n_salaire_predit_eur")
    totals = read_state(spark, root, "jours_metiers").agg(
        F.coalesce(n, F.lit(0)).alias("total_offres"), F.count_distinct("source").alias("nb_sources"),
        F.count_distinct("rome_libelle").alias("nb_metiers"), *_means(), _mean("salaire_predit_eur").alias("salaire_predit_moyen"),
        F.coalesce(n - low, F.lit(0)).alias("offres_sans_salaire"), F.coalesce(predicted, F.lit(0)).alias("offres_avec_prediction"),
        percent(low, n).alias("pct_salaire_connu"), percent(predicted, n).alias("pct_salaire_predite"))
    return totals.withColumns({
        "nb_villes": used.agg(F.count_distinct("ville").alias("n")).scalar(),
        "nb_entreprises": seen.agg(F.count_distinct("entreprise_id").alias("n")).scalar(),
        "date_derniere_offre": seen.agg(F.max("date_creation").alias("d")).scalar()})


def kpi_source(spark: SparkSession, root: str) -> DataFrame:
    """Volume, salaries and fill rates per source, as ``marts.kpi_source`` gives them."""
    n, low = F.sum("n"), F.sum("n_salaire_min")
    volume = read_state(spark, root, "jours_metiers").groupBy("source").agg(
        n.alias("nb_offres"), F.count_distinct("rome_libelle").alias("nb_metiers"), *_means(), (n - low).alias("nb_sans_salaire"),
        percent(n - low, n).alias("pct_sans_salaire"), F.sum("n_salaire_predit_eur").alias("nb_avec_prediction"),
        percent(F.sum("n_description"), n).alias("pct_avec_description"), percent(F.sum("n_experience"), n).alias("pct_avec_experience"))
    seen = read_state(spark, root, "jours_entreprises").groupBy(F.col("source").alias("_source")).agg(
        F.count_distinct("entreprise_id").alias("nb_entreprises"), F.min("date_creation").alias("date_premiere_offre"),
        F.max("date_creation").alias("date_derniere_offre"))
    return volume.join(seen, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def kpi_company(spark: SparkSession, root: str, companies: DataFrame) -> DataFrame:
    """Volume, occupations, salaries and days on the market per company, as ``marts.kpi_company`` gives them."""
    seen = read_state(spark, root, "jours_entreprises").groupBy("entreprise_id").agg(
        F.min("date_creation").alias("first"), F.max("date_creation").alias("last"))
    # Both states hold the same companies, so their rows need not meet before they are grouped.
    rows = read_state(spark, root, "entreprises_metiers").unionByName(seen, allowMissingColumns=True)
    named = rows.join(companies.select("entreprise_id", "nom", "secteur", "taille"), "entreprise_id", "left")
    return named.groupBy("nom", "secteur", "taille").agg(
        F.sum("n").alias("nb_offres"), F.count_distinct("rome_libelle").alias("nb_metiers_differents"), *_means(),
        F.max("last").alias("derniere_offre"), whole_days_between(F.min("first"), F.max("last")).alias("duree_presence_jours"),
    ).withColumns({"nom": or_label(F.col("nom")), "secteur": or_label(F.col("secteur")), "taille": or_label(F.col("taille"))}) \
        .withColumnRenamed("nom", "entreprise")


def weekly_trend(spark: SparkSession, root: str, as_of: Column, months: int = 6) -> DataFrame:
    """Postings and salaries per week, source and occupation, as ``marts.weekly_trend`` gives them. Earlier years are not read."""
    since = F.add_months(as_of, -months)
    return read_state(spark, root, "jours_metiers", since).where(F.col("jour") >= since).groupBy(
        week_start(F.col("jour")).alias("semaine"), "source", F.col("rome_libelle").alias("metier")).agg(
        F.sum("n").alias("nb_offres"), *_means(), _mean("salaire_predit_eur").alias("salaire_predit_moyen")
    ).withColumn("semaine_label", day_label(F.col("semaine")))
