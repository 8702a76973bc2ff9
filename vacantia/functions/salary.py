"""Salary expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacantia.schema import UNKNOWN

# A range in text; yearly amounts start above 15,000; text amounts above 500 count;
# predictions are at least 500; training keeps 500 to 25,000 a month.
RANGE_PATTERN = r"(\d[\d\s]*)\s*[-–]\s*(\d[\d\s]*)"
YEARLY_ABOVE = 15_000
TEXT_AMOUNT_ABOVE = 500
PREDICTION_FLOOR = 500
TARGET_RANGE = (500, 25_000)


def salary_range(c: Column, pattern: str = RANGE_PATTERN) -> tuple[Column, Column]:
    """Lower and upper amount of a text such as '30000 - 45000 EUR'; NULL where absent or too large."""

    def bound(group: int) -> Column:
        return F.regexp_replace(F.regexp_extract(c, pattern, group), r"\s", "").try_cast("int")

    return bound(1), bound(2)


def monthly(amount: Column) -> Column:
    """Yearly amounts divided by twelve."""
    return F.when(amount > YEARLY_ABOVE, amount / 12).otherwise(amount)


def salary_from_text(c: Column) -> Column:
    """Monthly mean of the amounts above 500 in a text; NULL when there is none."""
    compact = F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    numbers = F.regexp_extract_all(compact, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))
    amounts = F.filter(F.transform(numbers, lambda n: n.try_cast("double")), lambda n: n > TEXT_AMOUNT_ABOVE)
    total = F.aggregate(amounts, F.lit(0.0), lambda acc, n: acc + n)
    return monthly(F.when(F.size(amounts) > 0, total / F.size(amounts)))


def monthly_target(low: Column, high: Column, text: Column) -> Column:
    """Monthly salary from the known bounds, else from the text. Bounds of zero or less do not count."""

    def positive(c: Column) -> Column:
        number = c.try_cast("double")
        return F.when(number > 0, number)

    low, high = positive(low), positive(high)
    known = F.coalesce((low + high) / 2, low, high)
    return F.coalesce(monthly(known), salary_from_text(text))


def mid_point(low: Column, high: Column) -> Column:
    """Middle of both bounds; NULL when one is missing. Added as doubles, so two large bounds cannot overflow."""
    return (low.cast("double") + high.cast("double")) / 2.0


def estimate(low: Column, high: Column, predicted: Column) -> Column:
    return F.coalesce(mid_point(low, high), predicted.cast("double"))


def floor_prediction(c: Column) -> Column:
    return F.greatest(c, F.lit(float(PREDICTION_FLOOR)))


def confidence(pays: Column, contrat: Column, secteur: Column, texte: Column) -> Column:
    """One point each for known country, contract, sector and a text over 100 characters."""

    def known(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")).isin(UNKNOWN, ""), 0).otherwise(1)

    long_text = F.when(F.length(F.coalesce(texte, F.lit(""))) > 100, 1).otherwise(0)
    score = known(pays) + known(contrat) + known(secteur) + long_text
    return F.when(score >= 3, "haute").when(score >= 2, "moyenne").otherwise("basse")


def score_percent(score: Column) -> Column:
    """Similarity as a percentage with one decimal, half to even."""
    return F.bround(score * 100, 1)
