"""Casts that give NULL where outside data does not fit. Spark 4 casts throw otherwise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacantia.functions.text import strip

# Words that mean "no value" in loaded text.
NULL_WORDS = ("None", "nan", "NaN", "")


def safe_string(c: Column, width: int | None = None) -> Column:
    """Stripped text; null words become NULL; cut to the column width when there is one."""
    text = strip(c.cast("string"))
    text = F.when(text.isin(*NULL_WORDS), None).otherwise(text)
    return text if width is None else F.left(text, F.lit(width))


def safe_double(c: Column) -> Column:
    """Number or NULL; NaN is NULL."""
    number = strip(c.cast("string")).try_cast("double")
    return F.when(F.isnan(number), None).otherwise(number)


def safe_int(c: Column) -> Column:
    """Truncated towards zero; NULL when not a number or outside 32 bits."""
    return safe_double(c).try_cast("int")


def safe_timestamp(c: Column, pattern: str | None = None) -> Column:
    """Timestamp, or NULL when it does not parse."""
    text = c.cast("string")
    return F.try_to_timestamp(text) if pattern is None else F.try_to_timestamp(text, F.lit(pattern))
