"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_WIDTH = 1000.0
NULL_RANGE = -(1 << 62)


def aggregate_with_median(df: DataFrame, keys: Sequence[str], value: str, median_name: str,
                          sums: Sequence[str] = (), weight: str = "1", width: float = BUCKET_WIDTH) -> DataFrame:
    """Group by ``keys``; sum the columns ``sums`` and give the exact (interpolated) median of ``value``.

    The built-in exact percentile holds all distinct values of a group in one task. Here rows are counted
    by (group, value), which combines equal values before the shuffle, and then by (group, value range of
    ``width``). The ranges tell where the middle ranks fall, and only those ranges are ordered by value.
    No task sees a whole group.

    ``weight`` is the column with the number of rows an input row stands for (default 1). NULL values count in ``sums``
    only. ``keys`` may be empty for the median of the whole table. Key values may be NULL: they are
    compared inside a struct, where NULL equals NULL.
    """
    carried = [f"_s_{n}" for n in sums]
    totals = [F.expr(f"sum({c}) AS {c}") for c in carried]
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    # NULL values sit in a range of their own below all others, which holds no ranks.
    value_range = F.coalesce(F.floor(F.col(value) / width), F.lit(NULL_RANGE))
    counted = (
        df.select(group.alias("_g"), F.col(value).alias("_v"), value_range.alias("_range"),
                  F.expr(f"CAST({weight} AS BIGINT) AS _w"), *[F.expr(f"`{n}` AS _s_{n}") for n in sums])
        .groupBy("_g", "_range", "_v").agg(F.sum("_w").alias("_c"), *totals)
    )
    ranges = counted.groupBy("_g", "_range").agg(F.expr("sum(IF(_v IS NULL, 0, _c)) AS _n"), *totals)
    middle = (
        ranges.selectExpr("_g", "_range", "_n", "sum(_n) OVER (PARTITION BY _g) AS _all",
                          "sum(_n) OVER (PARTITION BY _g ORDER BY _range ROWS UNBOUNDED PRECEDING) AS _upto",
                          *[f"sum({c}) OVER (PARTITION BY _g) AS {c}" for c in carried])
        .selectExpr("_g", "_range", "_upto", "_upto - _n AS _before", "floor((_all - 1) / 2) AS _low",
                    "floor(_all / 2) AS _high", *carried)
        # One or two ranges per group hold the middle ranks; a group without values keeps its NULL range.
        .filter("_before <= _high AND _upto > _low").drop("_upto")
    )
    inside = Window.partitionBy("_g", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = (
        counted.select("_g", "_range", "_v", "_c").join(middle, ["_g", "_range"])
        .select("_g", "_v", "_c", "_low", "_high", (F.sum("_c").over(inside) + F.col("_before")).alias("_to"), *carried)
    )

    def at(rank: str) -> Column:
        here = (F.col("_to") - F.col("_c") <= F.col(rank)) & (F.col("_to") > F.col(rank))
        return F.max(F.when(here, F.col("_v")))

    out = near.groupBy("_g").agg(*[F.expr(f"first({c}) AS `{n}`") for c, n in zip(carried, sums)],
                                 ((at("_low") + at("_high")) / 2.0).alias(median_name))
    return out.select(*[F.col("_g").getField(k).alias(k) for k in keys], *sums, median_name)
