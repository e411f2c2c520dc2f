"""Approximate quantiles and distinct counts from sketches that are kept by day and merged for any range of days.

An option beside the exact quantiles: a sketch has a fixed size whatever the rows, so a year of days is
read instead of its values. The error of a quantile is one of rank, not of value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .columns import as_date, col

LOG_K = 13                  # two to this power are the registers of a sketch of distinct values
DISTINCT_ERROR = 0.04       # of a distinct count, as a share of it: more than three standard errors
K = 800                     # size of a sketch
RANK_ERROR = 0.02           # of a quantile from sketches of that size, several times what is usual


def daily_sketches(df: DataFrame, day: str, cols: Sequence[str], k: int = K) -> DataFrame:
    """(day, one sketch per column); rows without a day are left out, nulls count for nothing."""
    return (df.filter(col(day).isNotNull()).groupBy(as_date(col(day)).alias("day"))
            .agg(*[F.kll_sketch_agg_double(col(c).cast("double"), F.lit(k)).alias(c) for c in cols]))


def _between(sketches: DataFrame, first: str | None, last: str | None) -> DataFrame:
    for limit, keeps in ((first, Column.__ge__), (last, Column.__le__)):
        if limit is not None:
            sketches = sketches.filter(keeps(col("day"), F.lit(limit).cast("date")))
    return sketches


def sketch_quantiles(sketches: DataFrame, cols: Sequence[str], probs: Sequence[float], first: str | None = None,
                     last: str | None = None) -> DataFrame:
    """(column, p, rows, quantile) over the days from ``first`` to ``last``; null without values."""
    merged = _between(sketches, first, last).agg(*[F.kll_merge_agg_double(col(c)).alias(c) for c in cols])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(float(p)).alias("p"), F.coalesce(F.kll_sketch_get_n_double(col(c)), F.lit(0)).alias("rows"),
        F.when(F.kll_sketch_get_n_double(col(c)) > 0, F.kll_sketch_get_quantile_double(col(c), F.lit(float(p)))).alias("quantile"))
        for c in cols for p in probs])
    return merged.select(F.inline(rows))


def daily_distinct(df: DataFrame, day: str, cols: Sequence[str], log_k: int = LOG_K) -> DataFrame:
    """(day, one sketch of the different values per column); rows without a day are left out."""
    return (df.filter(col(day).isNotNull()).groupBy(as_date(col(day)).alias("day"))
            .agg(*[F.hll_sketch_agg(col(c).cast("string"), F.lit(log_k)).alias(c) for c in cols]))


def distinct_between(sketches: DataFrame, cols: Sequence[str], first: str | None = None,
                     last: str | None = None) -> DataFrame:
    """(column, days, distinct): about how many different values the days from ``first`` to ``last`` have.

    A value of several days counts once. Nulls do not count; without days the counts are 0.
    """
    united = _between(sketches, first, last).agg(F.count("*").alias("__days"), *[F.hll_union_agg(col(c)).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("__days").alias("days"),
                              F.coalesce(F.hll_sketch_estimate(col(c)), F.lit(0)).alias("distinct")) for c in cols])
    return united.select(F.inline(rows))
