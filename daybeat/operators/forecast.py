"""Trend-and-weekday forecasts of daily series, closed form and grouped by series.

All series are fitted together: a least-squares line on the day number, or one that bends, then the mean
residual per weekday, then a normal band from the remaining residual.
"""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import as_date, col

MIN_ROWS = 10
# Bends lie evenly in the first part of the history; the last days alone do not bend the forecast.
BENT_PART = 0.8
# Weight of the squared bends for each row, with days counted from 0 to 1 over the history.
PENALTY = 0.0005
# Keeps the slope of a history of one day defined.
_LEAST = 1e-9


def forecast_input(df: DataFrame, ds: str, y: str, key: str = "series",
                   min_rows: int = MIN_ROWS) -> DataFrame:
    """(key, ds, y) with both coerced and complete; series shorter than ``min_rows`` are left out."""
    rows = df.select(
        col(key).alias("series"),
        F.expr(f"try_cast(`{ds}` AS date)").alias("ds"),
        F.expr(f"try_cast(`{y}` AS double)").alias("y")).dropna(subset=["ds", "y"])
    long_enough = rows.groupBy("series").agg(F.count("*").alias("__n")).filter(
        F.col("__n") >= min_rows)
    return rows.join(long_enough.select("series"), "series", "left_semi")


def bend_places(bends: int) -> list[float]:
    """Where the trend may bend, in parts of the history's length."""
    return [BENT_PART * k / bends for k in range(1, bends + 1)]


def _solution(lower: list[list[Column]], right: list[Column]) -> Column:
    """array<double>: x with A x = b for a positive definite matrix, by elimination without row changes.

    ``lower`` holds the rows of A up to the diagonal.
    """
    n = len(right)
    system = F.array(*[F.array(*[lower[max(i, j)][min(i, j)] for j in range(n)], right[i]) for i in range(n)])

    def cleared(rows: Column, k: Column) -> Column:
        pivot = F.element_at(rows, k)
        return F.transform(rows, lambda row, i: F.when(i + 1 == k, row).otherwise(F.zip_with(
            row, pivot, lambda x, y: x - y * (F.element_at(row, k) / F.element_at(pivot, k)))))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(n)), system, cleared)
    return F.transform(solved, lambda row, i: F.element_at(row, n + 1) / F.element_at(row, i + 1))


def bent_trend(days: DataFrame, bends: int, penalty: float = PENALTY) -> DataFrame:
    """``days`` (series, t, y, ...) with ``trend``: least squares for a line that may bend at ``bends`` places.

    Columns are 1, the day as a part x of the history and max(0, x - place) for every place; the squared
    bends are penalised by ``penalty`` for each row. The products of the columns are summed by series, a
    fixed number of sums whatever its length, and the small system is solved per series. Rows without y
    get a trend but do not count; a series without any y has a null trend.
    """
    placed = days.withColumn("__x", col("t") / F.greatest(F.max(F.when(col("y").isNotNull(), col("t"))).over(
        Window.partitionBy("series")), F.lit(1.0)))
    x = col("__x")
    columns = [F.lit(1.0), x, *[F.greatest(x - F.lit(s), F.lit(0.0)) for s in bend_places(bends)]]
    weights = [0.0, _LEAST] + [penalty] * bends
    sums = [F.sum(a * b).alias(f"a{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns[:i + 1])]
    sums += [F.sum(a * col("y")).alias(f"b{i}") for i, a in enumerate(columns)]
    summed = placed.filter(col("y").isNotNull()).groupBy("series").agg(F.count("*").alias("n"), *sums)
    n = range(len(columns))
    lower = [[col(f"a{i}_{j}") + (col("n") * F.lit(weights[i]) if i == j else F.lit(0.0)) for j in range(i + 1)] for i in n]
    solved = summed.select(col("series").alias("__of"), _solution(lower, [col(f"b{i}") for i in n]).alias("__solution"))
    trend = reduce(Column.__add__, [c * F.element_at("__solution", i + 1) for i, c in enumerate(columns)])
    return (placed.join(solved, col("series").eqNullSafe(col("__of")), "left").withColumn("trend", trend)
            .drop("__x", "__of", "__solution"))


def forecast_components(history: DataFrame, horizon: int = 30, bends: int = 0, penalty: float = PENALTY) -> DataFrame:
    """Trend and weekly effect per series and day, over history and ``horizon`` further days.

    Further days join the history without a value, which every aggregate ignores; one shuffle
    by series then serves all windows. A series has one row per day, so its window is small.
    Without ``bends`` the trend is one straight line; else it may bend at so many places.
    """
    future = history.groupBy("series").agg(F.max("ds").alias("end")).select(
        "series", F.explode(F.sequence(F.date_add("end", 1), F.date_add("end", horizon))).alias("ds"),
        F.lit(None).cast("double").alias("y"))
    per_series = Window.partitionBy("series")
    days = history.select("series", "ds", "y").unionByName(future).withColumn(
        "t", F.datediff("ds", F.min("ds").over(per_series)).cast("double"))
    if bends:
        fitted = bent_trend(days, bends, penalty)
    else:
        slope = F.coalesce(F.regr_slope("y", "t").over(per_series), F.lit(0.0))
        intercept = F.coalesce(F.regr_intercept("y", "t").over(per_series), F.avg("y").over(per_series))
        fitted = days.withColumn("trend", intercept + slope * F.col("t"))
    fitted = fitted.withColumn("left", F.col("y") - F.col("trend"))
    weekly = F.avg("left").over(Window.partitionBy("series", F.weekday("ds")))
    fitted = fitted.withColumn("weekly", F.coalesce(weekly, F.lit(0.0)))
    noise = F.stddev_samp(F.col("left") - F.col("weekly")).over(per_series)
    return fitted.select("series", "ds", "trend", "weekly",
                         F.coalesce(noise, F.lit(0.0)).alias("noise"))


def forecast_trend_weekly(history: DataFrame, horizon: int = 30, interval: float = 0.80, bends: int = 0,
                          penalty: float = PENALTY) -> DataFrame:
    """(series, ds, yhat, yhat_lower, yhat_upper) over history and ``horizon`` further days."""
    width = NormalDist().inv_cdf((1 + interval) / 2)
    yhat = F.col("trend") + F.col("weekly")
    band = F.col("noise") * F.lit(width)
    return forecast_components(history, horizon, bends, penalty).select(
        "series", "ds", yhat.alias("yhat"), (yhat - band).alias("yhat_lower"),
        (yhat + band).alias("yhat_upper"))


def series_of(df: DataFrame, ds: str, y: str, name: str) -> DataFrame:
    """A named daily series in the long form the forecast expects."""
    return df.select(F.lit(name).alias("series"), as_date(col(ds)).alias("ds"), col(y).alias("y"))
