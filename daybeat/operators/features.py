"""Per-user features and column scaling.

Scaling and imputation need column statistics first and read their input twice. The input
has one row per user; pass a table written by ``session.keep`` when it is costly to derive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col, half_even, numeric_columns
from ..functions.quantiles import exact_quantiles, group_brackets, quantiles_in_brackets
from ..session import keep, one_row
from .impute import fill_median

# The metrics of a user profile.
PROFILE_METRICS = ("TotalSteps", "Calories", "VeryActiveMinutes", "FairlyActiveMinutes",
                   "LightlyActiveMinutes", "SedentaryMinutes", "TotalSleepMinutes")
NOT_METRICS = ("Id", "id", "logId", "KMeans_Cluster", "DBSCAN_Cluster")


def ts_features(series: DataFrame, key: str = "id", value: str = "value") -> DataFrame:
    """Minimal feature set per user from (id, time, value); deviations use ddof 0.

    One pass aggregates everything but the median and brackets that; a second pass settles it.
    """
    v, name = col(value), f"{value}__"
    rows = series.filter(v.isNotNull() & col(key).isNotNull()).select(col(key), v)
    stats = keep(rows.groupBy(col(key)).agg(
        F.sum(v).alias(name + "sum_values"),
        F.avg(v).alias(name + "mean"),
        F.count(v).alias(name + "length"),
        F.stddev_pop(v).alias(name + "standard_deviation"),
        F.var_pop(v).alias(name + "variance"),
        F.sqrt(F.avg(v * v)).alias(name + "root_mean_square"),
        F.max(v).alias(name + "maximum"),
        F.max(F.abs(v)).alias(name + "absolute_maximum"),
        F.min(v).alias(name + "minimum"),
        *group_brackets({"median": v}, 0.5)))
    medians = quantiles_in_brackets(rows, stats, [key], {"median": v}, 0.5).withColumnRenamed(
        "median", name + "median")
    return stats.join(medians, key).select(
        col(key), *[col(name + f) for f in FEATURES])


FEATURES = ("sum_values", "median", "mean", "length", "standard_deviation", "variance", "root_mean_square",
            "maximum", "absolute_maximum", "minimum")
# Buckets of one pass over the range that holds a median, and passes.
BUCKETS, PASSES = 64, 2


def ts_features_of_segments(segments: DataFrame, key: str = "id", value: str = "value") -> DataFrame:
    """``ts_features`` of the minutes that straight runs stand for, without writing them out.

    ``segments`` has (key, v, step, last): values ``v + k * step`` for ``k = 0 .. last``. Sums, squares and
    extremes of a run are closed forms, and so is the number of its minutes below a bound, which is what
    finding a median takes; only the minutes next to it are looked at one by one.
    """
    n = (col("last") + 1).cast("double")
    v, step, end = col("v"), col("step"), col("v") + col("step") * col("last")
    runs = keep(segments.filter(col(key).isNotNull() & (col("last") >= 0)).select(
        col(key).alias("key"), "v", "step", (col("last") + 1).cast("long").alias("n"), F.least(v, end).alias("least"),
        F.greatest(v, end).alias("most"), (n * v + step * n * (n - 1) / 2).alias("total"),
        (n * v * v + v * step * n * (n - 1) + step * step * (n - 1) * n * (2 * n - 1) / 6).alias("squares")))
    sums = keep(runs.groupBy("key").agg(
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.sum("n").alias("n"),
        F.min("least").alias("least"), F.max("most").alias("most")))
    mean, square = col("total") / col("n"), col("squares") / col("n")
    variance = F.greatest(square - mean * mean, F.lit(0.0))
    shown = {"sum_values": col("total"), "median": col("median"), "mean": mean, "length": col("n"),
             "standard_deviation": F.sqrt(variance), "variance": variance, "root_mean_square": F.sqrt(square),
             "maximum": col("most"), "absolute_maximum": F.greatest(F.abs("most"), F.abs("least")), "minimum": col("least")}
    return sums.join(_medians_of_runs(runs, sums), "key").select(
        col("key").alias(key), *[shown[f].alias(f"{value}__{f}") for f in FEATURES])


def _below(x: Column) -> Column:
    """Minutes of a run below ``x``: the first ones of a rising run, the last ones of a falling one."""
    n, place = col("n"), F.try_divide(x - col("v"), col("step"))
    rising = F.greatest(F.lit(0), F.least(n, F.ceil(place)))
    falling = n - F.greatest(F.lit(0), F.least(n, F.floor(place) + 1))
    return (F.when(col("step") > 0, rising).when(col("step") < 0, falling)
            .otherwise(F.when(col("v") < x, n).otherwise(F.lit(0)))).cast("long")


def _medians_of_runs(runs: DataFrame, sums: DataFrame) -> DataFrame:
    """(key, median): the range of the two middle ranks is counted down, then its minutes are ordered."""
    middle = col("n") - 1
    ranges = sums.select("key", col("least").alias("lo"), (col("most") + F.abs("most") * 1e-9 + 1e-9).alias("hi"),
                         F.lit(0).cast("long").alias("under"), F.floor(middle / 2).alias("low_rank"),
                         F.ceil(middle / 2).alias("high_rank"))
    width = (col("hi") - col("lo")) / BUCKETS

    def edge(j: Column) -> Column:
        return F.when(j == BUCKETS, col("hi")).otherwise(col("lo") + j * width)

    def place(x: Column, off: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), F.floor((x - col("lo")) / width) + off)).cast("int")

    for _ in range(PASSES):
        ranges = keep(ranges)
        # One bucket more on either side: rounding must not lose an edge.
        inside = runs.join(ranges, "key").withColumn("j", F.explode(F.sequence(place(col("least"), -1), place(col("most"), 1))))
        counts = (inside.select("key", "j", (_below(edge(col("j") + 1)) - _below(edge(col("j")))).alias("c"))
                  .filter("c > 0").groupBy("key", "j").agg(F.sum("c").alias("c")))
        so_far = F.sum("c").over(Window.partitionBy("key").orderBy("j"))
        counted = counts.join(ranges, "key").withColumn("upto", col("under") + so_far)
        first, second = (F.min(F.when(col("upto") > col(r), col("j"))) for r in ("low_rank", "high_rank"))
        before = F.max(F.when(col("upto") <= col("low_rank"), col("upto")))
        names = ("lo", "hi", "under", "low_rank", "high_rank")
        found = counted.groupBy("key", *names).agg(first.alias("j1"), second.alias("j2"), before.alias("before"))
        ranges = found.select("key", edge(col("j1")).alias("lo"), edge(col("j2") + 1).alias("hi"),
                              F.coalesce("before", "under").alias("under"), "low_rank", "high_rank")
    ranges = keep(ranges)
    joined = runs.join(ranges, "key").withColumn("a", _below(col("lo"))).withColumn("b", _below(col("hi"))).filter("b > a")
    rising = F.sequence(col("a"), col("b") - 1)
    falling = F.sequence(col("n") - col("b"), col("n") - col("a") - 1)
    ks = F.when(col("step") > 0, rising).when(col("step") < 0, falling).otherwise(F.array(F.lit(0).cast("long")))
    weight = F.when(col("step") == 0, col("b") - col("a")).otherwise(F.lit(1))
    values = (joined.select("key", "v", "step", weight.alias("w"), F.explode(ks).alias("k"))
              .groupBy("key", (col("v") + col("step") * col("k")).alias("value")).agg(F.sum("w").alias("w")))
    upto = F.sum("w").over(Window.partitionBy("key").orderBy("value"))
    ordered = values.join(ranges, "key").withColumn("upto", col("under") + upto)
    low, high = (F.min(F.when(col("upto") > col(r), col("value"))) for r in ("low_rank", "high_rank"))
    return ordered.groupBy("key").agg(((low + high) / 2).alias("median"))


def drop_empty_features(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row."""
    counts = one_row(df.agg(*[F.count(col(c)) for c in df.columns]))
    return df.select(*[col(c) for c, n in zip(df.columns, counts) if n])


def _finite(c: Column) -> Column:
    infinite = F.lit(float("inf"))
    return F.when(~F.isnan(c) & (F.abs(c) < infinite), c)


def impute_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """+inf -> largest, -inf -> smallest, missing -> median finite value; no finite value -> 0."""
    finite = df.select(*[_finite(col(c).cast("double")).alias(c) for c in cols])
    ends = one_row(finite.agg(*[a for i, c in enumerate(cols) for a in (
        F.max(col(c)).alias(f"hi{i}"), F.min(col(c)).alias(f"lo{i}"))]))
    medians = exact_quantiles(finite, {c: [0.5] for c in cols})
    new = {}
    for i, c in enumerate(cols):
        v = col(c).cast("double")
        hi, lo, mid = ends[f"hi{i}"], ends[f"lo{i}"], medians[c][0]
        if hi is None:
            hi = lo = mid = 0.0
        new[c] = (F.when(v.isNull() | F.isnan(v), F.lit(mid))
                  .when(v == F.lit(float("inf")), F.lit(hi))
                  .when(v == F.lit(float("-inf")), F.lit(lo)).otherwise(v))
    return df.withColumns(new)


def minmax_scale(df: DataFrame, cols: Sequence[str], epsilon: float = 1e-9) -> DataFrame:
    """(x - min) / (max - min + epsilon); with epsilon 0 a constant column becomes 0."""
    ends = one_row(df.agg(*[a for i, c in enumerate(cols) for a in (
        F.max(col(c)).cast("double").alias(f"hi{i}"), F.min(col(c)).cast("double").alias(f"lo{i}"))]))
    new = {}
    for i, c in enumerate(cols):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        span = None if lo is None else (hi - lo + epsilon) or 1.0
        new[c] = (col(c).cast("double") - F.lit(lo)) / F.lit(span)
    return df.withColumns(new)


def standard_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = one_row(df.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}"))]))
    return df.withColumns({
        c: (col(c).cast("double") - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)
        for i, c in enumerate(cols)})


def user_features(df: DataFrame, key: str = "Id") -> DataFrame:
    """Mean of every numeric metric per user; gaps take the median over users, then 0."""
    metrics = numeric_columns(df, NOT_METRICS + (key,))
    # written once: the medians read them, and then the rows that they fill
    means = keep(df.filter(col(key).isNotNull()).groupBy(col(key))
                 .agg(*[F.avg(col(c)).alias(c) for c in metrics]))
    return fill_median(means, metrics).fillna(0.0, subset=metrics)


def user_features_fixed(df: DataFrame, key: str = "Id",
                        metrics: Sequence[str] = PROFILE_METRICS) -> DataFrame:
    """Mean of the named metrics per user, rounded to 3 places, complete users only."""
    present = [c for c in metrics if c in df.columns]
    return (df.filter(col(key).isNotNull()).groupBy(col(key))
            .agg(*[half_even(F.avg(col(c)), 3).alias(c) for c in present]).dropna())
