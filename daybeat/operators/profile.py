"""Data profiling: sizes, gaps, distributions and cleaning summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.columns import col, first_column, numeric_columns, text_columns
from ..functions.ordered import previous_value
from ..functions.quantiles import exact_quantiles
from ..session import keep, one_row
from .clean import EXPORT_FORMATS, parsed

# Names of id columns and texts of the cleaning report.
ID_NAMES = ("id", "user_id", "userid", "logid")
NUMBERS_FILLED = "filled — interpolation"
TEXTS_FILLED = "filled with 'Unknown'"
TIMES_DROPPED = "rows with bad timestamps dropped"


def _missing(df: DataFrame) -> Column:
    """Missing cells of one row."""
    return reduce(lambda a, b: a + b, [col(c).isNull().cast("long") for c in df.columns])


def profile_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and completeness in percent."""
    width = len(df.columns)
    counted = df.agg(F.count("*").alias("rows"),
                     F.coalesce(F.sum(_missing(df)), F.lit(0)).alias("missing_cells"))
    share = F.col("missing_cells") / (F.col("rows") * F.lit(width)) * 100
    return counted.select(
        "rows", F.lit(width).cast("long").alias("columns"), "missing_cells",
        F.when(F.col("rows") > 0, F.lit(100.0) - share).otherwise(F.lit(0.0)).alias("completeness"))


def null_summary(df: DataFrame) -> DataFrame:
    """Nulls per column, one row per column."""
    counts = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [col(c) for c in df.columns], "column", "nulls")


def null_summary_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Nulls per column of several tables."""
    parts = [null_summary(df).select(F.lit(name).alias("table"), "column", "nulls")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, quartiles, max.

    Numbers have no unique/top/freq; texts and booleans (True, False) no moments. Days and times are
    seconds since 1970 without a std. Columns of other types are left out. Text frequencies come from a
    two-level count (per value, then per column), so no task holds all values of a column.
    """
    times = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    booleans = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    df = df.withColumns({c: F.unix_micros(col(c).cast("timestamp")) / F.lit(1e6) for c in times} | {
        c: F.initcap(col(c).cast("string")) for c in booleans})
    numbers, texts = numeric_columns(df), text_columns(df)
    parts = []
    if numbers:
        values = keep(df.select(*[col(c) for c in numbers]))        # passed over several times
        quartiles = exact_quantiles(values, {c: [0.25, 0.5, 0.75] for c in numbers})
        rows = F.array(*[F.struct(
            F.lit(c).alias("column"), F.count(col(c)).alias("count"),
            F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("long").alias("freq"), F.avg(col(c)).alias("mean"),
            (F.lit(None).cast("double") if c in times else F.stddev_samp(col(c))).alias("std"), F.min(col(c)).cast("double").alias("min"),
            *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ("q25", "q50", "q75"))],
            F.max(col(c)).cast("double").alias("max")) for c in numbers])
        parts.append(values.agg(rows.alias("rows")).select(F.inline("rows")))
    if texts:
        per_value = (df.unpivot([], [col(c) for c in texts], "column", "value")
                     .groupBy("column", "value").agg(F.count("*").alias("n")))
        has_value = F.col("value").isNotNull()
        best = F.min(F.when(has_value, F.struct((-F.col("n")).alias("n"), F.col("value"))))
        empty = F.lit(None).cast("double")
        parts.append(per_value.groupBy("column").agg(
            F.coalesce(F.sum(F.when(has_value, F.col("n"))), F.lit(0)).alias("count"),
            F.count("value").alias("unique"), best.alias("best")).select(
            "column", "count", "unique", F.col("best.value").alias("top"),
            (-F.col("best.n")).alias("freq"),
            *[empty.alias(n) for n in ("mean", "std", "min", "q25", "q50", "q75", "max")]))
    if not parts:
        kinds = dict.fromkeys(("mean", "std", "min", "q25", "q50", "q75", "max"), "double")
        kinds = {"column": "string", "count": "long", "unique": "long", "top": "string", "freq": "long"} | kinds
        return df.sparkSession.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in kinds.items()))
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return (df.filter(col(column).isNotNull()).groupBy(col(column).alias("value"))
            .agg(F.count("*").alias("rows")))


def id_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if c.lower() in ID_NAMES), None)


def distinct_users(df: DataFrame, key: str | None = None, approximate: bool = False) -> DataFrame:
    """Number of distinct ids; null if the table has no id column."""
    key = key or id_column(df)
    if key is None:
        return df.agg(F.max(F.lit(None).cast("long")).alias("users"))
    c = col(key)
    return df.agg((F.approx_count_distinct(c) if approximate else F.count_distinct(c)).alias("users"))


def avg_days_per_user(df: DataFrame, key: str | None = None, time: str | None = None) -> DataFrame:
    """Mean over users of their distinct calendar days; rows without a (readable) time are ignored.

    Null if the table has no id or no time column.
    """
    key = key or id_column(df)
    time = time or first_column(df, "date", "time", "day")
    if key is None or time is None:
        return df.agg(F.max(F.lit(None).cast("double")).alias("avg_days"))
    is_text = isinstance(df.schema[time].dataType, T.StringType)
    day = F.to_date(parsed(col(time), EXPORT_FORMATS) if is_text else col(time))
    days = (df.select(col(key).alias("key"), day.alias("day"))
            .dropna().distinct())
    return (days.groupBy("key").agg(F.count("*").alias("days"))
            .agg(F.avg("days").alias("avg_days")))


def date_range(df: DataFrame, time: str) -> DataFrame:
    """First and last calendar day and the days between them."""
    return (df.agg(F.to_date(F.min(col(time))).alias("first_day"),
                   F.to_date(F.max(col(time))).alias("last_day"))
            .withColumn("span_days", F.datediff("last_day", "first_day").cast("long")))


def frequency_check(df: DataFrame, key: str, time: str, chunk: Column | None = None) -> DataFrame:
    """Median gap in hours between a user's consecutive rows and the share of one-hour gaps."""
    lagged = previous_value(df.select(col(key), col(time)), "__before", time, [time], [key], chunk)

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    # Written once: the quantile takes several passes.
    gaps = keep(lagged.select(((micros(col(time)) - micros(F.col("__before"))) / F.lit(3.6e9))
                              .alias("gap")).dropna())
    median = exact_quantiles(gaps, {"gap": [0.5]})["gap"][0]
    return gaps.agg(F.lit(median).cast("double").alias("median_gap_hours"),
                    (F.avg((F.col("gap") == 1.0).cast("double")) * 100).alias("one_hour_pct"))


def _row_statistics(df: DataFrame) -> DataFrame:
    """Rows, repeated rows and missing cells from one shuffle on whole rows."""
    copies = (df.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("__n"))
              .select("__n", (F.col("__n") * _missing(df)).alias("__missing")))
    zero = F.lit(0)
    return copies.agg(F.coalesce(F.sum("__n"), zero).alias("rows"),
                      F.coalesce(F.sum(F.col("__n") - 1), zero).alias("duplicates"),
                      F.coalesce(F.sum("__missing"), zero).alias("nulls"))


def cleaning_report(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows and nulls before and after cleaning, repeated rows before."""
    parts = []
    for name, df in raw.items():
        before = _row_statistics(df).select(
            F.lit(name).alias("table"), F.col("rows").alias("rows_before"),
            F.lit(0).cast("long").alias("rows_after"), "duplicates",
            F.col("nulls").alias("nulls_before"), F.lit(0).cast("long").alias("nulls_after"))
        after = clean[name].agg(
            F.count("*").alias("rows_after"),
            F.coalesce(F.sum(_missing(clean[name])), F.lit(0)).alias("nulls_after")).select(
            F.lit(name).alias("table"), F.lit(0).cast("long").alias("rows_before"), "rows_after",
            F.lit(0).cast("long").alias("duplicates"), F.lit(0).cast("long").alias("nulls_before"),
            "nulls_after")
        parts += [before, after]
    sums = ("rows_before", "rows_after", "duplicates", "nulls_before", "nulls_after")
    return (reduce(DataFrame.unionByName, parts).groupBy("table")
            .agg(*[F.sum(c).alias(c) for c in sums]))


def counted_distinct(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The different rows of ``df`` and, once they are written, ``rows``, ``duplicates`` and ``nulls`` of ``df``.

    The counts come with the write itself, behind its shuffle, so a lost executor does not count twice.
    """
    seen, zero = Observation(), F.lit(0)
    copies = df.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    out = copies.observe(seen, F.coalesce(F.sum("__n"), zero).alias("rows"),
                         F.coalesce(F.sum(F.col("__n") - 1), zero).alias("duplicates"),
                         F.coalesce(F.sum(F.col("__n") * _missing(df)), zero).alias("nulls"))
    return out.drop("__n"), seen


def counted_rows(df: DataFrame, filled: Sequence[str] = (), numbers: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """``df`` and, once it is written, its ``rows``, its ``nulls`` but for the columns ``filled``, and those
    of ``numbers`` one by one as ``gaps0``, ``gaps1``, ..."""
    seen, zero = Observation(), F.lit(0)
    missing = _missing(df.select(*[col(c) for c in df.columns if c not in filled]))
    return df.observe(seen, F.count("*").alias("rows"), F.coalesce(F.sum(missing), zero).alias("nulls"),
                      *[F.count_if(col(c).isNull()).alias(f"gaps{i}") for i, c in enumerate(numbers)]), seen


def cleaning_actions(raw: dict[str, DataFrame]) -> DataFrame:
    """Per table and column with nulls: how cleaning treats them."""
    action = {}
    for name, df in raw.items():
        numbers, texts = numeric_columns(df), text_columns(df)
        for c in df.columns:
            action[name, c] = (NUMBERS_FILLED if c in numbers else
                               TEXTS_FILLED if c in texts else TIMES_DROPPED)
    known = F.create_map(*[F.lit(x) for (t, c), a in action.items() for x in (f"{t}|{c}", a)])
    return (null_summary_all(raw).filter("nulls > 0")
            .withColumn("action", known[F.concat_ws("|", "table", "column")]))


def missing_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing cells before and after a treatment and how many were filled."""
    counted = [df.agg(F.coalesce(F.sum(_missing(df)), F.lit(0)).alias("missing"))
               .select(F.lit(step).alias("step"), "missing")
               for step, df in (("before", before), ("after", after))]
    return (counted[0].unionByName(counted[1])
            .agg(F.sum(F.when(F.col("step") == "before", F.col("missing"))).alias("missing_before"),
                 F.sum(F.when(F.col("step") == "after", F.col("missing"))).alias("missing_after"))
            .withColumn("fixed", F.col("missing_before") - F.col("missing_after")))


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def box_summary(df: DataFrame, column: str) -> DataFrame:
    """Minimum, quartiles, maximum and mean of one metric."""
    q1, q2, q3 = exact_quantiles(df, {column: [0.25, 0.5, 0.75]})[column]
    return df.agg(F.min(col(column)).cast("double").alias("min"),
                  F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
                  F.lit(q3).cast("double").alias("q3"),
                  F.max(col(column)).cast("double").alias("max"), F.avg(col(column)).alias("mean"))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Rows per equal-width bin; the maximum belongs to the last bin. Empty bins are left out."""
    v = col(column).cast("double")
    lo, hi = one_row(df.agg(F.min(v), F.max(v)))
    if lo is None or lo == hi:
        bin_no, width = F.lit(1).cast("long"), 0.0
    else:
        bin_no = F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
        width = (hi - lo) / bins
    return (df.filter(col(column).isNotNull()).groupBy(bin_no.cast("long").alias("bin"))
            .agg(F.count("*").alias("rows"))
            .withColumn("lower", F.lit(lo).cast("double") + (F.col("bin") - 1) * F.lit(width))
            .withColumn("upper", F.lit(lo).cast("double") + F.col("bin") * F.lit(width)))
