"""Dashboard tables and exports built from a master table and the three anomaly series."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col, half_even
from .detect import HR_LIMITS, SLEEP_LIMITS, STEPS_LIMITS

# Texts of the anomaly report.
METHOD = "Threshold + Residual±2σ"
PROFILE_METRICS = ("TotalSteps", "Calories", "VeryActiveMinutes", "SedentaryMinutes",
                   "TotalSleepMinutes")


@dataclass(frozen=True)
class Anomalies:
    """The three detector results that the reports combine."""

    hr: DataFrame
    steps: DataFrame
    sleep: DataFrame

    def parts(self) -> list[tuple[str, str, DataFrame]]:
        return [("Heart Rate", "AvgHR", self.hr), ("Steps", "TotalSteps", self.steps),
                ("Sleep", "TotalSleepMinutes", self.sleep)]

    def flagged(self) -> DataFrame:
        """Flagged days of all signals under common names."""
        return reduce(DataFrame.unionByName, [
            df.filter("is_anomaly").select(
                F.lit(signal).alias("signal"), "Date", col(value).alias("value"),
                col("rolling_med").alias("expected"), "residual", "reason")
            for signal, value, df in self.parts()])


def filter_dates(df: DataFrame, first: str | None = None, last: str | None = None,
                 date: str = "Date") -> DataFrame:
    """Inclusive date range; an open end means the whole range."""
    if first is not None:
        df = df.filter(col(date) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.filter(col(date) <= F.lit(last).cast("date"))
    return df


def filter_user(df: DataFrame, user: int | None, key: str = "Id") -> DataFrame:
    """One user of the master table; ``None`` means all."""
    return df if user is None else df.filter(col(key) == F.lit(user))


def anomaly_counts(anomalies: Anomalies) -> DataFrame:
    """Per signal: flags, days, flags in percent of the days, and flags of all signals."""
    rows = reduce(DataFrame.unionByName, [
        df.agg(F.count_if("is_anomaly").alias("flags"), F.count("*").alias("days"))
        .select(F.lit(signal).alias("signal"), "flags", "days")
        for signal, _, df in anomalies.parts()])
    return rows.withColumns({
        "pct_of_days": col("flags") / F.greatest(col("days"), F.lit(1)) * 100,
        "total_flags": F.sum("flags").over(Window.partitionBy())})


def anomaly_report(anomalies: Anomalies, hr: tuple = HR_LIMITS, steps: tuple = STEPS_LIMITS,
                   sleep: tuple = SLEEP_LIMITS) -> DataFrame:
    """One row per flagged (date, metric) with limits, reason and severity, sorted by date."""
    texts = [("Heart Rate (bpm)", "bpm", *hr), ("Daily Steps", "steps", *steps),
             ("Sleep (min)", "min", *sleep)]
    rows = []
    for (metric, unit, lo, hi), (_, value, df) in zip(texts, anomalies.parts()):
        v = col(value)
        high = v > F.lit(hi * 1.1)
        if lo > 0:
            high = high | (v < F.lit(lo * 0.9))
        rows.append(df.filter("is_anomaly").select(
            col("Date").cast("date").cast("string").alias("Date"), F.lit(metric).alias("Metric"),
            half_even(v, 1).alias("Value"), F.lit(unit).alias("Unit"), F.lit(METHOD).alias("Method"),
            F.lit(f"{lo}–{hi} {unit}").alias("Threshold"), col("reason").alias("Anomaly Reason"),
            F.when(high, "High").otherwise("Medium").alias("Severity")))
    return reduce(DataFrame.unionByName, rows).orderBy("Date", "Metric")


def peak_anomaly_day(anomalies: DataFrame) -> DataFrame:
    """The flagged day with the largest deviation, the earliest on a tie."""
    return (anomalies.filter("is_anomaly").orderBy(F.abs("residual").desc(), "Date").limit(1)
            .select("Date", "residual"))


def kpi_strip(master: DataFrame, anomalies: Anomalies) -> DataFrame:
    """One row: flags in total and per signal, users, days, day of the peak heart-rate anomaly."""
    none = F.lit(None)
    parts = [df.agg(F.count_if("is_anomaly").alias("n")).select(
        F.lit(signal).alias("name"), "n", none.cast("date").alias("day"))
        for signal, _, df in anomalies.parts()]
    counts = master.agg(F.count_distinct("Id").alias("users"), F.count_distinct("Date").alias("days"))
    parts.append(counts.select(F.lit("users").alias("name"), col("users").alias("n"),
                               none.cast("date").alias("day")))
    parts.append(counts.select(F.lit("days").alias("name"), col("days").alias("n"),
                               none.cast("date").alias("day")))
    parts.append(peak_anomaly_day(anomalies.hr).select(
        F.lit("peak").alias("name"), none.cast("long").alias("n"), col("Date").alias("day")))
    rows = reduce(DataFrame.unionByName, parts)

    def number(name: str):
        return F.sum(F.when(col("name") == name, col("n")))

    return rows.agg(
        (number("Heart Rate") + number("Steps") + number("Sleep")).alias("total_flags"),
        number("Heart Rate").alias("hr_flags"), number("Steps").alias("steps_flags"),
        number("Sleep").alias("sleep_flags"), number("users").alias("users"),
        number("days").alias("days"),
        F.coalesce(F.date_format(F.max("day"), "dd MMM"), F.lit("—")).alias("peak_hr_day"))


def anomaly_timeline(anomalies: Anomalies) -> DataFrame:
    """Flagged days of all signals: Date, signal, reason, value."""
    return anomalies.flagged().select("Date", "signal", "reason", "value")


def recent_anomalies(anomalies: Anomalies, n: int = 15) -> DataFrame:
    """The newest ``n`` events."""
    return (anomalies.flagged().select("Date", "signal", "reason")
            .orderBy(col("Date").desc(), "signal").limit(n))


def _rate():
    return F.try_divide(F.count_if("is_anomaly"), F.count("*")) * 100


def hr_stats(hr: DataFrame) -> DataFrame:
    """Mean, maximum, minimum, anomaly days, days and rate of the heart-rate series."""
    return hr.agg(F.avg("AvgHR").alias("mean"), F.max("AvgHR").alias("max"),
                  F.min("AvgHR").alias("min"), F.count_if("is_anomaly").alias("anomaly_days"),
                  F.count("*").alias("total_days"), _rate().alias("rate"))


def days_below(df: DataFrame, value: str, limit: float) -> DataFrame:
    """Days under a fixed limit."""
    return df.agg(F.count_if(col(value) < F.lit(limit)).alias("days_below"))


def steps_stats(steps: DataFrame, limit: float = 500) -> DataFrame:
    """Same for steps, plus days under ``limit``."""
    v = col("TotalSteps")
    return steps.agg(F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"),
                     F.count_if("is_anomaly").alias("anomaly_days"),
                     F.count("*").alias("total_days"), _rate().alias("rate"),
                     F.count_if(v < F.lit(limit)).alias("days_below"))


def sleep_stats(sleep: DataFrame, lo: float = SLEEP_LIMITS[0]) -> DataFrame:
    """Same for sleep; the minimum ignores days without sleep (0 if there are none)."""
    v = col("TotalSleepMinutes")
    return sleep.agg(F.avg(v).alias("mean"), F.max(v).alias("max"),
                     F.coalesce(F.min(F.when(v > 0, v)), F.lit(0.0)).alias("min"),
                     F.count_if("is_anomaly").alias("anomaly_days"),
                     F.count("*").alias("total_days"), _rate().alias("rate"),
                     F.count_if(v < F.lit(lo)).alias("days_below"))


def anomaly_records(anomalies: DataFrame, value: str) -> DataFrame:
    """Flagged rows of one signal: Date, value, Expected, Deviation, Reason, rounded to 2."""
    return anomalies.filter("is_anomaly").select(
        "Date", half_even(col(value), 2).alias(value),
        half_even(col("rolling_med"), 2).alias("Expected"),
        half_even(col("residual"), 2).alias("Deviation"), col("reason").alias("Reason"))


def records_top25(anomalies: DataFrame, value: str, n: int = 25, width: int = 55) -> DataFrame:
    """First ``n`` flagged rows as report text and how many more there are."""
    records = anomaly_records(anomalies, value)
    counted = records.withColumn("more_records", F.greatest(
        F.count("*").over(Window.partitionBy()) - n, F.lit(0)))

    def shown(name: str):
        return half_even(col(name), 1)

    return (counted.orderBy("Date").limit(n).select(
        "Date", shown(value).alias(value), shown("Expected").alias("Expected"),
        shown("Deviation").alias("Deviation"),
        F.substring("Reason", 1, width).alias("Reason"), "more_records"))


def anomaly_export(anomalies: Anomalies) -> DataFrame:
    """All flagged rows: signal, Date, value, expected, residual, reason; rounded and sorted."""
    return anomalies.flagged().select(
        "signal", "Date", *[half_even(col(c), 2).alias(c) for c in ("value", "expected", "residual")],
        "reason").orderBy("signal", "Date")


def user_activity_profile(master: DataFrame, key: str = "Id") -> DataFrame:
    """Mean of five metrics per user, rounded to 0, under the last six characters of the id."""
    present = [c for c in PROFILE_METRICS if c in master.columns]
    return (master.filter(col(key).isNotNull()).groupBy(col(key))
            .agg(*[half_even(F.avg(col(c)), 0).alias(c) for c in present])
            .withColumn(key, F.right(col(key).cast("string"), F.lit(6))))


def dataset_overview(master: DataFrame) -> DataFrame:
    """Users, days, first and last date."""
    def text(c):
        return F.date_format(c, "dd MMM yyyy")

    return master.agg(F.count_distinct("Id").alias("users"), F.count_distinct("Date").alias("days"),
                      text(F.min("Date")).alias("first_date"), text(F.max("Date")).alias("last_date"))
