"""Daily anomaly detection by limits and by deviation from a rolling median.

Detection runs on the daily series over all users: one row per calendar day whatever the size
of the input, so the windows here are deliberately unpartitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col, flag, half_even, joined_reasons
from .series import daily_cross_user_mean

# Default limits and, per signal, the extreme values of the recall test.
HR_LIMITS, STEPS_LIMITS, SLEEP_LIMITS = (50, 100), (500, 25000), (60, 600)
EXTREME_VALUES = {
    "Heart Rate": (115, 120, 125, 35, 40, 45, 118, 130, 38, 42),
    "Steps": (50, 100, 150, 30000, 35000, 28000, 80, 200, 31000, 29000),
    "Sleep": (10, 20, 30, 700, 750, 800, 15, 25, 710, 720),
}
TARGET = 90.0
NO_DATA = "No device worn"

def _whole_series():
    return Window.partitionBy()


def threshold_flags(df: DataFrame, value: str, lo: float, hi: float,
                    low_needs_positive: bool = False) -> DataFrame:
    """``thresh_high`` and ``thresh_low``, both strict; sleep counts as low only above 0."""
    low = col(value) < F.lit(lo)
    if low_needs_positive:
        low = (col(value) > 0) & low
    return df.withColumns({"thresh_high": flag(col(value) > F.lit(hi)), "thresh_low": flag(low)})


def rolling_median(df: DataFrame, value: str, order: str = "Date") -> DataFrame:
    """``rolling_med``: median of the previous, current and next row; two rows at the ends."""
    frame = Window.orderBy(col(order)).rowsBetween(-1, 1)
    return df.withColumn("rolling_med", F.percentile(col(value), F.lit(0.5)).over(frame))


def residual(df: DataFrame, value: str) -> DataFrame:
    """``residual``: value minus rolling median."""
    return df.withColumn("residual", col(value) - F.col("rolling_med"))


def _spread(fallback: bool) -> Column:
    std = F.stddev_samp("residual").over(_whole_series())
    return F.when(std > 0, std).otherwise(F.lit(1.0)) if fallback else std


def residual_flags(df: DataFrame, sigma: float = 2.0, fallback: bool = False,
                   name: str = "resid_anomaly") -> DataFrame:
    """|residual| above sigma deviations of the series; ``fallback`` uses 1.0 for no deviation."""
    return df.withColumn(name, flag(F.abs("residual") > F.lit(float(sigma)) * _spread(fallback)))


def expected_band(df: DataFrame, sigma: float = 2.0) -> DataFrame:
    """``lower`` and ``upper``: rolling median -+ sigma deviations of the residual."""
    width = F.lit(float(sigma)) * _spread(False)
    return df.withColumns({"lower": F.col("rolling_med") - width,
                           "upper": F.col("rolling_med") + width})


def alert_intervals(anomalies: DataFrame) -> DataFrame:
    """Each flagged day as [start, end)."""
    return anomalies.filter("is_anomaly").select(
        F.col("Date").alias("start"), F.date_add("Date", 1).alias("end"))


def _scored(daily: DataFrame, value: str, lo, hi, sigma: float, v4: bool, sleep: bool) -> DataFrame:
    name = "resid_anom" if v4 else "resid_anomaly"
    df = residual(rolling_median(threshold_flags(daily, value, lo, hi, sleep), value), value)
    df = residual_flags(df, sigma, fallback=v4, name=name)
    return df.withColumn("is_anomaly", col("thresh_high") | col("thresh_low") | col(name))


def _sigma_text(sigma: float, v4: bool) -> str:
    return f"+/-{sigma:.0f}sigma residual" if v4 else f"Residual±{sigma:.0f}σ"


def _detect_hr(master: DataFrame, needed: list[str], lo, hi, sigma: float, v4: bool) -> DataFrame:
    daily = daily_cross_user_mean(master.dropna(subset=needed), "AvgHR")
    scored = _scored(daily, "AvgHR", lo, hi, sigma, v4, False)
    return scored.withColumn("reason", joined_reasons(
        (col("thresh_high"), f"HR>{hi}"), (col("thresh_low"), f"HR<{lo}"),
        (col("resid_anom" if v4 else "resid_anomaly"), _sigma_text(sigma, v4))))


def detect_hr(master: DataFrame, lo: float = HR_LIMITS[0], hi: float = HR_LIMITS[1],
              sigma: float = 2.0) -> DataFrame:
    """Flags and reason per day of the mean heart rate over users."""
    return _detect_hr(master, ["Id", "Date", "AvgHR", "MaxHR", "MinHR"], lo, hi, sigma, False)


def detect_hr_v4(master: DataFrame, lo: float = HR_LIMITS[0], hi: float = HR_LIMITS[1],
                 sigma: float = 2.0) -> DataFrame:
    """Dashboard form: needs the mean only, plain-text reasons, deviation never zero."""
    return _detect_hr(master, ["Id", "Date", "AvgHR"], lo, hi, sigma, True)


def detect_steps(master: DataFrame, lo: float = STEPS_LIMITS[0], hi: float = STEPS_LIMITS[1],
                 sigma: float = 2.0, v4: bool = False) -> DataFrame:
    """Flags and reason per day of the mean steps over users."""
    scored = _scored(daily_cross_user_mean(master, "TotalSteps"), "TotalSteps", lo, hi, sigma,
                     v4, False)
    low, high = (f"{int(lo):,}", f"{int(hi):,}") if v4 else (lo, hi)
    return scored.withColumn("reason", joined_reasons(
        (col("thresh_low"), f"Steps<{low}"), (col("thresh_high"), f"Steps>{high}"),
        (col("resid_anom" if v4 else "resid_anomaly"), _sigma_text(sigma, v4))))


def detect_steps_v4(master: DataFrame, lo: float = STEPS_LIMITS[0], hi: float = STEPS_LIMITS[1],
                    sigma: float = 2.0) -> DataFrame:
    """Dashboard form of ``detect_steps``."""
    return detect_steps(master, lo, hi, sigma, v4=True)


def detect_sleep(master: DataFrame, lo: float = SLEEP_LIMITS[0], hi: float = SLEEP_LIMITS[1],
                 sigma: float = 2.0, v4: bool = False) -> DataFrame:
    """Flags and reason per day of the mean sleep over users.

    A mean of exactly 0 is "no data": named in the reason, not an anomaly by itself.
    """
    scored = _scored(daily_cross_user_mean(master, "TotalSleepMinutes"), "TotalSleepMinutes",
                     lo, hi, sigma, v4, True)
    low, high = (int(lo), int(hi)) if v4 else (lo, hi)
    reasons = [(col("thresh_low"), f"Sleep<{low}min"), (col("thresh_high"), f"Sleep>{high}min"),
               (col("resid_anom" if v4 else "resid_anomaly"), _sigma_text(sigma, v4))]
    if not v4:
        scored = scored.withColumn("no_data", flag(col("TotalSleepMinutes") == 0))
        reasons.insert(0, (col("no_data"), NO_DATA))
    return scored.withColumn("reason", joined_reasons(*reasons))


def detect_sleep_v4(master: DataFrame, lo: float = SLEEP_LIMITS[0], hi: float = SLEEP_LIMITS[1],
                    sigma: float = 2.0) -> DataFrame:
    """Dashboard form of ``detect_sleep``, without the "no data" flag."""
    return detect_sleep(master, lo, hi, sigma, v4=True)


def detector_recall(master: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """Overwrite ``n`` days per signal with extreme values and report how many are flagged.

    Days are picked by the order of md5(seed|signal|date), so the choice is repeatable; ``n``
    is capped by the number of days.
    """
    columns = {"Heart Rate": "AvgHR", "Steps": "TotalSteps", "Sleep": "TotalSleepMinutes"}
    limits = {"Heart Rate": HR_LIMITS, "Steps": STEPS_LIMITS, "Sleep": SLEEP_LIMITS}
    daily = (master.dropna(subset=["Date", *columns.values()]).groupBy("Date")
             .agg(*[F.avg(c).alias(c) for c in columns.values()]))
    results = None
    for signal, value in columns.items():
        pick = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(signal), col("Date").cast("string")))
        rank = F.row_number().over(Window.orderBy(pick))
        pool = F.array(*[F.lit(float(v)) for v in EXTREME_VALUES[signal]])
        injected = (daily.select("Date", value, rank.alias("rank"))
                    .withColumn("injected", col("rank") <= n)
                    .withColumn(value, F.when(col("injected"), pool[
                        F.pmod(col("rank") - 1, F.size(pool))]).otherwise(col(value))))
        scored = _scored(injected, value, *limits[signal], 2.0, False, signal == "Sleep")
        found = (scored.filter("injected")
                 .agg(F.count("*").alias("injected"), F.count_if("is_anomaly").alias("detected"))
                 .select(F.lit(signal).alias("signal"), "injected", "detected"))
        results = found if results is None else results.unionByName(found)
    results = results.withColumn("accuracy", half_even(
        F.try_divide(col("detected"), col("injected")) * 100, 1))
    overall = results.agg(F.sum("injected").alias("injected"), F.sum("detected").alias("detected"),
                          half_even(F.avg("accuracy"), 1).alias("accuracy"))
    return (results.unionByName(overall.withColumn("signal", F.lit("Overall")))
            .withColumn("passed", flag(col("accuracy") >= TARGET)))
