"""Outliers and the two single-file analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, joined_reasons
from ..functions.quantiles import exact_quantiles

# Limits, moods and texts of the stress analysis.
STRESS_LEVEL, SLEEP_HOURS, ACTIVE_MINUTES, HEART_RATE = 7, 6, 60, 90
STRESSED_MOODS = ("Sad", "Anxious", "Stressed", "Angry")
LOW_SLEEP, HIGH_WORKLOAD, ELEVATED_HR, MOOD = "Low Sleep", "High Workload", "Elevated HR", "Mood: "
NO_REASON = "Unknown Factor"
REASON = "Reason for High Stress"


def _bounds(df: DataFrame, cols: Sequence[str], factor: float) -> dict[str, tuple]:
    bounds = {}
    for c, (q1, q3) in exact_quantiles(df, {c: [0.25, 0.75] for c in cols}).items():
        if q1 is not None:
            bounds[c] = (q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Per column: quartiles, range, bounds, number and percentage of values outside."""
    rows = []
    for c, (q1, q3, lower, upper) in _bounds(df, cols, factor).items():
        outside = F.count_if((col(c) < F.lit(lower)) | (col(c) > F.lit(upper)))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"),
            F.lit(q3 - q1).alias("iqr"), F.lit(lower).alias("lower"), F.lit(upper).alias("upper"),
            outside.alias("outliers"), (outside / F.count(col(c)) * 100).alias("outlier_pct")))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def iqr_outlier_rows(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Rows strictly outside the bounds; the bounds are literals, so the scan can skip by them."""
    bounds = _bounds(df, [column], factor).get(column)
    if bounds is None:
        return df.filter(F.lit(False))
    return df.filter((col(column) < F.lit(bounds[2])) | (col(column) > F.lit(bounds[3])))


def avg_by_two_groups(df: DataFrame, group: str = "Workout_Type", person: str = "Gender",
                      value: str = "Active_Minutes",
                      kept: Sequence[str] = ("Male", "Female")) -> DataFrame:
    """Mean value per group and trimmed, capitalised person attribute."""
    text = F.trim(col(person))
    capitalised = F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 20)))
    return (df.select(col(group), capitalised.alias(person), col(value))
            .filter(col(person).isin(*kept) & col(group).isNotNull())
            .groupBy(col(group), col(person)).agg(F.avg(col(value)).alias(value)))


def high_stress_reasons(df: DataFrame) -> DataFrame:
    """Rows at stress level 7 or above with the likely reasons as text."""
    stress = next((c for c in df.columns if "Stress" in c or "stress" in c), None)
    if stress is None:
        raise ValueError("no stress column")
    reasons = []
    if "Hours_Slept" in df.columns:
        reasons.append((col("Hours_Slept") < SLEEP_HOURS, LOW_SLEEP))
    if "Active_Minutes" in df.columns:
        reasons.append((col("Active_Minutes") > ACTIVE_MINUTES, HIGH_WORKLOAD))
    if "Heart_Rate (bpm)" in df.columns:
        reasons.append((col("Heart_Rate (bpm)") > HEART_RATE, ELEVATED_HR))
    if "Mood" in df.columns:
        reasons.append((col("Mood").isin(*STRESSED_MOODS), F.concat(F.lit(MOOD), col("Mood"))))
    shown = [c for c in ("User_ID", "Full Name", "Gender", stress, "Hours_Slept", "Active_Minutes")
             if c in df.columns]
    return (df.filter(F.expr(f"try_cast(`{stress}` AS double)") >= STRESS_LEVEL)
            .select(*[col(c) for c in shown],
                    joined_reasons(*reasons, default=NO_REASON).alias(REASON)))
