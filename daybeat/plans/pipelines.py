"""Composite queries: file cleaning, the two master tables, structural outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_date, col, half_even, numeric_columns, text_columns
from ..functions.ordered import RANGES, fill, time_block
from ..operators import clean, cluster, impute, profile, series
from ..operators.dbscan import dbscan
from ..operators.features import NOT_METRICS, standard_scale, user_features, user_features_fixed
from ..session import discard, keep, one_row
from ..sources.tables import TIMESTAMP_COLUMNS

# Rows of one user inside one block stay few: seconds per day, hours per month, days per year.
TIME_BLOCKS = {"heartrate": "day", "minute_sleep": "day", "hourly_intensities": "month",
               "hourly_steps": "month", "daily_activity": "year"}


def _with_gaps(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns that hold nulls; one scan that saves sorting complete columns."""
    if not cols:
        return []
    row = one_row(df.agg(*[F.count_if(col(c).isNull()) for c in cols]))
    return [c for c, n in zip(cols, row) if n]


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: col(c).cast("double") for c in cols})


def clean_file(df: DataFrame, role: str, key: str = "Id") -> DataFrame:
    """Drop repeated rows and rows without a time, fill numbers per user then by the column
    median, fill texts. Numbers become double; the user id is never filled."""
    numbers, texts = numeric_columns(df, (key,)), text_columns(df, (TIMESTAMP_COLUMNS[role],))
    return _filled(_timed(clean.drop_duplicates(df), role, numbers), role, key, _with_gaps(df, numbers), texts)


def clean_files(tables: dict[str, DataFrame], key: str = "Id") -> tuple[dict[str, DataFrame], DataFrame]:
    """``clean_file`` of every role's table, written, and their ``cleaning_report``.

    The report is counted while the tables are written: each raw table is read once, and a table without
    missing numbers is written once.
    """
    cleaned, rows = {}, []
    for role, df in tables.items():
        distinct, before = profile.counted_distinct(df)
        numbers, texts = numeric_columns(df, (key,)), text_columns(df, (TIMESTAMP_COLUMNS[role],))
        timed, after = profile.counted_rows(_timed(distinct, role, numbers), texts, numbers)
        timed = keep(timed)
        gaps = [c for i, c in enumerate(numbers) if after.get[f"gaps{i}"]]
        if gaps:
            filled, after = profile.counted_rows(_filled(timed, role, key, gaps, texts))
            cleaned[role] = keep(filled)
            discard(timed)
        else:
            cleaned[role] = _filled(timed, role, key, gaps, texts)
        rows.append((role, before.get["rows"], after.get["rows"], before.get["duplicates"], before.get["nulls"], after.get["nulls"]))
    spark = next(iter(tables.values())).sparkSession
    return cleaned, spark.createDataFrame(
        rows, "table string, rows_before long, rows_after long, duplicates long, nulls_before long, nulls_after long")


def _timed(distinct: DataFrame, role: str, numbers: Sequence[str]) -> DataFrame:
    """Rows with a time, their numbers as double."""
    time = TIMESTAMP_COLUMNS[role]
    return _as_double(clean.drop_invalid_timestamps(clean.parse_timestamps(distinct, [time]), time), numbers)


def _filled(out: DataFrame, role: str, key: str, gaps: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """``out`` with the gaps of numbers and texts filled."""
    time = TIMESTAMP_COLUMNS[role]
    if gaps:
        if key in out.columns:
            order = [time] + [c for c in out.columns if c not in (time, key)]
            out = impute.interpolate_by_key(out, key, order, gaps, time_block(time, TIME_BLOCKS[role]))
        out = impute.fill_median(out, gaps)
    return clean.fill_unknown(out, [c for c in out.columns if c not in texts])


def preprocess_single(df: DataFrame, order: Sequence[str], chunk: Column | str = RANGES,
                      dates: bool = True, numbers: bool = True,
                      categories: bool = True) -> DataFrame:
    """Single-file cleaner with three switches, over the whole table in row order.

    ``chunk`` defaults to even ranges of the order.
    """
    filled_dates, filled_numbers = [], []
    if dates:
        filled_dates = clean.date_like_columns(df)
        df = clean.parse_dates(df, filled_dates)
    if numbers:
        numeric = numeric_columns(df, tuple(order))
        filled_numbers = _with_gaps(df, numeric)
        df = _as_double(df, numeric)
    df = fill(df, filled_numbers, filled_dates, order, chunk=chunk)
    return clean.fill_unknown(df) if categories else df


def preprocess_keyed(df: DataFrame, order: Sequence[str], key: str = "User_ID",
                     chunk: Column | str = RANGES) -> tuple[DataFrame, list[str]]:
    """Single-file cleaner per user with its log: UTC dates, numbers per user, workout names."""
    logs = []
    if "Date" in df.columns:
        df = clean.normalise_utc(df)
        logs.append("Date: day-first text to UTC instants")
    numeric = numeric_columns(df, (key, *order))
    if key in df.columns:
        gaps = _with_gaps(df, numeric)
        df = impute.interpolate_by_key(_as_double(df, numeric), key, order, gaps, chunk)
        logs.append(f"{', '.join(gaps) or 'no column'}: gaps filled per {key}")
    if "Workout_Type" in df.columns:
        df = clean.fill_constant(df, {"Workout_Type": clean.NO_WORKOUT})
        logs.append(f"Workout_Type: missing names become {clean.NO_WORKOUT}")
    return df, logs


def _joined(master: DataFrame, part: DataFrame, suffix: str) -> DataFrame:
    """Left join on the shared (Id, date) columns; clashing names of the right side get a suffix."""
    on = [c for c in ("Id", "date_only") if c in part.columns]
    renamed = {c: c + suffix for c in part.columns if c not in on and c in master.columns}
    return master.join(part.withColumnsRenamed(renamed), on, "left")


def master_imputed(tables: dict[str, DataFrame], key: str = "Id") -> DataFrame:
    """Daily activity with daily heart rate, intensity, step and sleep sums; gaps filled per user,
    then by column median. Sleep here is the sum of stage codes."""
    daily = tables["daily_activity"].withColumn("date_only", as_date(col("ActivityDate")))
    master = daily
    parts = (("heartrate", series.daily_hr_mean_raw, "_hr"),
             ("hourly_intensities", series.daily_intensity_sum, "_hint"),
             ("hourly_steps", series.daily_steps_sum, "_hst"),
             ("minute_sleep", series.daily_sleep_sum, "_sleep"))
    for role, roll_up, suffix in parts:
        if role in tables:
            part = roll_up(tables[role]).withColumnRenamed("Date", "date_only")
            master = _joined(master, part, suffix)
    master = keep(_as_double(clean.drop_duplicates(master), numeric_columns(master, (key,))))
    gaps = _with_gaps(master, numeric_columns(master, (key,)))
    if gaps:
        order = ["ActivityDate"] + [c for c in daily.columns
                                    if c not in ("ActivityDate", "date_only", key)]
        # written once: the medians read it, and then everything that works on the master
        filled = keep(impute.interpolate_by_key(master, key, order, gaps,
                                                time_block("ActivityDate", "year")))
        discard(master)
        master = impute.fill_median(filled, gaps)
    return clean.fill_unknown(master)


HR_COLUMNS = ("AvgHR", "MaxHR", "MinHR", "StdHR")


def master_daily(tables: dict[str, DataFrame], sleep_stage: bool = False) -> DataFrame:
    """Daily activity with heart-rate statistics and sleep minutes per (Id, Date).

    Missing heart rates take the user's median, missing sleep is 0. Both roll-ups aggregate the
    sensor rows before the join, which then works on user-days only.
    """
    master = tables["daily_activity"].withColumnRenamed("ActivityDate", "Date").withColumn(
        "Date", as_date(col("Date")))
    if "heartrate" in tables:
        minutes = series.resample_minute(tables["heartrate"])
        master = master.join(series.daily_hr_stats(minutes), ["Id", "Date"], "left")
        # one value per user and day at most, whatever the sensor volume
        master = impute.fill_median_by_key(master, "Id", HR_COLUMNS, few_values=True)
    if "minute_sleep" in tables:
        master = master.join(series.daily_sleep_count(tables["minute_sleep"]), ["Id", "Date"], "left")
        master = clean.fill_constant(master.withColumn(
            "TotalSleepMinutes", col("TotalSleepMinutes").cast("double")), {"TotalSleepMinutes": 0.0})
        if sleep_stage:
            stages = series.dominant_sleep_stage(tables["minute_sleep"])
            master = clean.fill_constant(master.join(stages, ["Id", "Date"], "left"),
                                         {"DominantSleepStage": 0})
    return master


def cluster_users(master: DataFrame, key: str = "Id", k: int = 3, restarts: int = 1, eps: float = 2.2,
                  min_samples: int = 2) -> DataFrame:
    """Every user's mean of all numeric metrics of the master, with KMeans_Cluster and DBSCAN_Cluster.

    Both groupings see the scaled means; gaps have the median over users by then.
    """
    means = keep(user_features(master, key))
    metrics = numeric_columns(means, NOT_METRICS + (key,))
    scaled = keep(standard_scale(means, metrics))
    by_means = cluster.kmeans(scaled, key, metrics, k, restarts).withColumnRenamed("cluster", "KMeans_Cluster")
    by_density = dbscan(scaled, key, metrics, eps, min_samples).withColumnRenamed("cluster", "DBSCAN_Cluster")
    return means.join(by_means, key, "left").join(by_density, key, "left")


def structural_outliers(master: DataFrame, eps: float = 2.2, min_samples: int = 2,
                        key: str = "Id") -> DataFrame:
    """Users that fit no cluster with their mean metrics; needs at least three users."""
    features = keep(user_features_fixed(master, key))
    metrics = [c for c in features.columns if c != key]
    shown = features.select(col(key), *[half_even(col(c), 2).alias(c) for c in metrics])
    if features.count() < 3:
        return shown.filter(F.lit(False))
    labels = dbscan(standard_scale(features, metrics), key, metrics, eps, min_samples)
    return shown.join(labels.filter(col("cluster") == -1).select(col(key)), key, "left_semi")
