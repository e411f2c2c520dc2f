"""Resampling and imputation against the documented pandas calls, and the edge frames."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from daybeat.functions.ordered import record_block, time_block
from daybeat.operators import clean, detect, features, impute, outliers, profile, report, series
from daybeat.plans import pipelines

DAY = dt.datetime(2024, 3, 1)
D = [dt.date(2024, 3, d) for d in range(1, 32)]


def test_filled_minutes_match_pandas(spark):
    rnd, rows = random.Random(5), []
    for user in (1, 2, 3):
        t = DAY + dt.timedelta(hours=20 * user)
        for i in range(40):
            t += dt.timedelta(seconds=rnd.choice((5, 50, 700, 40_000)))
            rows.append((user, t, None if i in (0, 1, 39) or rnd.random() < 0.2 else rnd.uniform(50, 150)))
    rows.append((4, DAY, 70.0))
    got = series.resample_minute_filled(
        spark.createDataFrame(rows, "Id long, Time timestamp_ntz, Value double"))
    got = got.orderBy("Id", "Time").toPandas()
    pdf = pd.DataFrame(rows, columns=["Id", "Time", "Value"])
    parts = []
    for user, g in pdf.groupby("Id"):
        g = g.set_index("Time").sort_index()[["Value"]].resample("1min").mean().interpolate()
        parts.append(g.assign(Id=user).reset_index())
    want = pd.concat(parts, ignore_index=True)[["Id", "Time", "Value"]]
    # leading minutes without a value: pandas keeps them as missing rows, and so do we
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_filled_minutes_without_user_column(spark):
    rows = [(DAY, 10.0), (DAY + dt.timedelta(minutes=4), 18.0)]
    got = series.resample_minute_filled(spark.createDataFrame(rows, "Time timestamp_ntz, Value double"), None)
    assert [r.Value for r in got.orderBy("Time").collect()] == [10.0, 12.0, 14.0, 16.0, 18.0]


def test_clean_file_edges(spark):
    rows = [(1, "3/1/2024", 10, "a"), (1, "3/1/2024", 10, "a"), (1, "3/2/2024", None, None),
            (1, "3/3/2024", 30, "c"), (2, "3/1/2024", None, "d"), (2, "bad", 99, "e"),
            (None, "3/1/2024", None, "f")]
    raw = spark.createDataFrame(rows, "Id long, ActivityDate string, TotalSteps long, Device string")
    got = {(r.Id, r.ActivityDate.day): (r.TotalSteps, r.Device)
           for r in pipelines.clean_file(raw, "daily_activity").collect()}
    # user 2 has no value and the row without a user is no group: both take the column median
    assert got == {(1, 1): (10.0, "a"), (1, 2): (20.0, "Unknown"), (1, 3): (30.0, "c"),
                   (2, 1): (20.0, "d"), (None, 1): (20.0, "f")}


def test_fill_median_by_key_variants_agree(spark):
    rows = [(1, 1.0), (1, 4.0), (1, None), (2, None), (3, 2.0), (3, None), (3, 8.0), (3, 9.0)]
    df = spark.createDataFrame(rows, "Id long, v double")
    for few in (True, False):
        got = sorted(impute.fill_median_by_key(df, "Id", ["v"], few).collect(), key=str)
        assert sorted([(r.Id, r.v) for r in got], key=str) == sorted(
            [(1, 1.0), (1, 4.0), (1, 2.5), (2, None), (3, 2.0), (3, 8.0), (3, 8.0), (3, 9.0)], key=str)


def test_fill_median_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert impute.fill_median(df, ["a", "b"]).collect() == [(None, 1.0), (None, 1.0)]


def test_dates_day_first_and_carried(spark):
    df = spark.createDataFrame([(1, None), (2, "31/01/2024"), (3, "x"), (4, "02/03/2024"), (5, "2024-05-06")],
                               "n long, Date string")
    got = clean.normalise_dates(df, ["n"], chunk=record_block("n", 2)).orderBy("n").collect()
    assert [r.Date for r in got] == [None, dt.date(2024, 1, 31), dt.date(2024, 1, 31),
                                     dt.date(2024, 3, 2), dt.date(2024, 5, 6)]


def test_parse_timestamps_mixed_formats(spark):
    df = spark.createDataFrame([("4/12/2016 7:21:05 PM",), ("4/12/2016",), ("2016-04-12 08:00:00",), ("?",)], "t string")
    got = [r.t for r in clean.parse_timestamps(df, ["t"]).collect()]
    assert got == [dt.datetime(2016, 4, 12, 19, 21, 5), dt.datetime(2016, 4, 12),
                   dt.datetime(2016, 4, 12, 8), None]


def test_preprocess_single_switches(spark):
    df = spark.createDataFrame([(1, "01/02/2024", 1, None), (2, None, None, "x"), (3, "03/02/2024", 4, None)],
                               "n long, Date string, v long, w string")
    off = pipelines.preprocess_single(df, ["n"], dates=False, numbers=False, categories=False)
    assert sorted(off.collect()) == sorted(df.collect(), key=lambda r: r.n)
    on = pipelines.preprocess_single(df, ["n"]).orderBy("n").collect()
    assert [(r.Date.day, r.v, r.w) for r in on] == [(1, 1.0, "Unknown"), (1, 2.5, "x"), (3, 4.0, "Unknown")]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "Id long, v double")
    assert profile.profile_overview(df).collect() == [(0, 2, 0, 0.0)]


def test_constant_histogram_and_scaling(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id long, v double")
    assert profile.histogram(df, "v").collect() == [(1, 2, 5.0, 5.0)]
    for scaled in (features.standard_scale(df, ["v"]), features.minmax_scale(df, ["v"], 0.0)):
        assert [r.v for r in scaled.collect()] == [0.0, 0.0]


def test_iqr_rows_are_strictly_outside(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, 8, 11)], "v double")
    q1, q3 = np.quantile([1, 2, 3, 4, 5, 8, 11], [0.25, 0.75])
    limit = float(q3 + 1.5 * (q3 - q1))
    df = df.union(spark.createDataFrame([(limit,)], "v double"))
    bounds = outliers.iqr_bounds(df, ["v"]).first()
    assert outliers.iqr_outlier_rows(df, "v").count() == bounds.outliers


def test_stress_reasons(spark):
    df = spark.createDataFrame([(1, "9", 5, 70, 95, "Sad"), (2, "7", 8, 10, 60, "Calm"), (3, "n/a", 1, 99, 99, "Sad"),
                                (4, "6", 1, 99, 99, "Sad")],
                               "User_ID long, Stress_Level string, Hours_Slept long, Active_Minutes long, "
                               "`Heart_Rate (bpm)` long, Mood string")
    got = {r.User_ID: r[outliers.REASON] for r in outliers.high_stress_reasons(df).collect()}
    assert got == {1: "Low Sleep, High Workload, Elevated HR, Mood: Sad", 2: "Unknown Factor"}


def daily(spark, values, name):
    return spark.createDataFrame([(1, d, v) for d, v in zip(D, values)], f"Id long, Date date, {name} double")


def test_sleep_zero_is_no_data_not_an_anomaly(spark):
    got = detect.detect_sleep(daily(spark, [100.0, 0.0, 0.0, 0.0, 100.0], "TotalSleepMinutes"), sigma=4.0)
    rows = got.orderBy("Date").collect()
    assert [r.no_data for r in rows] == [False, True, True, True, False]
    assert [r.is_anomaly for r in rows] == [False] * 5
    assert rows[1].reason == "No device worn"
    assert "no_data" not in detect.detect_sleep_v4(daily(spark, [1.0], "TotalSleepMinutes")).columns


def test_limits_are_strict_and_texts_differ_by_form(spark):
    values = [500.0, 25000.0, 499.0, 25001.0, 600.0]
    plain = detect.detect_steps(daily(spark, values, "TotalSteps"), sigma=50).orderBy("Date").collect()
    assert [r.reason for r in plain] == ["", "", "Steps<500", "Steps>25000", ""]
    v4 = detect.detect_steps_v4(daily(spark, values, "TotalSteps"), sigma=50).orderBy("Date").collect()
    assert v4[3].reason == "Steps>25,000"


def test_single_day_and_flat_series(spark):
    one = detect.detect_steps(daily(spark, [1000.0], "TotalSteps")).first()
    assert (one.rolling_med, one.residual, one.resid_anomaly) == (1000.0, 0.0, False)
    flat = detect.detect_steps_v4(daily(spark, [1000.0] * 4, "TotalSteps")).collect()
    assert not any(r.resid_anom for r in flat)


def test_sigma_text_is_rounded_like_a_format_string(spark):
    got = detect.detect_steps(daily(spark, [1e3, 1e3, 9e3, 1e3, 1e3, 1e3, 1e3, 1e3, 1e3], "TotalSteps"), sigma=2.5)
    assert got.filter("is_anomaly").first().reason == "Residual±2σ"


def test_peak_day_tie_takes_the_earliest(spark):
    got = detect.detect_steps(daily(spark, [1e3, 1e3, 9e3, 1e3, 1e3, 9e3, 1e3, 1e3], "TotalSteps"), sigma=1.0)
    assert report.peak_anomaly_day(got).first().Date == D[2]


def test_recall_caps_days(spark):
    rows = [(1, d, 60.0, 8000.0, 400.0) for d in D[:4]]
    df = spark.createDataFrame(rows, "Id long, Date date, AvgHR double, TotalSteps double, TotalSleepMinutes double")
    got = {r.signal: r for r in detect.detector_recall(df).collect()}
    assert got["Heart Rate"].injected == 4 and got["Heart Rate"].accuracy == 100.0 and got["Overall"].passed


def test_impute_features(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, 1.0, None), (2, inf, inf), (3, -inf, None), (4, None, None), (5, 3.0, None)],
                               "id long, a double, b double")
    got = features.impute_features(df, ["a", "b"]).orderBy("id").collect()
    assert [r.a for r in got] == [1.0, 3.0, 1.0, 2.0, 3.0]
    assert [r.b for r in got] == [0.0] * 5


def test_master_daily_keeps_users_without_sensors(spark):
    activity = spark.createDataFrame([(1, D[0], 10.0), (1, D[1], 20.0), (2, D[0], 30.0)],
                                     "Id long, ActivityDate date, TotalSteps double")
    hr = spark.createDataFrame([(1, DAY, 60.0), (1, DAY + dt.timedelta(minutes=1), 80.0)],
                               "Id long, Time timestamp_ntz, Value double")
    sleep = spark.createDataFrame([(1, DAY, 1, 7)], "Id long, date timestamp_ntz, value long, logId long")
    got = pipelines.master_daily({"daily_activity": activity, "heartrate": hr, "minute_sleep": sleep}, True)
    rows = {(r.Id, r.Date): r for r in got.collect()}
    assert rows[1, D[0]].AvgHR == rows[1, D[1]].AvgHR == 70.0      # second day takes the user's median
    assert rows[2, D[0]].AvgHR is None and rows[2, D[0]].TotalSleepMinutes == 0.0
    assert rows[1, D[0]].DominantSleepStage == 1


def test_dominant_stage_tie_takes_the_smallest(spark):
    rows = [(1, DAY + dt.timedelta(minutes=i), v, 1) for i, v in enumerate((3, 2, 2, 3, 1))]
    df = spark.createDataFrame(rows, "Id long, date timestamp_ntz, value long, logId long")
    assert series.dominant_sleep_stage(df).first().DominantSleepStage == 2


def test_structural_outliers_needs_three_users(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 6.0, 2.0)], "Id long, TotalSteps double, Calories double")
    assert pipelines.structural_outliers(df).count() == 0


@pytest.mark.parametrize("unit", ["day", "month"])
def test_frequency_check(spark, unit):
    rows = [(u, DAY + dt.timedelta(hours=h)) for u in (1, 2) for h in (0, 1, 2, 26, 27)]
    df = spark.createDataFrame(rows, "Id long, ActivityHour timestamp_ntz")
    got = profile.frequency_check(df, "Id", "ActivityHour", time_block("ActivityHour", unit)).first()
    assert (got.median_gap_hours, got.one_hour_pct) == (1.0, 75.0)
