"""Features of filled minutes from straight runs against the minutes written out."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybeat.operators import features, series


def readings(spark):
    rng, start = np.random.default_rng(4), dt.datetime(2024, 1, 1)
    rows = []
    for user, gap, values in ((1, 5, rng.normal(70, 9, 300)), (2, 60, rng.integers(60, 64, 80) * 1.0), (3, 1, [5.0] * 9),
                              (4, 700, rng.uniform(-5, 5, 40)), (5, 1, [7.0]), (6, 30, np.arange(50.0)), (7, 30, -np.arange(50.0))):
        rows += [(user, start + dt.timedelta(minutes=int(gap * k)), float(v)) for k, v in enumerate(values)]
    rows += [(8, start, None), (8, start + dt.timedelta(minutes=9), 3.0), (8, start + dt.timedelta(days=3), None), (9, start, None)]
    return spark.createDataFrame(rows, "Id long, Time timestamp_ntz, Value double")


@pytest.mark.parametrize("buckets, passes", [(64, 2), (2, 1), (3, 4)])
def test_features_equal_those_of_the_minutes(spark, monkeypatch, buckets, passes):
    monkeypatch.setattr(features, "BUCKETS", buckets)
    monkeypatch.setattr(features, "PASSES", passes)
    df = readings(spark)
    filled = series.resample_minute_filled(df).select(F.col("Id").alias("id"), F.col("Value").alias("value"))
    want = {r.id: r for r in features.ts_features(filled).collect()}
    runs = series.minute_segments(df).withColumnRenamed("Id", "id")
    got = {r.id: r for r in features.ts_features_of_segments(runs).collect()}
    assert set(got) == set(want) == set(range(1, 9))
    for user, r in want.items():
        np.testing.assert_allclose(list(got[user]), list(r), rtol=1e-9, atol=1e-6)


def test_daily_means_equal_those_of_the_minutes(spark):
    df = readings(spark)
    want = {r.Date: r.Value for r in series.daily_hr_two_step_mean(series.resample_minute_filled(df)).collect()}
    got = {r.Date: r.Value for r in series.daily_hr_two_step_mean_of_segments(series.minute_segments(df)).collect()}
    assert set(got) == set(want) and len(got) > 15
    for day in want:
        assert got[day] == pytest.approx(want[day], rel=1e-12)


def test_no_rows(spark):
    runs = series.minute_segments(readings(spark).limit(0)).withColumnRenamed("Id", "id")
    assert features.ts_features_of_segments(runs).count() == 0
