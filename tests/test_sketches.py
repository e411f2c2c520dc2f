"""Quantiles from kept sketches: their rank error, ranges of days, and rows without values."""

import datetime as dt

import numpy as np
import pytest

from daybeat.functions.sketches import DISTINCT_ERROR, RANK_ERROR, daily_distinct, daily_sketches, distinct_between, sketch_quantiles

START = dt.date(2024, 1, 1)


@pytest.mark.parametrize("kind", ["normal", "ties", "one day holds most"])
def test_rank_error_of_any_range_of_days(spark, kind):
    rnd = np.random.default_rng(4)
    values = rnd.integers(0, 5, 20_000) * 1.0 if kind == "ties" else rnd.normal(0, 1, 20_000)
    days = np.where(rnd.random(20_000) < 0.8, 3, rnd.integers(0, 10, 20_000)) if kind.startswith("one") else rnd.integers(0, 10, 20_000)
    df = spark.createDataFrame([(START + dt.timedelta(days=int(d)), float(v), None) for d, v in zip(days, values)],
                               "day date, v double, w double")
    kept = daily_sketches(df, "day", ["v", "w"])
    for first, last in ((0, 9), (2, 5), (7, 7)):
        own = values[(days >= first) & (days <= last)]
        rows = sketch_quantiles(kept, ["v", "w"], (0.0, 0.25, 0.5, 0.9, 1.0), str(START + dt.timedelta(days=first)),
                                str(START + dt.timedelta(days=last))).collect()
        for r in rows:
            if r.column == "w":
                assert r.rows == 0 and r.quantile is None
            else:
                assert r.rows == len(own)
                assert (own < r.quantile).mean() - RANK_ERROR <= r.p <= (own <= r.quantile).mean() + RANK_ERROR


def test_no_days(spark):
    df = spark.createDataFrame([(None, 1.0)], "day date, v double")
    assert [(r.rows, r.quantile) for r in sketch_quantiles(daily_sketches(df, "day", ["v"]), ["v"], (0.5,)).collect()] == [(0, None)]


def test_distinct_values_of_any_range_of_days(spark):
    rnd = np.random.default_rng(5)
    ids, days = rnd.integers(0, 30_000, 100_000), rnd.integers(0, 10, 100_000)
    df = spark.createDataFrame([(START + dt.timedelta(days=int(d)), int(i), str(i % 7), None) for d, i in zip(days, ids)]
                               + [(None, -1, "none", None)], "day date, id long, kind string, empty string")
    kept = daily_distinct(df, "day", ["id", "kind", "empty"])
    for first, last in ((0, 9), (2, 5), (7, 7)):
        own = ids[(days >= first) & (days <= last)]
        found = {r.column: r for r in distinct_between(kept, ["id", "kind", "empty"], str(START + dt.timedelta(days=first)),
                                                       str(START + dt.timedelta(days=last))).collect()}
        assert all(r.days == last - first + 1 for r in found.values())
        assert abs(found["id"].distinct - len(set(own))) <= DISTINCT_ERROR * len(set(own))
        assert found["kind"].distinct == 7 and found["empty"].distinct == 0
    none = distinct_between(kept, ["id"], "2030-01-01").collect()
    assert [(r.days, r.distinct) for r in none] == [(0, 0)]
