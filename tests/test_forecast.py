"""Trends with bends: against numpy, against the straight line, and over awkward series."""

import datetime as dt

import numpy as np
import pytest

from daybeat.operators import forecast

START = dt.date(2024, 1, 1)


def _history(spark, series: dict):
    rows = [(name, START + dt.timedelta(days=int(t)), None if y is None else float(y))
            for name, values in series.items() for t, y in values]
    return spark.createDataFrame(rows, "series string, ds date, y double")


def _trend(df) -> dict:
    return {(r.series, (r.ds - START).days): r.trend for r in df.collect()}


def test_equals_least_squares_with_penalty(spark):
    rnd = np.random.default_rng(3)
    days = np.flatnonzero(rnd.random(120) < 0.8)
    days = days - days[0]
    y = rnd.normal(0, 3, len(days)) + 100 + np.where(days < 60, days * 2.0, 120 - days)
    bends, penalty = 5, 0.002
    got = _trend(forecast.forecast_components(_history(spark, {"a": list(zip(days, y))}), 10, bends, penalty))
    x = days / days[-1]
    places = forecast.bend_places(bends)

    def columns(x):
        return np.column_stack([np.ones_like(x), x, *[np.maximum(x - s, 0) for s in places]])

    a = columns(x)
    weights = np.diag([0.0, 1e-9] + [penalty] * bends) * len(days)
    c = np.linalg.solve(a.T @ a + weights, a.T @ y)
    for t in [*days, *range(days[-1] + 1, days[-1] + 11)]:
        assert got["a", int(t)] == pytest.approx(float((columns(np.array([t / days[-1]])) @ c)[0]), rel=1e-8)


def test_one_bend_is_fitted_better_than_by_the_line(spark):
    values = [(t, 50 + 3.0 * min(t, 48) - 2.0 * max(t - 48, 0)) for t in range(120)]
    history = _history(spark, {"bent": values, "straight": [(t, 7 + 0.5 * t) for t in range(120)]})
    line, bent = (_trend(forecast.forecast_components(history, 20, bends)) for bends in (0, 5))

    def error(trend, days):
        return np.mean([abs(trend["bent", t] - (50 + 3.0 * min(t, 48) - 2.0 * max(t - 48, 0))) for t in days])

    for days in (range(120), range(120, 140)):
        assert error(bent, days) < 0.2 * error(line, days)
    for t in range(140):            # nothing to bend
        assert bent["straight", t] == pytest.approx(7 + 0.5 * t, abs=1e-3)


def test_awkward_series(spark):
    history = _history(spark, {
        "one day": [(3, 5.0)], "constant": [(t, 2.0) for t in range(12)], "nulls": [(0, None), (1, None)],
        "gap": [(0, 1.0), (400, 401.0)], "null at end": [(0, 1.0), (1, 2.0), (2, 3.0), (3, None)]})
    got = forecast.forecast_trend_weekly(history, 2, bends=3).collect()
    assert len(got) == sum((1, 12, 2, 2, 4)) + 5 * 2
    values = {(r.series, (r.ds - START).days): r.yhat for r in got}
    assert values["one day", 3] == values["one day", 5] == pytest.approx(5.0)
    assert all(values["constant", t] == pytest.approx(2.0) for t in range(14))
    assert all(v is None for (name, _), v in values.items() if name == "nulls")
    assert values["gap", 0] == pytest.approx(1.0) and values["gap", 400] == pytest.approx(401.0)
    assert values["null at end", 3] == pytest.approx(4.0, abs=0.2)
    empty = forecast.forecast_trend_weekly(history.limit(0), bends=3)
    assert empty.columns == ["series", "ds", "yhat", "yhat_lower", "yhat_upper"] and empty.count() == 0


def test_thousands_of_series_share_one_shuffle(spark):
    history = spark.range(3000).selectExpr("cast(id as string) AS series", "explode(sequence(0, 29)) AS t").selectExpr(
        "series", "date_add(date'2024-01-01', t) AS ds", "t * 2.0D AS y")
    fitted = forecast.forecast_components(history, 5, bends=2)
    plan = fitted._jdf.queryExecution().executedPlan().toString()
    # The ends of the series and its days; the weekday windows need another.
    assert plan.count("Exchange hashpartitioning(series") <= 4
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert fitted.filter("abs(trend - 2 * datediff(ds, date'2024-01-01')) > 0.001").count() == 0
