import numpy as np
import pytest
from pyspark.sql import functions as F

from daybeat.functions.quantiles import exact_quantiles, quantile_by_group
from daybeat.functions.quantiles import quantiles_in_brackets
import daybeat.functions.quantiles as quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def table(spark, kind: str):
    rnd = np.random.default_rng(7)
    values = {"uniform": rnd.uniform(0, 1, 20_000), "heavy ties": rnd.integers(0, 3, 20_000) * 1.0,
              "mixed": np.concatenate([np.full(9_000, 5.0), rnd.normal(5, 1e-3, 11_000)]),
              "two lumps": np.concatenate([np.zeros(9_990), np.ones(9_990), rnd.uniform(0, 1, 20)]),
              "tails": rnd.standard_cauchy(20_000)}[kind]
    return values, spark.createDataFrame([(float(v),) for v in values], "v double")


@pytest.mark.parametrize("kind", ["uniform", "heavy ties", "mixed", "two lumps", "tails"])
@pytest.mark.parametrize("buckets, few", [(2_048, 2_048), (7, 3)])
def test_whole_column(spark, monkeypatch, kind, buckets, few):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "FEW_ROWS", few)
    values, df = table(spark, kind)
    got = exact_quantiles(df, {"v": PROBS})["v"]
    np.testing.assert_allclose(got, np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(None, 4.0), (None, None)], "a double, b double")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.25, 0.5]}) == {"a": [None], "b": [4.0, 4.0]}


def test_extreme_numbers(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW_ROWS", 1)
    inf, nan = float("inf"), float("nan")
    values = [-inf, -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, inf, nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, {"v": [k / 8 for k in range(9)]})["v"] == values[:9]


@pytest.mark.parametrize("kind", ["uniform", "heavy ties", "mixed", "tails"])
@pytest.mark.parametrize("p", [0.25, 0.5])
def test_groups_of_all_sizes(spark, monkeypatch, kind, p):
    monkeypatch.setattr(quantiles, "GROUP_BUCKETS", 5)
    values, df = table(spark, kind)
    # one group holds most rows, others are tiny, one has no value
    group = [i % 300 if i % 3 == 0 and i < 3000 else 999 for i in range(len(values))]
    rows = spark.createDataFrame([(g, float(v)) for g, v in zip(group, values)] + [(1000, None)],
                                 "g long, v double")
    got = {r.g: r.q for r in quantile_by_group(rows, ["g"], {"q": F.col("v")}, p, accuracy=500).collect()}
    group = np.array(group)
    assert got.pop(1000) is None
    assert set(got) == set(group.tolist())
    for g, q in got.items():
        np.testing.assert_allclose(q, np.quantile(values[group == g], p), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("lo, hi", [(-1e9, -1e8), (1e8, 1e9), (0.5, 0.5), (3.0, -3.0), (-1e300, 1e300)])
@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_wrong_brackets_still_give_exact_quantiles(spark, lo, hi, p):
    rnd = np.random.default_rng(3)
    values = {1: rnd.normal(0, 1, 3001), 2: rnd.integers(0, 4, 500) * 1.0, 3: np.array([7.0]), 4: np.array([1.0, 2.0])}
    rows = [(g, float(v)) for g, own in values.items() for v in own] + [(5, None), (5, float("nan"))]
    df = spark.createDataFrame(rows, "g long, v double")
    brackets = spark.createDataFrame([(g, len(values.get(g, [])), lo, hi) for g in (1, 2, 3, 4, 5)],
                                     "g long, __n_q long, __lo_q double, __hi_q double")
    got = {r.g: r.q for r in quantiles_in_brackets(df, brackets, ["g"], {"q": F.col("v")}, p).collect()}
    assert got.pop(5) is None
    for g, q in got.items():
        np.testing.assert_allclose(q, np.quantile(values[g], p), rtol=1e-12, atol=1e-12)


def test_extreme_numbers_in_groups(spark):
    inf = float("inf")
    values = [-inf, -1.7e308, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, inf, inf]
    df = spark.createDataFrame([(k % 2, v) for v in values for k in (0, 1)], "g long, v double")
    for k in range(9):
        got = quantile_by_group(df, ["g"], {"q": F.col("v")}, k / 8).collect()
        assert [r.q for r in got] == [values[k]] * 2
