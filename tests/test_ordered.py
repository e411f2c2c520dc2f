"""Ordered fills against pandas, with chunks small enough to need every carry."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybeat.functions import ordered
from daybeat.functions.ordered import (RANGES, carry_forward, in_ranges, interpolate, previous_value, record_block,
                                       row_positions, time_block)


def series_frame(seed: int, users: int = 5, rows: int = 60) -> pd.DataFrame:
    rnd = random.Random(seed)
    data = []
    for user in range(users):
        share = (0.0, 1.0, 0.3, 0.7, 0.9)[user % 5]
        for _ in range(rows):
            data.append((user, len(data), None if rnd.random() < share else round(rnd.uniform(0, 99), 2)))
    return pd.DataFrame(data, columns=["Id", "row", "v"])


def as_spark(spark, pdf):
    return spark.createDataFrame([tuple(None if pd.isna(x) else x for x in r)
                                  for r in pdf.itertuples(index=False)], "Id long, row long, v double")


@pytest.mark.parametrize("size", [None, 1, 7, 1000])
def test_interpolate_by_key_matches_pandas(spark, size):
    pdf = series_frame(1)
    chunk = record_block("row", size) if size else None
    got = interpolate(as_spark(spark, pdf), ["v"], ["row"], ["Id"], chunk).orderBy("row").toPandas()
    want = pdf.groupby("Id")["v"].transform(lambda x: x.interpolate(method="linear").ffill().bfill())
    pd.testing.assert_series_equal(got["v"], want, check_names=False)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_interpolate_whole_table_matches_pandas(spark, size):
    pdf = series_frame(2)
    got = interpolate(as_spark(spark, pdf), ["v"], ["row"], (), record_block("row", size))
    want = pdf["v"].interpolate().ffill().bfill()
    pd.testing.assert_series_equal(got.orderBy("row").toPandas()["v"], want, check_names=False)


def test_non_null_cells_and_rows_without_key_stay(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (None, 3, None), (None, 4, 2.0)],
                               "Id long, row long, v double")
    got = {r.row: r.v for r in interpolate(df, ["v"], ["row"], ["Id"], record_block("row", 1)).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: None, 4: 2.0}


@pytest.mark.parametrize("size", [1, 4, 100])
def test_carry_forward(spark, size):
    pdf = series_frame(3)
    got = carry_forward(as_spark(spark, pdf), ["v"], ["row"], chunk=record_block("row", size))
    pd.testing.assert_series_equal(got.orderBy("row").toPandas()["v"], pdf["v"].ffill(), check_names=False)


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_previous_value_across_chunks(spark, unit):
    start = dt.datetime(2024, 1, 1)
    rows = [(u, start + dt.timedelta(hours=h * (u + 1))) for u in range(3) for h in range(40)]
    df = spark.createDataFrame(rows, "Id long, t timestamp_ntz")
    chunk = time_block("t", unit) if unit != "hour" else F.date_trunc("hour", "t")
    got = previous_value(df, "before", "t", ["t"], ["Id"], chunk).orderBy("Id", "t").toPandas()
    want = got.groupby("Id")["t"].shift(1)
    pd.testing.assert_series_equal(got["before"], want, check_names=False)


def test_row_positions_over_chunks(spark):
    df = spark.range(100).withColumn("id", F.col("id") * 37)
    got = row_positions(df, ["id"], chunk=record_block("id", 500)).orderBy("id").toPandas()
    assert got["__pos"].tolist() == list(range(1, 101))


@pytest.mark.parametrize("scan", [256, 2])
@pytest.mark.parametrize("keys", [(), ("Id",)])
def test_ranges_in_several_levels_match_pandas(spark, monkeypatch, scan, keys):
    """Sixteen ranges in blocks of two make four levels of summaries."""
    monkeypatch.setattr(ordered, "SCAN", scan)
    pdf = series_frame(7, rows=90)
    pdf["row"] = [int(1.03 ** (k % 450)) * 1000 + k for k in range(len(pdf))]      # crowded, then sparse
    pdf = pdf.sort_values("row", ignore_index=True)
    pdf.loc[3:80, "v"] = None
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = as_spark(spark, pdf)
        got = interpolate(df, ["v"], ["row"], keys, RANGES).orderBy("row").toPandas()
        carried = carry_forward(df, ["v"], ["row"], keys, RANGES).orderBy("row").toPandas()
        numbered = row_positions(df, ["row"], keys, RANGES).orderBy("row").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by = pdf.groupby("Id")["v"] if keys else None
    want = by.transform(lambda x: x.interpolate().ffill().bfill()) if keys else pdf["v"].interpolate().ffill().bfill()
    pd.testing.assert_series_equal(got["v"], want, check_names=False)
    pd.testing.assert_series_equal(carried["v"], by.ffill() if keys else pdf["v"].ffill(), check_names=False)
    place = pdf.groupby("Id").cumcount() + 1 if keys else pd.Series(range(1, len(pdf) + 1))
    assert numbered["__pos"].tolist() == place.tolist()


def test_ranges_are_even_whatever_the_numbers(spark):
    """Dense and sparse record numbers in one table; values far apart do not make small chunks."""
    rows = [(k,) for k in range(4000)] + [(10 ** 6 + 10 ** 5 * k,) for k in range(4000)]
    sizes = [r["count"] for r in in_ranges(spark.createDataFrame(rows, "row long").repartition(5), ["row"])
             .groupBy("__chunk").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2.5 * 8000 / len(sizes)


def test_no_window_spans_the_table(spark):
    df = spark.range(100).select(F.col("id").alias("row"), F.lit(1.0).alias("v"))
    plan = interpolate(df, ["v"], ["row"], (), RANGES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("[__" in line for line in plan.splitlines() if line.strip().startswith("+- Window"))


def test_rows_without_a_chunk_come_first_and_are_filled(spark):
    df = spark.createDataFrame([(None, 1, 3.0), (None, 2, None), (5, 3, None), (9, 4, 1.0)], "at int, row int, v double")
    got = {r.row: r.v for r in interpolate(df, ["v"], ["row"], (), F.col("at")).collect()}
    assert got == {1: 3.0, 2: pytest.approx(7 / 3), 3: pytest.approx(5 / 3), 4: 1.0}
