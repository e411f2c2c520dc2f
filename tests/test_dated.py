"""Tables kept by day: pruned reads, replaced days, and rows without a day."""

import datetime as dt

import pytest

from daybeat.session import shared_folder
from daybeat.sources import dated

START = dt.date(2024, 1, 1)
SCHEMA = "Id long, Date date, steps double"


def _rows(spark, rows):
    return spark.createDataFrame([(i, None if d is None else START + dt.timedelta(days=d), s) for i, d, s in rows], SCHEMA)


def _read(spark, path, **options):
    days = dated.read_days(spark, path, **options).collect()
    return sorted(((r.Id, None if r.Date is None else (r.Date - START).days, r.steps) for r in days), key=str)


@pytest.fixture()
def path(spark):
    out = f"{shared_folder(spark)}/days"
    rows = [(i, d, i * 10.0 + d) for i in range(50) for d in range(6)] + [(7, None, 1.0)]
    dated.write_days(_rows(spark, rows), out)
    return out


def _files(spark, path, day):
    return sorted(f for f in dated.read_days(spark, path).inputFiles() if f"Date={START + dt.timedelta(days=day)}" in f)


def test_replaced_days_hold_the_new_rows_only(spark, path):
    before = {d: _files(spark, path, d) for d in range(6)}
    dated.replace_days(_rows(spark, [(1, 2, 5.0), (2, 9, 6.0)]), path)
    rows = _read(spark, path)
    assert [r for r in rows if r[1] in (2, 9)] == [(1, 2, 5.0), (2, 9, 6.0)]
    assert len(rows) == 5 * 50 + 2 + 1 and (7, None, 1.0) in rows
    assert all(_files(spark, path, d) == before[d] for d in range(6) if d != 2)
    dated.replace_days(_rows(spark, [(1, 2, 5.0), (2, 9, 6.0)]), path)
    assert _read(spark, path) == rows
    dated.replace_days(_rows(spark, [(8, None, 2.0)]), path)
    assert [r for r in _read(spark, path) if r[1] is None] == [(8, None, 2.0)]
    dated.replace_days(_rows(spark, []), path)
    assert len(_read(spark, path)) == len(rows)


def test_only_the_asked_days_are_read(spark, path):
    schema = _rows(spark, []).schema
    df = dated.read_days(spark, path, schema, "2024-01-02", "2024-01-03")
    assert df.columns == ["Id", "Date", "steps"] and df.count() == 100
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Date" in filters and ">=" in filters and "<=" in filters
    df.foreach(lambda row: None)
    read = df._jdf.queryExecution().toRdd().partitions()
    assert {f.filePath().toString().split("Date=")[1][:10] for p in read for f in list(p.files())} == {"2024-01-02", "2024-01-03"}


def test_days_from_times_and_empty_tables(spark):
    out = f"{shared_folder(spark)}/times"
    dated.write_days(spark.sql("SELECT 1L AS Id, timestamp_ntz'2024-01-05 23:59:59' AS Date, 2.0D AS steps"), out)
    assert _read(spark, out) == [(1, 4, 2.0)]
    assert _read(spark, out, last="2024-01-04") == []
    none = f"{shared_folder(spark)}/none"
    dated.write_days(_rows(spark, []), none)
    assert _read(spark, none, schema=_rows(spark, []).schema) == []


def test_one_day_with_most_rows_is_spread(spark):
    out = f"{shared_folder(spark)}/hot"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        rows = spark.range(0, 400_000, 1, 8).selectExpr("id AS Id", "date_add(date'2024-01-01', int(if(id % 3 = 0, id % 10, 0))) AS Date",
                                                        "rand(3) AS steps")
        dated.write_days(rows, out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert dated.read_days(spark, out).count() == 400_000 and len(_files(spark, out, 0)) > 1
