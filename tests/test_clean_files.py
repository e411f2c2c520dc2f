"""Cleaning several files and its report in one go."""

from daybeat.catalog import roles
from daybeat.operators import profile
from daybeat.plans import pipelines
from daybeat.session import shared_folder

SF = "/root/testdata/sf0.001"


def test_report_and_tables_equal_the_plain_ones(spark):
    events = roles.table(spark, SF, "events")
    raw = {"daily_activity": roles.daily_activity_raw(events), "heartrate": roles.heartrate_with_gaps(events),
           "hourly_steps": roles.hourly_steps(events).limit(0)}
    cleaned, report = pipelines.clean_files(raw)
    plain = {role: pipelines.clean_file(df, role) for role, df in raw.items()}
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, profile.cleaning_report(raw, plain).collect()))
    for role, df in plain.items():
        assert cleaned[role].schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, cleaned[role].collect())) == sorted(map(str, df.collect()))


def test_raw_tables_are_read_once(spark):
    path, reads = f"{shared_folder(spark)}/raw", spark.sparkContext.accumulator(0)
    spark.createDataFrame([(1, "1/2/2024", 5.0), (1, "1/2/2024", 5.0), (2, "bad", None), (2, "1/3/2024", None)],
                          "Id long, ActivityDate string, TotalSteps double").write.parquet(path)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    raw = spark.read.parquet(path)
    raw = raw.mapInArrow(counted, raw.schema)
    cleaned, report = pipelines.clean_files({"daily_activity": raw})
    assert [tuple(r) for r in report.collect()] == [("daily_activity", 4, 2, 1, 2, 0)]
    assert cleaned["daily_activity"].count() == 2 and reads.value == 4


def test_a_table_without_missing_numbers_is_written_once(spark, monkeypatch):
    kept, keep = [], pipelines.keep
    monkeypatch.setattr(pipelines, "keep", lambda df: kept.append(1) or keep(df))
    raw = spark.createDataFrame([(1, "1/2/2024", 5.0, None), (1, "1/2/2024", 5.0, None), (2, "bad", 1.0, "x")],
                                "Id long, ActivityDate string, TotalSteps double, Device string")
    cleaned, report = pipelines.clean_files({"daily_activity": raw})
    assert [tuple(r) for r in report.collect()] == [("daily_activity", 3, 1, 1, 2, 0)]
    assert [r.Device for r in cleaned["daily_activity"].collect()] == ["Unknown"] and len(kept) == 1


def test_tasks_that_expand_sleep_follow_its_minutes(spark, monkeypatch):
    monkeypatch.setattr(roles, "TASK_MINUTES", 1000, raising=False)
    events = spark.range(900).selectExpr("id AS event_id", "id % 7 AS user_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts",
                                         "'signup' AS event_type", "1.0D AS value")
    sleep = roles.minute_sleep(events)
    minutes = sum(1 + 10 * (1 + i % 30) for i in range(900))
    assert sleep.count() == minutes and sleep.rdd.getNumPartitions() >= minutes / 1000


def test_exports_are_written_compressed(spark, monkeypatch):
    from daybeat.catalog import queries
    paths, load = [], queries.io.load_roles
    monkeypatch.setattr(queries.io, "load_roles", lambda spark, p, *by: paths.extend(p) or load(spark, p, *by))
    assert queries.QUERIES["load_roles"](spark, SF).count() == 10
    files = [f for p in set(paths) if p.endswith(".csv") for f in spark.read.text(p).inputFiles()]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_a_day_is_worked_out_once_per_row(spark):
    """No filter in front of the sums repeats the parsing of the time; rows without user or time are ignored."""
    from daybeat.operators import clean, series
    raw = spark.createDataFrame([(1, "1/2/2024 1:00:00 AM", 2), (1, "bad", 2), (None, "1/2/2024", 1), (2, "1/2/2024", None)],
                                "Id long, date string, value long")
    days = series.daily_sleep_count(clean.parse_timestamps(raw, ["date"]))
    assert sorted((r.Id, str(r.Date), r.TotalSleepMinutes) for r in days.collect()) == [(1, "2024-01-02", 1), (2, "2024-01-02", 0)]
    assert days._jdf.queryExecution().optimizedPlan().toString().count("h:mm:ss a") == 1
