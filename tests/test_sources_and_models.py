import datetime as dt

import numpy as np
import pytest

from pyspark.errors import PySparkException

from daybeat.operators import clean, cluster, features, forecast, impute, profile
from daybeat.plans import pipelines
from daybeat.sources import tables as io


def test_role_by_name():
    assert io.role_by_name("/x/Daily-Activity merged.CSV") == "daily_activity"
    assert io.role_by_name("heart_rate_seconds.csv") == "heartrate"
    assert io.role_by_name("notes.csv") is None


def test_names_bind_first_file_and_skip_unreadable(spark, tmp_path):
    io.write_csv(spark.createDataFrame([(1, "4/1/2016 1:00:00 AM", 5)], "Id long, ActivityHour string, StepTotal long"),
                 f"{tmp_path}/hourlySteps_a.csv")
    io.write_csv(spark.range(3), f"{tmp_path}/hourlySteps_b.csv")
    paths = [f"{tmp_path}/hourlySteps_a.csv", f"{tmp_path}/hourlySteps_b.csv", f"{tmp_path}/minuteSleep.txt"]
    with pytest.warns(UserWarning, match="minuteSleep.txt"):
        bound = io.load_roles(spark, paths)
    assert list(bound) == ["hourly_steps"] and bound["hourly_steps"].count() == 1


def test_missing_paths_are_errors(spark, tmp_path):
    with pytest.raises(PySparkException):
        io.load_roles(spark, [f"{tmp_path}/minuteSleep.csv"])


def csv(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_missing_words_and_nan_are_null(spark, tmp_path):
    path = csv(tmp_path, "hourlySteps.csv", "Id,ActivityHour,StepTotal\n1,4/1/2016 1:00:00 AM,NA\n1,4/1/2016 2:00:00 AM,5\n"
               "2,null,NaN\n2,4/1/2016 3:00:00 AM,N/A\n")
    steps = io.load_roles(spark, [path])["hourly_steps"]
    assert dict(steps.dtypes) == {"Id": "bigint", "ActivityHour": "string", "StepTotal": "double"}
    assert sorted(steps.collect(), key=str) == sorted([(1, "4/1/2016 1:00:00 AM", None), (1, "4/1/2016 2:00:00 AM", 5.0),
                                                       (2, None, None), (2, "4/1/2016 3:00:00 AM", None)], key=str)
    spark.createDataFrame([(float("nan"), "NA")], "v double, t string").write.parquet(f"{tmp_path}/n.parquet")
    assert io.read_table(spark, f"{tmp_path}/n.parquet").first() == (None, "NA")


def test_columns_without_a_known_type_get_the_narrowest(spark, tmp_path):
    path = csv(tmp_path, "t.csv", "a,b,c,d,e,f,g\n1,1.5,true,2024-01-02,2024-01-02 03:04:05,x,\nNA,2,False,None,,7,NA\n")
    df = io.read_table(spark, path)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "date", "timestamp_ntz", "string", "string"]
    assert df.filter("a is null").first()[1:] == (2.0, False, None, None, "7", None)


def test_binding_by_columns_reads_headers_alone(spark, tmp_path, monkeypatch):
    paths = [csv(tmp_path, "one.csv", "Id,Time,Value\n1,4/1/2016 1:00:00 AM,70\n"), csv(tmp_path, "two.csv", "x,y\n1,2\n")]
    monkeypatch.setattr(io, "_narrowest", lambda *a: pytest.fail("inference pass"))
    bound = io.load_roles(spark, paths, by="columns")
    assert list(bound) == ["heartrate"] and bound["heartrate"].first() == (1, "4/1/2016 1:00:00 AM", 70.0)


@pytest.mark.parametrize("text, want", [
    ("25/12/2023 10:30:00", "2023-12-25 10:30:00"), ("25.12.2023", "2023-12-25 00:00:00"), ("25/12/23", "2023-12-25 00:00:00"),
    ("3-4-2023 7:05", "2023-04-03 07:05:00"), ("2023-12-25", "2023-12-25 00:00:00"), ("soon", None), (None, None)])
def test_day_first_forms(spark, text, want):
    df = clean.normalise_utc(spark.createDataFrame([(text,)], "Date string"))
    assert df.selectExpr("date_format(Date, 'yyyy-MM-dd HH:mm:ss')").first()[0] == want


@pytest.mark.parametrize("text, want", [
    ("4/12/2016 13:05", "2016-04-12 13:05:00"), ("4/12/2016 1:05:09 PM", "2016-04-12 13:05:09"),
    ("4/12/2016 1:05 PM", "2016-04-12 13:05:00"), ("4/12/16", "2016-04-12 00:00:00"), ("13/13/2016", None)])
def test_month_first_forms(spark, text, want):
    df = clean.parse_timestamps(spark.createDataFrame([(text,)], "t string"), ["t"])
    assert df.selectExpr("date_format(t, 'yyyy-MM-dd HH:mm:ss')").first()[0] == want


def test_profiles_of_raw_tables(spark):
    raw = spark.createDataFrame([(1, "4/12/2016"), (1, "4/13/2016"), (1, "4/13/2016"), (2, "bad"), (2, "4/12/2016")],
                                "Id long, ActivityDate string")
    assert profile.avg_days_per_user(raw).first()[0] == 1.5
    assert profile.distinct_users(raw.drop("Id")).first()[0] is None
    assert profile.avg_days_per_user(raw.drop("Id")).first()[0] is None
    day = dt.datetime(2024, 1, 1)
    mixed = spark.createDataFrame([(day, True), (day + dt.timedelta(days=2), True), (None, False)], "t timestamp_ntz, b boolean")
    rows = {r.column: r for r in profile.describe_table(mixed).collect()}
    seconds = day.replace(tzinfo=dt.timezone.utc).timestamp()
    assert (rows["t"]["count"], rows["t"]["min"], rows["t"].q50, rows["t"]["max"]) == (
        2, seconds, seconds + 86400, seconds + 2 * 86400)
    assert (rows["b"]["count"], rows["b"].unique, rows["b"].top, rows["b"].freq) == (3, 2, "True", 2)
    assert profile.describe_table(spark.createDataFrame([([1],)], "a array<int>")).count() == 0


def test_known_schema_follows_the_header(spark, tmp_path):
    path = f"{tmp_path}/heartrate.csv"
    io.write_csv(spark.createDataFrame([(71.0, 9, "4/1/2016 1:00:00 AM")], "Value double, Id long, Time string"), path)
    row = io.load_roles(spark, [path])["heartrate"].first()
    assert (row.Id, row.Value, row.Time) == (9, 71.0, "4/1/2016 1:00:00 AM")


def test_column_signatures_respect_case(spark):
    heart = spark.createDataFrame([], "Id long, Time string, Value double")
    sleep = spark.createDataFrame([], "Id long, date string, value long, logId long")
    assert io.score_columns(heart.columns, "minute_sleep") == 0
    bound = io.roles_by_columns([heart, sleep])
    assert bound == {"heartrate": heart, "minute_sleep": sleep}


def test_other_suffix_raises(spark):
    with pytest.raises(ValueError):
        io.read_table(spark, "/tmp/x.xlsx")


def test_csv_and_partitioned_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2.5), (2, dt.date(2024, 1, 2), None)],
                               "Id long, Date date, v double")
    io.write_csv(df, f"{tmp_path}/t.csv")
    assert sorted(io.read_table(spark, f"{tmp_path}/t.csv", schema=df.schema).collect()) == sorted(df.collect())
    io.write_parquet(df, f"{tmp_path}/t.parquet", "Date")
    back = io.read_table(spark, f"{tmp_path}/t.parquet").select("Id", "Date", "v")
    assert sorted(back.collect()) == sorted(df.collect())
    plan = back.filter("Date = DATE'2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan


def blobs(spark, n=90):
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.normal(c, 0.3, (n // 3, 3)) for c in (-3, 0, 3)])
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "Id long, a double, b double, c double")


def test_kmeans_numbers_clusters_by_falling_mean(spark):
    x, df = blobs(spark)
    got = {r.Id: r.cluster for r in cluster.kmeans(df, "Id", ["a", "b", "c"], 3, restarts=2).collect()}
    assert [got[i] for i in (0, 40, 80)] == [2, 1, 0] and len(set(got.values())) == 3


def test_elbow_never_rises_and_matches_distances(spark):
    x, df = blobs(spark)
    rows = cluster.kmeans_elbow(df, ["a", "b", "c"], k_max=5, restarts=3).orderBy("k").collect()
    costs = [r.inertia for r in rows]
    assert [r.k for r in rows] == [2, 3, 4, 5] and costs == sorted(costs, reverse=True)
    parts = [x[i * 30:(i + 1) * 30] for i in range(3)]
    assert costs[1] == pytest.approx(sum(((p - p.mean(0)) ** 2).sum() for p in parts), rel=1e-6)


def test_all_models_are_fitted_in_shared_passes(spark):
    """Fitting many models together gives what each gives alone, and equal points leave empty clusters."""
    x, df = blobs(spark)
    points = cluster._points(df, ["a", "b", "c"], "Id")
    models, costs = cluster.fit_kmeans(points, 3, range(2, 5), restarts=3)
    assert set(models) == set(costs) == {(k, r) for k in (2, 3, 4) for r in (0, 1, 2)}
    for (k, r), centres in models.items():
        away = ((x[:, None, :] - np.array(centres)[None]) ** 2).sum(-1)
        assert costs[k, r] == pytest.approx(away.min(axis=1).sum())
        for i in set(away.argmin(axis=1)):      # a fixed point of the step
            np.testing.assert_allclose(centres[i], x[away.argmin(axis=1) == i].mean(axis=0))
    same = spark.createDataFrame([(i, 1.0) for i in range(9)], "Id long, a double")
    assert {r.cluster for r in cluster.kmeans(same, "Id", ["a"], 3).collect()} == {0}
    few = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, None)], "Id long, a double")
    assert {r.Id: r.cluster for r in cluster.kmeans(few, "Id", ["a"], 3).collect()} == {1: 1, 2: 0}
    assert cluster.kmeans(few.limit(0), "Id", ["a"], 3).count() == 0
    assert cluster.kmeans_elbow(few.limit(1), ["a"]).count() == 0


def test_pca_ratio_and_sign(spark):
    x, df = blobs(spark)
    x = x - x.mean(0)
    centred = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "Id long, a double, b double, c double")
    xy, ratio = cluster.pca_2d(centred, "Id", ["a", "b", "c"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    np.testing.assert_allclose(ratio, (values[::-1] / values.sum())[:2], rtol=1e-9)
    first = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
    got = np.array([r.PC1 for r in xy.orderBy("Id").collect()])
    np.testing.assert_allclose(got, x @ first, atol=1e-9)


def test_forecast_recovers_line_and_weekday(spark):
    start = dt.date(2024, 1, 1)
    rows = [("s", start + dt.timedelta(days=i), 10 + 2.0 * i + (5 if i % 7 == 6 else 0)) for i in range(70)]
    rows += [("short", start + dt.timedelta(days=i), 1.0) for i in range(9)]
    history = forecast.forecast_input(
        spark.createDataFrame(rows, "series string, ds date, y double"), "ds", "y")
    got = forecast.forecast_trend_weekly(history, horizon=14).orderBy("ds").collect()
    assert {r.series for r in got} == {"s"} and len(got) == 84
    for i, r in enumerate(got):
        assert r.yhat == pytest.approx(10 + 2.0 * i + (5 if i % 7 == 6 else 0), abs=0.6)
        assert r.yhat_lower <= r.yhat <= r.yhat_upper


def test_labels():
    assert cluster.shown_metrics(["x", "Calories", "TotalSteps"]) == ["TotalSteps", "Calories", "x"]


def test_medians_read_written_rows(spark, monkeypatch):
    """The joins of the master and the means of its users are worked out once, not again for their medians."""
    seen, fill = [], impute.fill_median

    def noted(df, cols):
        seen.append(hasattr(df, "kept_at"))
        return fill(df, cols)

    monkeypatch.setattr(impute, "fill_median", noted)
    monkeypatch.setattr(features, "fill_median", noted)
    day = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([(1, day, 10.0), (1, day + dt.timedelta(1), None), (2, day, None), (None, day, 4.0)],
                                  "Id long, ActivityDate date, TotalSteps double")
    master = pipelines.master_imputed({"daily_activity": daily})
    assert sorted((r.Id or 0, r.TotalSteps) for r in master.collect()) == [(0, 4.0), (1, 10.0), (1, 10.0), (2, 10.0)]
    assert {r.Id: r.TotalSteps for r in features.user_features(master).collect()} == {1: 10.0, 2: 10.0}
    assert seen == [True, True]
