"""SQL for the registered queries, run by another engine over the same tables.

Named subqueries are written once in ``PARTS``; each statement pulls in those it mentions.
Numbers, days and times are shown the way ``queries.shown`` does.
"""

from __future__ import annotations

import re

from .queries import BENDS, CORRECTED_DAY, FIRST_DAY, HR, LAST_DAY, ONE_USER, SLEEP, STEPS, USER_BENDS
from ..operators.detect import EXTREME_VALUES
from ..operators.forecast import PENALTY, bend_places

PARTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

ACTIVITY = ("TotalSteps Calories VeryActiveMinutes FairlyActiveMinutes LightlyActiveMinutes "
            "SedentaryMinutes").split()


def _with(body: str) -> str:
    """Prefix the statement with every part it needs, in order of definition."""
    needed, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, sql in PARTS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(sql)
    if not needed:
        return body
    parts = ", ".join(f"{name} AS ({sql})" for name, sql in PARTS.items() if name in needed)
    return f"WITH RECURSIVE {parts} {body}"


def oracle(name: str, sql: str, numbers: str | list[str] = "", days: str = "", times: str = "",
           digits: int = 4) -> None:
    """Register ``sql``; the named columns are shown as numbers, days or times."""
    numbers = numbers.split() if isinstance(numbers, str) else numbers
    scale = f"{float(10 ** digits)!r}::DOUBLE"
    shown = [f'floor("{c}"::DOUBLE * {scale} + 0.5003::DOUBLE) / {scale} AS "{c}"'
             for c in numbers]
    shown += [f'CAST(CAST("{c}" AS DATE) AS VARCHAR) AS "{c}"' for c in days.split()]
    shown += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S') AS \"{c}\"" for c in times.split()]
    if shown:
        sql = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql})"
    ORACLES[name] = _with(sql)


def half_even(x: str, digits: int) -> str:
    """Round half to even on the value's first nine decimals, in whole numbers."""
    unit = 10 ** (9 - digits)
    i = f"CAST(round(abs({x}) * 1000000000.0::DOUBLE) AS HUGEINT)"
    up = f"(({i} % {unit}) * 2 > {unit} OR (({i} % {unit}) * 2 = {unit} AND ({i} // {unit}) % 2 = 1))"
    size = f"CAST({i} // {unit} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / {10 ** digits}.0::DOUBLE"
    return f"(CASE WHEN {x} < 0 THEN -({size}) ELSE {size} END)"


def filled(source: str, cols: list[str], order: str, keys: str, others: str) -> str:
    """Linear by row position, then last, then next value."""
    by = f"PARTITION BY {keys} ORDER BY {order}" if keys else f"ORDER BY {order}"
    back, ahead = ("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
                   "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
    near = ", ".join(
        f'last_value("{c}" IGNORE NULLS) OVER (w {back}) AS pv{i}, '
        f'last_value(CASE WHEN "{c}" IS NOT NULL THEN rn END IGNORE NULLS) OVER (w {back}) AS pr{i}, '
        f'first_value("{c}" IGNORE NULLS) OVER (w {ahead}) AS nv{i}, '
        f'first_value(CASE WHEN "{c}" IS NOT NULL THEN rn END IGNORE NULLS) OVER (w {ahead}) AS nr{i}'
        for i, c in enumerate(cols)).replace("OVER (w ROWS", f"OVER ({by} ROWS")
    value = ", ".join(
        f'COALESCE("{c}"::DOUBLE, pv{i} + (nv{i} - pv{i})::DOUBLE * (rn - pr{i}) / nullif(nr{i} - pr{i}, 0), '
        f'pv{i}::DOUBLE, nv{i}::DOUBLE) AS "{c}"' for i, c in enumerate(cols))
    return (f"SELECT {others}, {value} FROM (SELECT *, {near} FROM "
            f"(SELECT *, row_number() OVER ({by}) AS rn FROM {source}))")


# ---- the test tables as tracker tables ----------------------------------------------------

PARTS["hr"] = """SELECT user_id AS Id, ts + o.s * INTERVAL 1 SECOND AS Time,
  value + o.s * 0.1::DOUBLE AS Value FROM events, (VALUES (0), (20), (40)) o(s)"""
PARTS["hr_gaps"] = """SELECT user_id AS Id, ts + o.s * INTERVAL 1 SECOND AS Time,
  CASE WHEN event_id % 4 <> 0 THEN value + o.s * 0.1::DOUBLE END AS Value
  FROM events, (VALUES (0), (20), (40)) o(s)"""
PARTS["da"] = """SELECT user_id AS Id, CAST(ts AS DATE) AS ActivityDate,
  sum(CASE WHEN event_type = 'click' THEN 100 * value END) AS TotalSteps, sum(20 * value) AS Calories,
  sum(CASE WHEN event_type = 'view' THEN value END) AS VeryActiveMinutes,
  sum(CASE WHEN event_type = 'purchase' THEN value END) AS FairlyActiveMinutes,
  30 * count(*) AS LightlyActiveMinutes, 1440 - 30 * count(*) AS SedentaryMinutes
  FROM events GROUP BY 1, 2"""
PARTS["da_raw"] = """SELECT Id, CASE WHEN Id % 13 = 0 AND day(ActivityDate) = 15 THEN 'bad'
    ELSE strftime(ActivityDate, '%-m/%-d/%Y') END AS ActivityDate,
  TotalSteps, Calories, VeryActiveMinutes, FairlyActiveMinutes, LightlyActiveMinutes, SedentaryMinutes,
  CASE WHEN Id % 4 <> 0 THEN 'tracker-' || (Id % 3) END AS Device
  FROM da, (VALUES (1), (2)) c(n) WHERE n = 1 OR Id % 10 = 0"""
PARTS["hs"] = """SELECT user_id AS Id, date_trunc('hour', ts) AS ActivityHour, sum(100 * value) AS StepTotal
  FROM events WHERE event_type = 'click' GROUP BY 1, 2"""
PARTS["hi"] = """SELECT user_id AS Id, date_trunc('hour', ts) AS ActivityHour, sum(value) AS TotalIntensity,
  sum(value) / 60 AS AverageIntensity FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""
PARTS["ms"] = """SELECT user_id AS Id, ts + m * INTERVAL 1 MINUTE AS date, 1 + (event_id + m) % 3 AS value,
  event_id AS logId FROM (SELECT *, unnest(range(0, 10 * (1 + event_id % 30) + 1)) AS m
  FROM events WHERE event_type IN ('signup', 'error'))"""
PARTS["sf"] = """SELECT o_orderkey AS Record, o_custkey AS User_ID, 'User ' || o_custkey AS "Full Name",
  CASE o_orderkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN ' Female ' WHEN 2 THEN 'FEMALE' WHEN 4 THEN 'Other' END AS Gender,
  CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%d/%m/%Y') END AS Date,
  CASE o_orderkey % 4 WHEN 0 THEN 'Running' WHEN 1 THEN 'Yoga' WHEN 2 THEN 'Cycling' END AS Workout_Type,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 120 END AS Active_Minutes, 4 + o_orderkey % 6 AS Hours_Slept,
  55 + o_orderkey % 60 AS "Heart_Rate (bpm)",
  CASE o_orderkey % 6 WHEN 0 THEN 'Happy' WHEN 1 THEN 'Sad' WHEN 2 THEN 'Anxious' WHEN 3 THEN 'Calm' WHEN 4 THEN 'Angry' END AS Mood,
  CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(1 + o_orderkey % 10 AS VARCHAR) END AS Stress_Level
  FROM orders"""

# ---- scans --------------------------------------------------------------------------------

oracle("read_table", """SELECT fmt, count(*) AS "rows", count(DISTINCT Id) AS users, sum(TotalSteps) AS steps
  FROM da, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY fmt""", "steps")
oracle("load_roles", """SELECT bound_by, role, n AS "rows" FROM (
  SELECT 'daily_activity' AS role, count(*) AS n FROM da UNION ALL
  SELECT 'heartrate', count(*) FROM hr UNION ALL SELECT 'hourly_intensities', count(*) FROM hi UNION ALL
  SELECT 'hourly_steps', count(*) FROM hs UNION ALL SELECT 'minute_sleep', count(*) FROM ms),
  (VALUES ('name'), ('columns')) b(bound_by)""")

# ---- profiling ----------------------------------------------------------------------------

RAW_COLUMNS = ["Id", "ActivityDate", *ACTIVITY, "Device"]
SINGLE_COLUMNS = ["Record", "User_ID", "Full Name", "Gender", "Date", "Workout_Type", "Active_Minutes",
                  "Hours_Slept", "Heart_Rate (bpm)", "Mood", "Stress_Level"]


def _nulls(cols: list[str]) -> str:
    return " + ".join(f'("{c}" IS NULL)::BIGINT' for c in cols)


oracle("profile_overview", f"""SELECT count(*) AS "rows", {len(RAW_COLUMNS)}::BIGINT AS "columns",
  sum({_nulls(RAW_COLUMNS)})::BIGINT AS missing_cells,
  100 - sum({_nulls(RAW_COLUMNS)}) / (count(*) * {len(RAW_COLUMNS)})::DOUBLE * 100 AS completeness FROM da_raw""",
       "completeness")
_null_rows = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) - count("{c}") AS nulls FROM {src}"""
    for t, src, cols in (("daily_activity", "da_raw", RAW_COLUMNS), ("single_file", "sf", SINGLE_COLUMNS))
    for c in cols)
oracle("null_summary", _null_rows)
_numbers = ["Id", *ACTIVITY]
oracle("describe_table", " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", count("{c}") AS "count", NULL::BIGINT AS "unique", NULL::VARCHAR AS top,
     NULL::BIGINT AS freq, avg("{c}") AS mean, stddev_samp("{c}") AS std, min("{c}")::DOUBLE AS min,
     quantile_cont("{c}"::DOUBLE, 0.25) AS q25, quantile_cont("{c}"::DOUBLE, 0.5) AS q50,
     quantile_cont("{c}"::DOUBLE, 0.75) AS q75, max("{c}")::DOUBLE AS max FROM da_raw""" for c in _numbers]
    + [f"""SELECT '{c}', (SELECT count("{c}") FROM da_raw), (SELECT count(DISTINCT "{c}") FROM da_raw), v, n,
     NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT "{c}" AS v, count(*) AS n FROM da_raw
     WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)""" for c in ("ActivityDate", "Device")]),
       "mean std min q25 q50 q75 max", digits=2)
oracle("value_counts", 'SELECT value, count(*) AS "rows" FROM ms GROUP BY 1')
oracle("distinct_users", "SELECT count(DISTINCT User_ID) AS users FROM sf")
oracle("avg_days_per_user", """SELECT avg(n) AS avg_days FROM (
  SELECT Id, count(DISTINCT CAST(Time AS DATE)) AS n FROM hr GROUP BY 1)""", "avg_days")
oracle("date_range", """SELECT CAST(min(Time) AS DATE) AS first_day, CAST(max(Time) AS DATE) AS last_day,
  datediff('day', CAST(min(Time) AS DATE), CAST(max(Time) AS DATE)) AS span_days FROM hr""",
       days="first_day last_day")
oracle("frequency_check", """SELECT quantile_cont(gap, 0.5) AS median_gap_hours,
  avg((gap = 1.0)::INT) * 100 AS one_hour_pct FROM (SELECT epoch(ActivityHour - lag(ActivityHour)
  OVER (PARTITION BY Id ORDER BY ActivityHour)) / 3600.0::DOUBLE AS gap FROM hs) WHERE gap IS NOT NULL""",
       "median_gap_hours one_hour_pct")
PARTS["da_dated"] = """SELECT DISTINCT * REPLACE (CAST(try_strptime(ActivityDate, '%m/%d/%Y') AS TIMESTAMP) AS ActivityDate)
  FROM da_raw WHERE ActivityDate <> 'bad'"""
oracle("cleaning_report", f"""SELECT 'daily_activity' AS "table", count(*) AS rows_before,
  (SELECT count(*) FROM da_dated) AS rows_after,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM da_raw)) AS duplicates,
  sum({_nulls(RAW_COLUMNS)})::BIGINT AS nulls_before, 0::BIGINT AS nulls_after FROM da_raw""")
oracle("cleaning_report_files", " UNION ALL ".join(f"""SELECT '{role}' AS "table", count(*) AS rows_before,
  (SELECT count(*) FROM {after}) AS rows_after, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw})) AS duplicates,
  sum({_nulls(cols)})::BIGINT AS nulls_before, 0::BIGINT AS nulls_after FROM {raw}""" for role, raw, after, cols in (
    ("daily_activity", "da_raw", "da_dated", RAW_COLUMNS), ("heartrate", "hr_gaps", "(SELECT DISTINCT * FROM hr_gaps)", ["Id", "Time", "Value"]),
    ("hourly_steps", "hs", "hs", ["Id", "ActivityHour", "StepTotal"]),
    ("hourly_intensities", "hi", "hi", ["Id", "ActivityHour", "TotalIntensity", "AverageIntensity"]),
    ("minute_sleep", "ms", "(SELECT DISTINCT * FROM ms)", ["Id", "date", "value", "logId"]))))
oracle("cleaning_actions", f"""SELECT *, CASE WHEN "column" IN ({', '.join(repr(c) for c in
       _numbers + ['Record', 'User_ID', 'Active_Minutes', 'Hours_Slept', 'Heart_Rate (bpm)'])})
  THEN 'filled — interpolation' ELSE 'filled with ''Unknown''' END AS action FROM ({_null_rows}) WHERE nulls > 0""")
oracle("missing_before_after", f"""SELECT m AS missing_before, a AS missing_after, m - a AS fixed FROM (
  SELECT sum({_nulls(SINGLE_COLUMNS)})::BIGINT AS m,
  (SELECT count(*) FROM sf WHERE Record < (SELECT min(Record) FROM sf WHERE Date IS NOT NULL)) AS a FROM sf)""")
oracle("preview", "SELECT * FROM da ORDER BY Id, ActivityDate LIMIT 10",
       "TotalSteps Calories VeryActiveMinutes FairlyActiveMinutes", "ActivityDate")
oracle("box_summary", """SELECT min(Value) AS min, quantile_cont(Value, 0.25) AS q1, quantile_cont(Value, 0.5) AS median,
  quantile_cont(Value, 0.75) AS q3, max(Value) AS max, avg(Value) AS mean FROM hr""", "min q1 median q3 max mean")
oracle("histogram", """SELECT bin, n AS "rows", lo + (bin - 1) * ((hi - lo) / 40) AS lower,
  lo + bin * ((hi - lo) / 40) AS upper FROM (SELECT lo, hi,
  least(CAST(floor(40.0::DOUBLE * (Value - lo) / (hi - lo)) AS BIGINT) + 1, 40) AS bin, count(*) AS n
  FROM hr, (SELECT min(Value) AS lo, max(Value) AS hi FROM hr) GROUP BY ALL)""", "lower upper")

# ---- cleaning and imputation --------------------------------------------------------------

_moving = "TotalSteps Calories VeryActiveMinutes FairlyActiveMinutes"
oracle("drop_duplicates", "SELECT DISTINCT * FROM da_raw", _moving)
oracle("parse_timestamps", """SELECT Id, date_trunc('second', Time) AS Time FROM hr UNION ALL
  SELECT Id, CAST(try_strptime(ActivityDate, '%m/%d/%Y') AS TIMESTAMP) FROM da_raw""", times="Time")
oracle("drop_invalid_timestamps", """SELECT * REPLACE (CAST(strptime(ActivityDate, '%m/%d/%Y') AS TIMESTAMP) AS ActivityDate)
  FROM da_raw WHERE ActivityDate <> 'bad'""", _moving, times="ActivityDate")
oracle("normalise_utc", "SELECT Record, strptime(Date, '%d/%m/%Y') AS Date FROM sf", times="Date")
PARTS["sf_dates"] = """SELECT * REPLACE (last_value(CAST(strptime(Date, '%d/%m/%Y') AS DATE) IGNORE NULLS)
  OVER (ORDER BY Record ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Date) FROM sf"""
oracle("normalise_dates", "SELECT Record, Date FROM sf_dates", days="Date")
oracle("interpolate_by_key", filled("hr_gaps", ["Value"], "Time", "Id", "Id, Time"), "Value", times="Time")
oracle("interpolate_all", filled("sf", ["Active_Minutes"], "Record", "", "Record"), "Active_Minutes")


def _median_filled(cols: list[str]) -> str:
    return ", ".join(f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM da)) AS {c}" for c in cols)


oracle("fill_median", f"""SELECT Id, ActivityDate, {_median_filled(['TotalSteps', 'VeryActiveMinutes',
       'FairlyActiveMinutes'])} FROM da""", "TotalSteps VeryActiveMinutes FairlyActiveMinutes", "ActivityDate")
oracle("fill_median_by_key", """SELECT Id, ActivityDate,
  COALESCE(TotalSteps, quantile_cont(TotalSteps, 0.5) OVER (PARTITION BY Id)) AS TotalSteps,
  COALESCE(VeryActiveMinutes, quantile_cont(VeryActiveMinutes, 0.5) OVER (PARTITION BY Id)) AS VeryActiveMinutes
  FROM da""", "TotalSteps VeryActiveMinutes", "ActivityDate")
oracle("fill_unknown", """SELECT Record, COALESCE(Gender, 'Unknown') AS Gender,
  COALESCE(Workout_Type, 'Unknown') AS Workout_Type, COALESCE(Mood, 'Unknown') AS Mood, Date FROM sf""")
oracle("fill_constant", """SELECT Record, COALESCE(Workout_Type, 'No Workout') AS Workout_Type,
  COALESCE(Active_Minutes, 0) AS Active_Minutes FROM sf""")
oracle("drop_nulls", "SELECT * FROM da WHERE TotalSteps IS NOT NULL AND FairlyActiveMinutes IS NOT NULL",
       _moving, "ActivityDate")
PARTS["da_filled"] = filled("da_dated", ACTIVITY, "ActivityDate", "Id", "Id, ActivityDate, COALESCE(Device, 'Unknown') AS Device")
oracle("clean_file", "SELECT Id, ActivityDate, Device, " + ", ".join(
    f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM da_filled)) AS {c}" for c in ACTIVITY) + " FROM da_filled",
       " ".join(ACTIVITY), times="ActivityDate")
_single_numbers = ["User_ID", "Active_Minutes", "Hours_Slept", "Heart_Rate (bpm)"]
oracle("preprocess_single", filled(
    "sf_dates", _single_numbers, "Record", "",
    "Record, Date, Stress_Level, \"Full Name\", COALESCE(Gender, 'Unknown') AS Gender, "
    "COALESCE(Workout_Type, 'Unknown') AS Workout_Type, COALESCE(Mood, 'Unknown') AS Mood"), _single_numbers, days="Date")
oracle("preprocess_keyed", filled(
    "sf", _single_numbers[1:], "Record", "User_ID",
    "Record, User_ID, Gender, Mood, Stress_Level, \"Full Name\", strptime(Date, '%d/%m/%Y') AS Date, "
    "COALESCE(Workout_Type, 'No Workout') AS Workout_Type"), _single_numbers[1:], times="Date")

# ---- outliers and single-file analyses ----------------------------------------------------

PARTS["iqr"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3
    FROM da""" for c in ("TotalSteps", "Calories", "LightlyActiveMinutes"))
PARTS["iqr_long"] = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c}::DOUBLE AS v FROM da"""
                                       for c in ("TotalSteps", "Calories", "LightlyActiveMinutes"))
oracle("iqr_bounds", """SELECT "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) / count(v) * 100 AS outlier_pct
  FROM iqr JOIN iqr_long USING ("column") GROUP BY "column", q1, q3""", "q1 q3 iqr lower upper outlier_pct")
oracle("iqr_outlier_rows", """SELECT da.* FROM da, iqr WHERE "column" = 'TotalSteps'
  AND (TotalSteps < q1 - 1.5 * (q3 - q1) OR TotalSteps > q3 + 1.5 * (q3 - q1))""", _moving, "ActivityDate")
oracle("avg_by_two_groups", """SELECT Workout_Type, g AS Gender, avg(Active_Minutes) AS Active_Minutes FROM (
  SELECT *, upper(trim(Gender)[1]) || lower(trim(Gender)[2:]) AS g FROM sf)
  WHERE g IN ('Male', 'Female') AND Workout_Type IS NOT NULL GROUP BY 1, 2""", "Active_Minutes")
oracle("high_stress_reasons", """SELECT User_ID, "Full Name", Gender, Stress_Level, Hours_Slept, Active_Minutes,
  CASE WHEN r = '' THEN 'Unknown Factor' ELSE r END AS "Reason for High Stress" FROM (SELECT *, concat_ws(', ',
  CASE WHEN Hours_Slept < 6 THEN 'Low Sleep' END, CASE WHEN Active_Minutes > 60 THEN 'High Workload' END,
  CASE WHEN "Heart_Rate (bpm)" > 90 THEN 'Elevated HR' END,
  CASE WHEN Mood IN ('Sad', 'Anxious', 'Stressed', 'Angry') THEN 'Mood: ' || Mood END) AS r FROM sf)
  WHERE TRY_CAST(Stress_Level AS DOUBLE) >= 7""")

# ---- time series, roll-ups, master tables -------------------------------------------------

PARTS["hm"] = "SELECT Id, date_trunc('minute', Time) AS Time, avg(Value) AS HeartRate FROM hr GROUP BY 1, 2"
PARTS["hd"] = """SELECT Id, CAST(Time AS DATE) AS Date, avg(HeartRate) AS AvgHR, max(HeartRate) AS MaxHR,
  min(HeartRate) AS MinHR, stddev_samp(HeartRate) AS StdHR FROM hm GROUP BY 1, 2"""
PARTS["sleep_count"] = "SELECT Id, CAST(date AS DATE) AS Date, count(value) AS TotalSleepMinutes FROM ms GROUP BY 1, 2"
PARTS["stage"] = """SELECT Id, Date, value AS DominantSleepStage FROM (SELECT *, row_number() OVER (
  PARTITION BY Id, Date ORDER BY n DESC, value) AS r FROM (SELECT Id, CAST(date AS DATE) AS Date, value, count(*) AS n
  FROM ms GROUP BY 1, 2, 3)) WHERE r = 1"""


def _dense(source: str) -> str:
    """Every minute of a user from a calendar join, gaps filled by windows over it."""
    means = f"SELECT Id, date_trunc('minute', Time) AS m, avg(Value) AS v FROM {source} GROUP BY 1, 2"
    grid = (f"SELECT g.Id, g.m, s.v, epoch(g.m) AS e FROM (SELECT Id, unnest(generate_series(min(m), max(m), "
            f"INTERVAL 1 MINUTE)) AS m FROM ({means}) GROUP BY Id) g LEFT JOIN ({means}) s ON g.Id = s.Id AND g.m = s.m")
    back, ahead = ("OVER (PARTITION BY Id ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                   "OVER (PARTITION BY Id ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    return (f"SELECT Id, m AS Time, COALESCE(v, pv + (nv - pv) * (e - pe) / (ne - pe), pv) AS Value FROM (SELECT *, "
            f"last_value(v IGNORE NULLS) {back} AS pv, last_value(CASE WHEN v IS NOT NULL THEN e END IGNORE NULLS) {back} AS pe, "
            f"first_value(v IGNORE NULLS) {ahead} AS nv, "
            f"first_value(CASE WHEN v IS NOT NULL THEN e END IGNORE NULLS) {ahead} AS ne FROM ({grid}))")


PARTS["hr_dense"] = _dense("hr")
oracle("resample_minute", "SELECT * FROM hm", "HeartRate", times="Time")
oracle("resample_minute_filled", f"""SELECT Id, CAST(Time AS DATE) AS Date, count(*) AS minutes, count(Value) AS with_value,
  avg(Value) AS mean, max(Value) AS max, min(Value) AS min FROM ({_dense('hr_gaps')}) GROUP BY 1, 2""",
       "mean max min", "Date")
oracle("daily_hr_stats", "SELECT * FROM hd", "AvgHR MaxHR MinHR StdHR", "Date")
oracle("daily_hr_mean_raw", "SELECT Id, CAST(Time AS DATE) AS Date, avg(Value) AS AvgHeartRate FROM hr GROUP BY 1, 2",
       "AvgHeartRate", "Date")
oracle("daily_intensity_sum", """SELECT Id, CAST(ActivityHour AS DATE) AS Date, sum(TotalIntensity) AS TotalIntensity,
  sum(AverageIntensity) AS AverageIntensity FROM hi GROUP BY 1, 2""", "TotalIntensity AverageIntensity", "Date")
oracle("daily_steps_sum", "SELECT Id, CAST(ActivityHour AS DATE) AS Date, sum(StepTotal) AS StepTotal FROM hs GROUP BY 1, 2",
       "StepTotal", "Date")
oracle("daily_sleep_sum", """SELECT Id, CAST(date AS DATE) AS Date, sum(value)::BIGINT AS TotalSleepMinutes
  FROM ms GROUP BY 1, 2""", days="Date")
oracle("daily_sleep_count", "SELECT * FROM sleep_count", days="Date")
oracle("dominant_sleep_stage", "SELECT * FROM stage", days="Date")
oracle("elapsed_series", """SELECT Id AS id, CAST(floor(epoch_us(Time - min(Time) OVER (PARTITION BY Id)) / 1000000.0) AS BIGINT) AS time,
  Value AS value FROM hr""", "value")
_sums = ["AvgHeartRate", "TotalIntensity", "AverageIntensity", "StepTotal", "TotalSleepMinutes"]
PARTS["mi"] = """SELECT DISTINCT da.*, da.ActivityDate AS date_only, h.AvgHeartRate, i.TotalIntensity, i.AverageIntensity,
  s.StepTotal, z.TotalSleepMinutes FROM da
  LEFT JOIN (SELECT Id, CAST(Time AS DATE) AS d, avg(Value) AS AvgHeartRate FROM hr GROUP BY 1, 2) h ON da.Id = h.Id AND ActivityDate = h.d
  LEFT JOIN (SELECT Id, CAST(ActivityHour AS DATE) AS d, sum(TotalIntensity) AS TotalIntensity,
    sum(AverageIntensity) AS AverageIntensity FROM hi GROUP BY 1, 2) i ON da.Id = i.Id AND ActivityDate = i.d
  LEFT JOIN (SELECT Id, CAST(ActivityHour AS DATE) AS d, sum(StepTotal) AS StepTotal FROM hs GROUP BY 1, 2) s ON da.Id = s.Id AND ActivityDate = s.d
  LEFT JOIN (SELECT Id, CAST(date AS DATE) AS d, sum(value) AS TotalSleepMinutes FROM ms GROUP BY 1, 2) z ON da.Id = z.Id AND ActivityDate = z.d"""
PARTS["mi_filled"] = filled("mi", ACTIVITY + _sums, "ActivityDate", "Id", "Id, ActivityDate, date_only")
PARTS["mi_imputed"] = "SELECT Id, ActivityDate, date_only, " + ", ".join(
    f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM mi_filled)) AS {c}" for c in ACTIVITY + _sums) + " FROM mi_filled"
oracle("master_imputed", "SELECT * FROM mi_imputed",
       " ".join(ACTIVITY + _sums), "ActivityDate date_only")
_hr_cols = ["AvgHR", "MaxHR", "MinHR", "StdHR"]
PARTS["md"] = f"""SELECT da.Id, ActivityDate AS Date, {', '.join('da.' + c for c in ACTIVITY)}, {', '.join(
    f'COALESCE({c}, quantile_cont({c}, 0.5) OVER (PARTITION BY da.Id)) AS {c}' for c in _hr_cols)},
  COALESCE(z.TotalSleepMinutes, 0)::DOUBLE AS TotalSleepMinutes FROM da
  LEFT JOIN hd ON da.Id = hd.Id AND ActivityDate = hd.Date
  LEFT JOIN sleep_count z ON da.Id = z.Id AND ActivityDate = z.Date"""
oracle("master_daily", """SELECT md.*, COALESCE(DominantSleepStage, 0) AS DominantSleepStage FROM md
  LEFT JOIN stage ON md.Id = stage.Id AND md.Date = stage.Date""",
       _moving + " " + " ".join(_hr_cols) + " TotalSleepMinutes", "Date")
PARTS["steps_daily"] = "SELECT ActivityDate AS Date, avg(TotalSteps) AS TotalSteps FROM da WHERE TotalSteps IS NOT NULL GROUP BY 1"
oracle("daily_cross_user_mean", "SELECT Date AS ActivityDate, TotalSteps FROM steps_daily", "TotalSteps", "ActivityDate")
PARTS["hr_two_step"] = """SELECT Date, avg(v) AS Value FROM (SELECT Id, CAST(Time AS DATE) AS Date, avg(Value) AS v
  FROM hr_dense GROUP BY 1, 2) GROUP BY 1"""
oracle("daily_hr_two_step_mean", "SELECT * FROM hr_two_step", "Value", "Date")
PARTS["hr_pooled"] = "SELECT CAST(Time AS DATE) AS ds, avg(HeartRate) AS y FROM hm GROUP BY 1"
oracle("daily_hr_pooled_mean", "SELECT * FROM hr_pooled", "y", "ds")

# ---- features -----------------------------------------------------------------------------

FEATURES = ["sum_values", "median", "mean", "length", "standard_deviation", "variance", "root_mean_square",
            "maximum", "absolute_maximum", "minimum"]


def _features(source: str, value: str) -> str:
    v = value
    return f"""SELECT Id AS id, sum({v}) AS value__sum_values, quantile_cont({v}, 0.5) AS value__median, avg({v}) AS value__mean,
  count({v}) AS value__length, stddev_pop({v}) AS value__standard_deviation, var_pop({v}) AS value__variance,
  sqrt(avg({v} * {v})) AS value__root_mean_square, max({v}) AS value__maximum, max(abs({v})) AS value__absolute_maximum,
  min({v}) AS value__minimum FROM {source} WHERE {v} IS NOT NULL GROUP BY 1"""


PARTS["feats"] = _features("hm", "HeartRate")
_feature_numbers = " ".join(f"value__{f}" for f in FEATURES if f != "length")
oracle("ts_features", "SELECT * FROM feats", _feature_numbers, digits=3)
oracle("ts_features_filled", _features("hr_dense", "Value"), _feature_numbers, digits=6)
oracle("drop_empty_features", "SELECT * FROM feats", _feature_numbers, digits=3)
oracle("impute_features", """SELECT id, value__median, CASE id % 5 WHEN 0 THEN hi WHEN 1 THEN lo WHEN 2 THEN mid
  ELSE value__maximum END AS value__maximum FROM feats, (SELECT max(value__maximum) AS hi, min(value__maximum) AS lo,
  quantile_cont(value__maximum, 0.5) AS mid FROM feats WHERE id % 5 > 2)""", "value__median value__maximum", digits=3)
oracle("minmax_scale", "SELECT id, " + ", ".join(
    f"(value__{f} - min(value__{f}) OVER ()) / (max(value__{f}) OVER () - min(value__{f}) OVER () + 0.000000001::DOUBLE) AS value__{f}"
    for f in FEATURES) + " FROM feats", " ".join(f"value__{f}" for f in FEATURES))

# ---- forecasting --------------------------------------------------------------------------

oracle("forecast_input", """SELECT Id AS series, ActivityDate AS ds, TotalSteps AS y FROM da WHERE TotalSteps IS NOT NULL
  AND Id IN (SELECT Id FROM da WHERE TotalSteps IS NOT NULL GROUP BY 1 HAVING count(*) >= 10)""", "y", "ds")
PARTS["history"] = """SELECT 'steps' AS series, Date AS ds, TotalSteps AS y FROM steps_daily
  UNION ALL SELECT 'heart rate', Date, Value FROM hr_two_step
  UNION ALL SELECT 'sleep', Date, avg(TotalSleepMinutes) FROM md GROUP BY 2"""
PARTS["numbered"] = """SELECT *, datediff('day', min(ds) OVER (PARTITION BY series), ds)::DOUBLE AS t FROM history"""
PARTS["lines"] = """SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, regr_slope(y, t) AS slope,
  regr_intercept(y, t) AS icept FROM numbered GROUP BY 1"""
PARTS["lefts"] = """SELECT series, ds, isodow(ds) AS dow, y - (icept + slope * t) AS r FROM numbered JOIN lines USING (series)"""
PARTS["weeks"] = "SELECT series, dow, avg(r) AS weekly FROM lefts GROUP BY 1, 2"
PARTS["noises"] = "SELECT series, stddev_samp(r - weekly) AS noise FROM lefts JOIN weeks USING (series, dow) GROUP BY 1"
PARTS["fitted"] = """SELECT series, ds, icept + slope * datediff('day', first_ds, ds) AS trend, COALESCE(weekly, 0) AS weekly, noise
  FROM (SELECT series, ds FROM history UNION ALL SELECT series, CAST(last_ds + CAST(k AS INTEGER) AS DATE) FROM lines, range(1, 31) r(k))
  JOIN lines USING (series) JOIN noises USING (series) LEFT JOIN weeks USING (series) WHERE weeks.dow = isodow(ds)"""
oracle("forecast_components", "SELECT * FROM fitted", "trend weekly noise", "ds")
oracle("forecast_trend_weekly", """SELECT series, ds, trend + weekly AS yhat, trend + weekly - 1.2815515655446004::DOUBLE * noise AS yhat_lower,
  trend + weekly + 1.2815515655446004::DOUBLE * noise AS yhat_upper FROM fitted""", "yhat yhat_lower yhat_upper", "ds")


def _bent(name: str, source: str, bends: int, horizon: int) -> None:
    """Trend with bends: the cells of every series' system as rows, one elimination step a subquery."""
    n = bends + 2
    columns = ["1.0::DOUBLE", "x", *[f"greatest(x - {s!r}::DOUBLE, 0.0::DOUBLE)" for s in bend_places(bends)]]
    PARTS[f"{name}_days"] = f"""SELECT series, ds, y, t, t / greatest(max(t) OVER (PARTITION BY series), 1.0::DOUBLE) AS x
      FROM (SELECT *, datediff('day', min(ds) OVER (PARTITION BY series), ds)::DOUBLE AS t FROM {source})"""
    weights = [0.0, 1e-9] + [PENALTY] * bends
    cells = [f"""SELECT series, {i} AS i, {j} AS j, sum({columns[i]} * {columns[j] if j < n else 'y'}){
        f' + count(*) * {weights[i]!r}::DOUBLE' if i == j else ''} AS v FROM {name}_days GROUP BY 1"""
             for i in range(n) for j in range(n + 1)]
    PARTS[f"{name}_step0"] = " UNION ALL ".join(cells)
    for k in range(n):
        PARTS[f"{name}_step{k + 1}"] = f"""SELECT series, i, j, CASE WHEN i = {k} THEN v ELSE v - (max(v) FILTER (i = {k}) OVER (PARTITION BY series, j))
          * (max(v) FILTER (j = {k}) OVER (PARTITION BY series, i)) / (max(v) FILTER (i = {k} AND j = {k}) OVER (PARTITION BY series)) END AS v
          FROM {name}_step{k}"""
    PARTS[f"{name}_solved"] = "SELECT series, " + ", ".join(
        f"max(v) FILTER (i = {k} AND j = {n}) / max(v) FILTER (i = {k} AND j = {k}) AS c{k}" for k in range(n)) + f" FROM {name}_step{n} GROUP BY 1"
    trend = " + ".join(f"c{k} * ({c})" for k, c in enumerate(columns))
    PARTS[f"{name}_all"] = f"""SELECT series, ds, y, {trend} AS trend FROM (SELECT series, ds, y, x FROM {name}_days
      UNION ALL SELECT series, CAST(last_ds + CAST(k AS INTEGER) AS DATE), NULL, (last_t + k) / greatest(last_t, 1.0::DOUBLE)
      FROM (SELECT series, max(ds) AS last_ds, max(t) AS last_t FROM {name}_days GROUP BY 1), range(1, {horizon + 1}) r(k))
      JOIN {name}_solved USING (series)"""
    PARTS[f"{name}_weeks"] = f"SELECT *, COALESCE(avg(y - trend) OVER (PARTITION BY series, isodow(ds)), 0) AS weekly FROM {name}_all"
    PARTS[f"{name}_fit"] = f"""SELECT series, ds, trend, weekly, COALESCE(stddev_samp(y - trend - weekly) OVER (PARTITION BY series), 0) AS noise
      FROM {name}_weeks"""


PARTS["user_history"] = """SELECT Id AS series, ActivityDate AS ds, TotalSteps AS y FROM da WHERE TotalSteps IS NOT NULL
  AND Id IN (SELECT Id FROM da WHERE TotalSteps IS NOT NULL GROUP BY 1 HAVING count(*) >= 10)"""
_bent("bent", "history", BENDS, 30)
oracle("forecast_trend_bends", """SELECT series, ds, trend + weekly AS yhat, trend + weekly - 1.2815515655446004::DOUBLE * noise AS yhat_lower,
  trend + weekly + 1.2815515655446004::DOUBLE * noise AS yhat_upper FROM bent_fit""", "yhat yhat_lower yhat_upper", "ds")
_bent("user_bent", "user_history", USER_BENDS, 7)
oracle("forecast_bends_by_user", "SELECT * FROM user_bent_fit", "trend weekly noise", "ds")

# ---- user profiles and clustering ---------------------------------------------------------

_user_metrics = ACTIVITY + _hr_cols + ["TotalSleepMinutes"]
PARTS["um"] = "SELECT Id, " + ", ".join(f"avg({c}) AS {c}" for c in _user_metrics) + " FROM md GROUP BY 1"
oracle("user_features", "SELECT Id, " + ", ".join(
    f"COALESCE({c}, quantile_cont({c}, 0.5) OVER (), 0) AS {c}" for c in _user_metrics) + " FROM um",
       " ".join(_user_metrics))
PARTS["um_fixed"] = ("SELECT * FROM (SELECT Id, " + ", ".join(
    f"{half_even(f'avg({c})', 3)} AS {c}" for c in ACTIVITY + ["TotalSleepMinutes"]) + " FROM md GROUP BY 1) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ACTIVITY))
oracle("user_features_fixed", "SELECT * FROM um_fixed", " ".join(ACTIVITY + ["TotalSleepMinutes"]), digits=3)
PARTS["um_activity"] = ("SELECT * FROM (SELECT Id, " + ", ".join(
    f"{half_even(f'avg({c})', 3)} AS {c}" for c in ACTIVITY) + " FROM da GROUP BY 1) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ACTIVITY))


def _scaled(source: str, cols: list[str]) -> str:
    return "SELECT Id, " + ", ".join(
        f"({c} - avg({c}) OVER ()) / COALESCE(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in cols) + f" FROM {source}"


def _dbscan(name: str, source: str, cols: list[str], eps: float, m: int) -> None:
    """Reachability over core points by recursion; border points take the smallest cluster."""
    distance = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols)
    PARTS[f"{name}_near"] = f"SELECT a.Id AS a, b.Id AS b FROM {source} a, {source} b WHERE {distance} <= {eps * eps!r}::DOUBLE"
    PARTS[f"{name}_core"] = f"SELECT a AS Id FROM {name}_near GROUP BY 1 HAVING count(*) >= {m}"
    PARTS[f"{name}_reach"] = f"""SELECT Id AS a, Id AS b FROM {name}_core UNION SELECT r.a, n.b FROM {name}_reach r
      JOIN {name}_near n ON r.b = n.a WHERE n.b IN (SELECT Id FROM {name}_core)"""
    PARTS[f"{name}_num"] = f"""SELECT a AS Id, dense_rank() OVER (ORDER BY c) - 1 AS cluster
      FROM (SELECT a, min(b) AS c FROM {name}_reach GROUP BY 1)"""
    PARTS[f"{name}_labels"] = f"""SELECT s.Id, CAST(COALESCE(k.cluster, (SELECT min(x.cluster) FROM {name}_near n
      JOIN {name}_num x ON n.b = x.Id WHERE n.a = s.Id), -1) AS BIGINT) AS cluster
      FROM {source} s LEFT JOIN {name}_num k ON s.Id = k.Id"""


PARTS["scaled"] = _scaled("um_activity", ACTIVITY)
oracle("standard_scale", "SELECT * FROM scaled", " ".join(ACTIVITY))
_dbscan("wide", "scaled", ACTIVITY, 2.2, 2)
_dbscan("tight", "scaled", ACTIVITY, 1.0, 2)
_dbscan("border", "scaled", ACTIVITY, 1.2, 4)


def _kmeans(name: str, source: str, cols: list[str], ks: str, restarts: int, steps: int = 20) -> None:
    """Lloyd's steps of all models at once: first centres by hash, then means of the nearest points."""
    names = ", ".join(cols)
    away = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in cols)
    PARTS[f"{name}_start"] = f"""SELECT 0 AS step, k, r, rk - 1 AS cluster, {names} FROM (SELECT r, row_number() OVER (PARTITION BY r
      ORDER BY md5(Id || ':' || r), Id) AS rk, {names} FROM {source}, range({restarts}) x(r)), {ks} y(k) WHERE rk <= k"""
    near = f"""SELECT c.step, c.k, c.r, p.Id, min({{'cost': {away}, 'cluster': c.cluster}}) AS n,
      {", ".join(f"any_value(p.{c}) AS {c}" for c in cols)} FROM {source} p, centres c GROUP BY ALL"""
    PARTS[f"{name}_lloyd"] = f"""SELECT * FROM {name}_start UNION ALL
      SELECT step + 1, k, r, cluster, {", ".join(f"COALESCE(m{i}, {c})" for i, c in enumerate(cols))}
      FROM {name}_lloyd LEFT JOIN (SELECT k, r, n.cluster AS cluster, {", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(cols))}
        FROM ({near.replace("centres", f"{name}_lloyd")}) GROUP BY ALL) USING (k, r, cluster) WHERE step < {steps}"""
    PARTS[f"{name}_end"] = f"SELECT * FROM {name}_lloyd WHERE step = {steps}"
    PARTS[f"{name}_near"] = near.replace("centres", f"{name}_end")
    PARTS[f"{name}_cost"] = f"SELECT k, r, sum(n.cost) AS cost FROM {name}_near GROUP BY 1, 2"
    PARTS[f"{name}_best"] = f"""SELECT k, arg_min(r, {{'cost': round(cost, 9), 'r': r}}) AS r FROM {name}_cost GROUP BY 1"""
    PARTS[f"{name}_order"] = f"""SELECT k, r, cluster, row_number() OVER (PARTITION BY k ORDER BY {cols[0]} DESC, cluster) - 1 AS place
      FROM {name}_end JOIN {name}_best USING (k, r)"""
    PARTS[f"{name}_labels"] = f"""SELECT Id, CAST(place AS BIGINT) AS cluster FROM {name}_near x
      JOIN {name}_order o ON x.k = o.k AND x.r = o.r AND x.n['cluster'] = o.cluster"""


_kmeans("three", "scaled", ACTIVITY, "range(3, 4)", 1)
_kmeans("again", "scaled", ACTIVITY, "range(3, 4)", 10)
_kmeans("elbow", "scaled", ACTIVITY, "range(2, 11)", 1)
oracle("sketch_quantiles", """SELECT name AS "column", p, n AS rows, true AS within FROM (
  SELECT 'TotalSteps' AS name, count(TotalSteps) AS n FROM da WHERE ActivityDate BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
  UNION ALL SELECT 'Calories', count(Calories) FROM da WHERE ActivityDate BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'),
  (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) x(p)""", "p")
oracle("distinct_sketches", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT ActivityDate) AS days,
  count(DISTINCT {c}) AS exact, true AS within FROM da WHERE ActivityDate BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"""
                                               for c in ("Id", "TotalSteps")))
oracle("kmeans", "SELECT * FROM three_labels")
oracle("kmeans_restarts", "SELECT * FROM again_labels")
oracle("kmeans_elbow", "SELECT k, min(cost) AS inertia FROM elbow_cost GROUP BY 1", "inertia", digits=2)


def _pca(source: str, cols: list[str]) -> None:
    """The two longest axes: the covariance matrix squared again and again comes to its first axis."""
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, covar_samp({a}, {b}) AS x FROM {source}"
                               for i, a in enumerate(cols) for j, b in enumerate(cols))
    left = """SELECT s.i, s.j, s.x - l.x * a.x * b.x AS x FROM spread1 s JOIN axis1 a USING (i)
      JOIN axis1 b ON s.j = b.i, length1 l"""
    for k, spread in ((1, cells), (2, left)):
        PARTS[f"spread{k}"] = spread
        PARTS[f"power{k}"] = f"""SELECT 0 AS step, i, j, x FROM spread{k} UNION ALL
          SELECT step + 1, i, j, x / sum(CASE WHEN i = j THEN x END) OVER () FROM (
            SELECT a.step, a.i, b.j, sum(a.x * b.x) AS x FROM power{k} a JOIN power{k} b ON a.j = b.i WHERE a.step < 40 GROUP BY ALL)"""
        PARTS[f"column{k}"] = f"""SELECT i, x FROM power{k} WHERE step = 40 AND j = (SELECT arg_max(j, x) FROM power{k} WHERE step = 40 AND i = j)"""
        PARTS[f"axis{k}"] = f"""SELECT i, x / sqrt(sum(x * x) OVER ()) * sign(max(x) OVER () + min(x) OVER ()) AS x FROM column{k}"""
        PARTS[f"length{k}"] = f"SELECT sum(a.x * s.x * b.x) AS x FROM spread{k} s JOIN axis{k} a USING (i) JOIN axis{k} b ON s.j = b.i"
    PARTS["centred"] = "SELECT Id, unnest([" + ", ".join(f"{c} - avg({c}) OVER ()" for c in cols) + f"]) AS v, unnest(range({len(cols)})) AS i FROM {source}"


_pca("scaled", ACTIVITY)
oracle("pca_2d", """SELECT Id, sum(v * a.x) AS PC1, sum(v * b.x) AS PC2, any_value(explained_1) AS explained_1,
  any_value(explained_2) AS explained_2 FROM centred JOIN axis1 a USING (i) JOIN axis2 b USING (i),
  (SELECT length1.x / t AS explained_1, length2.x / t AS explained_2 FROM length1, length2,
    (SELECT sum(x) AS t FROM spread1 WHERE i = j)) GROUP BY Id""", "PC1 PC2 explained_1 explained_2")
oracle("dbscan", "SELECT * FROM wide_labels")
oracle("dbscan_tight", "SELECT * FROM tight_labels")
oracle("dbscan_border", "SELECT * FROM border_labels")
oracle("cluster_sizes", "SELECT cluster, count(*) AS users FROM tight_labels GROUP BY 1")
oracle("cluster_summary", """SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS clusters,
  count(*) FILTER (cluster = -1) AS noise, count(*) AS users,
  count(*) FILTER (cluster = -1) / count(*) * 100 AS noise_pct FROM tight_labels""", "noise_pct")
_shown = ["TotalSteps", "Calories", "VeryActiveMinutes", "FairlyActiveMinutes", "LightlyActiveMinutes", "SedentaryMinutes"]
oracle("cluster_profile", "SELECT cluster, " + ", ".join(f"{half_even(f'avg({c})', 2)} AS {c}" for c in _shown)
       + " FROM um_activity JOIN tight_labels USING (Id) GROUP BY 1", " ".join(_shown), digits=2)
oracle("cluster_profile_long", " UNION ALL ".join(
    f"""SELECT cluster, '{c}' AS "Metric", avg({c}) AS "Average", 'Group ' || cluster AS "Group"
    FROM um_activity JOIN tight_labels USING (Id) GROUP BY 1""" for c in _shown), "Average")
PARTS["um_imputed"] = "SELECT Id, " + ", ".join(f"avg({c}) AS {c}" for c in ACTIVITY + _sums) + " FROM mi_imputed GROUP BY 1"
PARTS["scaled_imputed"] = _scaled("um_imputed", ACTIVITY + _sums)
_kmeans("stage", "scaled_imputed", ACTIVITY + _sums, "range(3, 4)", 3)
_dbscan("dense", "scaled_imputed", ACTIVITY + _sums, 2.2, 2)
oracle("stage2_clusters", """SELECT u.*, a.cluster AS KMeans_Cluster, b.cluster AS DBSCAN_Cluster FROM um_imputed u
  LEFT JOIN stage_labels a USING (Id) LEFT JOIN dense_labels b USING (Id)""", ACTIVITY + _sums, digits=3)
oracle("stage2_profile", "SELECT cluster AS KMeans_Cluster, " + ", ".join(f"{half_even(f'avg({c})', 2)} AS {c}" for c in ACTIVITY + _sums)
       + " FROM um_imputed JOIN stage_labels USING (Id) GROUP BY 1", ACTIVITY + _sums, digits=2)
oracle("activity_label", """SELECT Id, CASE WHEN TotalSteps > 10000 THEN 'Highly Active' WHEN TotalSteps > 7000 THEN 'Moderately Active'
  WHEN TotalSteps > 4000 THEN 'Lightly Active' ELSE 'Sedentary' END AS level,
  CASE WHEN TotalSteps > 10000 THEN 'Highly Active' WHEN TotalSteps > 5000 THEN 'Moderately Active' ELSE 'Sedentary' END AS coarse_level
  FROM um_activity""")
oracle("hr_sleep_label", """SELECT Id, Date, CASE WHEN AvgHR > 80 THEN 'elevated' WHEN AvgHR > 60 THEN 'normal' ELSE 'low' END AS hr_level,
  CASE WHEN TotalSleepMinutes >= 420 THEN 'Good sleep' ELSE 'Low sleep' END AS sleep_level FROM md""", days="Date")
oracle("group_name", """SELECT Id, CASE WHEN cluster = -1 THEN 'Outlier' ELSE 'Group ' || cluster END AS "group" FROM tight_labels""")
_seven = ACTIVITY + ["TotalSleepMinutes"]
PARTS["scaled_seven"] = _scaled("um_fixed", _seven)
_dbscan("struct", "scaled_seven", _seven, 1.5, 2)
oracle("structural_outliers", "SELECT Id, " + ", ".join(f"{half_even(c, 2)} AS {c}" for c in _seven)
       + " FROM um_fixed JOIN struct_labels USING (Id) WHERE cluster = -1", " ".join(_seven), digits=2)

# ---- anomaly detection --------------------------------------------------------------------

PARTS["steps_resid"] = """SELECT *, TotalSteps - rolling_med AS residual FROM (SELECT *, quantile_cont(TotalSteps, 0.5)
  OVER (ORDER BY Date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS rolling_med FROM steps_daily)"""
oracle("threshold_flags", f"SELECT *, TotalSteps > {STEPS[1]} AS thresh_high, TotalSteps < {STEPS[0]} AS thresh_low FROM steps_daily",
       "TotalSteps", "Date")
oracle("rolling_median", "SELECT Date, TotalSteps, rolling_med FROM steps_resid", "TotalSteps rolling_med", "Date")
oracle("residual", "SELECT * FROM steps_resid", "TotalSteps rolling_med residual", "Date")
oracle("residual_flags", """SELECT *, abs(residual) > 1.0 * stddev_samp(residual) OVER () AS resid_anomaly FROM steps_resid""",
       "TotalSteps rolling_med residual", "Date")
oracle("expected_band", """SELECT *, rolling_med - 2.0 * stddev_samp(residual) OVER () AS lower,
  rolling_med + 2.0 * stddev_samp(residual) OVER () AS upper FROM steps_resid""",
       "TotalSteps rolling_med residual lower upper", "Date")

SIGNALS = {"hr": ("AvgHR", "HR"), "steps": ("TotalSteps", "Steps"), "sleep": ("TotalSleepMinutes", "Sleep")}


def _detect(signal: str, lo, hi, sigma: float, v4: bool) -> str:
    value, word = SIGNALS[signal]
    unit = "min" if signal == "sleep" else ""
    needs = " AND ".join(f"{c} IS NOT NULL" for c in (
        [value, "MaxHR", "MinHR"] if signal == "hr" and not v4 else [value]))
    resid = "resid_anom" if v4 else "resid_anomaly"
    text = f"+/-{sigma:.0f}sigma residual" if v4 else f"Residual±{sigma:.0f}σ"
    lo_text, hi_text = (f"{lo:,}", f"{hi:,}") if v4 and signal == "steps" else (lo, hi)
    high = f"CASE WHEN thresh_high THEN '{word}>{hi_text}{unit}' END"
    low = f"CASE WHEN thresh_low THEN '{word}<{lo_text}{unit}' END"
    reasons = [high, low] if signal == "hr" else [low, high]
    extra = ""
    if signal == "sleep" and not v4:
        reasons.insert(0, "CASE WHEN no_data THEN 'No device worn' END")
        extra = f", COALESCE({value} = 0, false) AS no_data"
    positive = f"{value} > 0 AND " if signal == "sleep" else ""
    std = "stddev_samp(residual) OVER ()"
    if v4:
        std = f"CASE WHEN {std} > 0 THEN {std} ELSE 1.0 END"
    return f"""SELECT *, thresh_high OR thresh_low OR {resid} AS is_anomaly,
  concat_ws(', ', {', '.join(reasons)}, CASE WHEN {resid} THEN '{text}' END) AS reason FROM (
  SELECT *, COALESCE(abs(residual) > {float(sigma)} * ({std}), false) AS {resid}, {value} > {hi} AS thresh_high,
  {positive}{value} < {lo} AS thresh_low{extra} FROM (SELECT *, {value} - rolling_med AS residual FROM (
  SELECT Date, {value}, quantile_cont({value}, 0.5) OVER (ORDER BY Date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS rolling_med
  FROM (SELECT Date, avg({value}) AS {value} FROM md WHERE {needs} GROUP BY 1))))"""


DEFAULTS = {"hr": (50, 100), "steps": (500, 25000), "sleep": (60, 600)}
NARROW = {"hr": HR, "steps": STEPS, "sleep": SLEEP}
for _signal, (_value, _) in SIGNALS.items():
    for _form in ("", "_v4"):
        _cols = f"{_value} rolling_med residual"
        oracle(f"detect_{_signal}{_form}", _detect(_signal, *DEFAULTS[_signal], 2.0, bool(_form)), _cols, "Date")
        oracle(f"detect_{_signal}{_form}_narrow", _detect(_signal, *NARROW[_signal], 1.5, bool(_form)), _cols, "Date")
    PARTS[f"d_{_signal}"] = _detect(_signal, *NARROW[_signal], 2.0, False)

NAMES = {"hr": "Heart Rate", "steps": "Steps", "sleep": "Sleep"}
PARTS["flagged"] = " UNION ALL ".join(
    f"SELECT '{NAMES[s]}' AS signal, Date, {v} AS value, rolling_med AS expected, residual, reason FROM d_{s} WHERE is_anomaly"
    for s, (v, _) in SIGNALS.items())
oracle("alert_intervals", """SELECT Date AS start, CAST(Date + 1 AS DATE) AS "end" FROM d_steps WHERE is_anomaly""", days="start end")
oracle("anomaly_counts", "SELECT *, flags / greatest(days, 1) * 100 AS pct_of_days, sum(flags) OVER ()::BIGINT AS total_flags FROM ("
       + " UNION ALL ".join(f"SELECT '{NAMES[s]}' AS signal, count(*) FILTER (is_anomaly) AS flags, count(*) AS days FROM d_{s}"
                            for s in SIGNALS) + ")", "pct_of_days")
_report = []
for _s, _metric, _unit in (("hr", "Heart Rate (bpm)", "bpm"), ("steps", "Daily Steps", "steps"), ("sleep", "Sleep (min)", "min")):
    _v, (_lo, _hi) = SIGNALS[_s][0], NARROW[_s]
    _report.append(f"""SELECT Date, '{_metric}' AS "Metric", {half_even(_v, 1)} AS "Value", '{_unit}' AS "Unit",
  'Threshold + Residual±2σ' AS "Method", '{_lo}–{_hi} {_unit}' AS "Threshold", reason AS "Anomaly Reason",
  CASE WHEN {_v} > {_hi * 1.1!r}::DOUBLE OR {_v} < {_lo * 0.9!r}::DOUBLE THEN 'High' ELSE 'Medium' END AS "Severity"
  FROM d_{_s} WHERE is_anomaly""")
oracle("anomaly_report", " UNION ALL ".join(_report), "Value", "Date", digits=1)
PARTS["recall_days"] = """SELECT Date, avg(AvgHR) AS AvgHR, avg(TotalSteps) AS TotalSteps, avg(TotalSleepMinutes) AS TotalSleepMinutes
  FROM md WHERE AvgHR IS NOT NULL AND TotalSteps IS NOT NULL GROUP BY 1"""


def _recall(s: str) -> str:
    (value, _), (lo, hi), name = SIGNALS[s], DEFAULTS[s], NAMES[s]
    pool = ", ".join(f"{v}.0" for v in EXTREME_VALUES[name])
    positive = "v > 0 AND " if s == "sleep" else ""
    return f"""SELECT '{name}' AS signal, count(*) AS injected, count(*) FILTER (hit) AS detected FROM (
  SELECT rnk, v > {hi} OR ({positive}v < {lo}) OR COALESCE(abs(r) > 2.0 * stddev_samp(r) OVER (), false) AS hit FROM (
  SELECT *, v - quantile_cont(v, 0.5) OVER (ORDER BY Date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS r FROM (
  SELECT Date, rnk, CASE WHEN rnk <= 10 THEN list_extract(CAST([{pool}] AS DOUBLE[]), CAST(((rnk - 1) % 10) + 1 AS BIGINT)) ELSE {value} END AS v FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42|{name}|' || CAST(Date AS VARCHAR))) AS rnk FROM recall_days)))) WHERE rnk <= 10"""


PARTS["recall"] = ("SELECT *, " + half_even("(detected / nullif(injected, 0) * 100)", 1) + " AS accuracy FROM ("
                   + " UNION ALL ".join(_recall(s) for s in SIGNALS) + ")")
oracle("detector_recall", f"""SELECT *, accuracy >= 90 AS passed FROM (SELECT signal, injected, detected, accuracy FROM recall UNION ALL
  SELECT 'Overall', sum(injected)::BIGINT, sum(detected)::BIGINT, {half_even('avg(accuracy)', 1)} FROM recall)""", "accuracy", digits=1)

# ---- dashboard and export -----------------------------------------------------------------

_range = f"BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
oracle("master_by_day", f"""SELECT * REPLACE (TotalSteps + CASE WHEN Date = DATE '{CORRECTED_DAY}' THEN 1000 ELSE 0 END AS TotalSteps)
  FROM md WHERE Date {_range} AND NOT (Date = DATE '{CORRECTED_DAY}' AND Id % 3 = 0)""",
       _moving + " " + " ".join(_hr_cols) + " TotalSleepMinutes", "Date")
oracle("filter_dates", f"SELECT * FROM da WHERE ActivityDate {_range}", _moving, "ActivityDate")
oracle("filter_user", f"SELECT * FROM da WHERE Id = {ONE_USER}", _moving, "ActivityDate")


def _flags(s: str) -> str:
    return f"(SELECT count(*) FILTER (is_anomaly) FROM d_{s} WHERE Date {_range})"


oracle("kpi_strip", f"""SELECT {_flags('hr')} + {_flags('steps')} + {_flags('sleep')} AS total_flags, {_flags('hr')} AS hr_flags,
  {_flags('steps')} AS steps_flags, {_flags('sleep')} AS sleep_flags, count(DISTINCT Id) AS users, count(DISTINCT Date) AS days,
  COALESCE((SELECT strftime(Date, '%d %b') FROM d_hr WHERE is_anomaly AND Date {_range} ORDER BY abs(residual) DESC, Date LIMIT 1), '—')
  AS peak_hr_day FROM md WHERE Date {_range}""")
oracle("peak_anomaly_day", "SELECT Date, residual FROM d_hr WHERE is_anomaly ORDER BY abs(residual) DESC, Date LIMIT 1", "residual", "Date")
oracle("anomaly_timeline", "SELECT Date, signal, reason, value FROM flagged", "value", "Date")
oracle("recent_anomalies", "SELECT Date, signal, reason FROM flagged ORDER BY Date DESC, signal LIMIT 15", days="Date")
_stats = """avg({v}) AS mean, max({v}) AS max, {min} AS min, count(*) FILTER (is_anomaly) AS anomaly_days,
  count(*) AS total_days, count(*) FILTER (is_anomaly) / count(*) * 100 AS rate"""
oracle("hr_stats", "SELECT " + _stats.format(v="AvgHR", min="min(AvgHR)") + " FROM d_hr", "mean max min rate")
oracle("steps_stats", "SELECT " + _stats.format(v="TotalSteps", min="min(TotalSteps)")
       + f", count(*) FILTER (TotalSteps < {STEPS[0]}) AS days_below FROM d_steps", "mean max min rate")
oracle("sleep_stats", "SELECT " + _stats.format(
    v="TotalSleepMinutes", min="COALESCE(min(CASE WHEN TotalSleepMinutes > 0 THEN TotalSleepMinutes END), 0)")
       + f", count(*) FILTER (TotalSleepMinutes < {SLEEP[0]}) AS days_below FROM d_sleep", "mean max min rate")
oracle("days_below", f"SELECT count(*) FILTER (TotalSteps < {STEPS[0]}) AS days_below FROM steps_daily")
_records = """SELECT Date, {v} AS "{v}", {e} AS "Expected", {r} AS "Deviation", reason AS "Reason" FROM {t} WHERE is_anomaly"""


def _record_rows(v: str, t: str) -> str:
    return _records.format(v=v, t=t, e=half_even("rolling_med", 2), r=half_even("residual", 2)).replace(
        f'{v} AS "{v}"', f'{half_even(v, 2)} AS "{v}"')


oracle("anomaly_records", _record_rows("TotalSleepMinutes", "d_sleep"), "TotalSleepMinutes Expected Deviation", "Date", digits=2)
def _top_records(n: int, width: int) -> str:
    return f"""SELECT Date, {half_even('AvgHR', 1)} AS "AvgHR", {half_even('"Expected"', 1)} AS "Expected",
  {half_even('"Deviation"', 1)} AS "Deviation", "Reason"[1:{width}] AS "Reason", more_records FROM (
  SELECT *, greatest(count(*) OVER () - {n}, 0) AS more_records FROM ({_record_rows('AvgHR', 'd_hr')})) ORDER BY Date LIMIT {n}"""


oracle("records_top25", _top_records(3, 12), "AvgHR Expected Deviation", "Date", digits=1)
oracle("records_top25_defaults", _top_records(25, 55), "AvgHR Expected Deviation", "Date", digits=1)
_export = "SELECT signal, Date, " + ", ".join(f"{half_even(c, 2)} AS {c}" for c in ("value", "expected", "residual")) \
    + ", reason FROM flagged"
oracle("anomaly_export", _export, "value expected residual", "Date", digits=2)
oracle("export_from_files", _export, "value expected residual", "Date", digits=2)
oracle("write_csv", _export, "value expected residual", "Date", digits=2)
_profile = ["TotalSteps", "Calories", "VeryActiveMinutes", "SedentaryMinutes", "TotalSleepMinutes"]
oracle("user_activity_profile", "SELECT right(CAST(Id AS VARCHAR), 6) AS Id, " + ", ".join(
    f"{half_even(f'avg({c})', 0)} AS {c}" for c in _profile) + " FROM md GROUP BY md.Id", " ".join(_profile), digits=0)
oracle("dataset_overview", """SELECT count(DISTINCT Id) AS users, count(DISTINCT Date) AS days, strftime(min(Date), '%d %b %Y') AS first_date,
  strftime(max(Date), '%d %b %Y') AS last_date FROM md""")
