"""The test tables as tracker tables.

``events`` is a per-user series and stands in for the five tracker roles, ``orders`` for the
free-form single file. All derivations are projections and grouped sums over whole tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

# Minutes of sleep that one task expands.
TASK_MINUTES = 4_000_000
EXPORT_TIME = "M/d/yyyy h:mm:ss a"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of(kind: str, c):
    return F.when(F.col("event_type") == kind, c)


def heartrate(events: DataFrame) -> DataFrame:
    """Every event at +0, +20 and +40 seconds, rising by 0.1 per second."""
    offset = F.explode(F.array(F.lit(0), F.lit(20), F.lit(40))).alias("offset")
    return events.select("user_id", "ts", "value", offset).select(
        F.col("user_id").alias("Id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("offset").cast("decimal(18,6)"))).alias("Time"),
        (F.col("value") + F.col("offset") * 0.1).alias("Value"))


def heartrate_with_gaps(events: DataFrame) -> DataFrame:
    """The same with the readings of every fourth event missing."""
    missing = events.withColumn("value", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return heartrate(missing)


def daily_activity(events: DataFrame) -> DataFrame:
    """Per user and day; steps are null on days without a click."""
    v = F.col("value")
    return events.groupBy(F.col("user_id").alias("Id"), F.to_date("ts").alias("ActivityDate")).agg(
        F.sum(_of("click", 100 * v)).alias("TotalSteps"), F.sum(20 * v).alias("Calories"),
        F.sum(_of("view", v)).alias("VeryActiveMinutes"),
        F.sum(_of("purchase", v)).alias("FairlyActiveMinutes"),
        (30 * F.count("*")).alias("LightlyActiveMinutes"),
        (1440 - 30 * F.count("*")).alias("SedentaryMinutes"))


def daily_activity_raw(events: DataFrame) -> DataFrame:
    """Text dates (some bad), a text column with nulls, and repeated rows for every tenth user."""
    day = F.col("ActivityDate")
    raw = daily_activity(events).withColumns({
        "ActivityDate": F.when((F.col("Id") % 13 == 0) & (F.dayofmonth(day) == 15), "bad")
        .otherwise(F.date_format(day, "M/d/yyyy")),
        "Device": F.when(F.col("Id") % 4 != 0,
                         F.concat(F.lit("tracker-"), (F.col("Id") % 3).cast("string")))})
    copies = F.when(F.col("Id") % 10 == 0, F.lit(2)).otherwise(F.lit(1))
    return raw.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def _hourly(events: DataFrame, kind: str):
    return events.filter(F.col("event_type") == kind).groupBy(
        F.col("user_id").alias("Id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ActivityHour"))


def hourly_steps(events: DataFrame) -> DataFrame:
    return _hourly(events, "click").agg(F.sum(100 * F.col("value")).alias("StepTotal"))


def hourly_intensities(events: DataFrame) -> DataFrame:
    return _hourly(events, "purchase").agg(
        F.sum("value").alias("TotalIntensity"), (F.sum("value") / 60).alias("AverageIntensity"))


def minute_sleep(events: DataFrame) -> DataFrame:
    """Each signup or error event opens a log of 10 to 300 minutes."""
    logs = events.filter(F.col("event_type").isin("signup", "error")).select(
        "event_id", "user_id", "ts")
    # a log grows up to 301-fold: deal the logs into tasks of a bounded number of minutes before expanding them
    minutes = logs.agg(F.sum(1 + 10 * (1 + F.col("event_id") % 30))).first()[0] or 0
    tasks = max(events.sparkSession.sparkContext.defaultParallelism, math.ceil(minutes / TASK_MINUTES))
    logs = logs.repartition(tasks, "event_id")
    minute = F.explode(F.sequence(F.lit(0), 10 * (1 + F.col("event_id") % 30))).alias("minute")
    return logs.select("event_id", "user_id", "ts", minute).select(
        F.col("user_id").alias("Id"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("minute").cast("int"))).alias("date"),
        (1 + (F.col("event_id") + F.col("minute")) % 3).alias("value"),
        F.col("event_id").alias("logId"))


def single_file(orders: DataFrame) -> DataFrame:
    """Free-form fitness file; ``Record`` gives the row order."""
    k = F.col("o_orderkey")

    def choice(n: int, values: list[str | None]):
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(k % n == i, F.lit(v)).otherwise(out)
        return out

    return orders.select(
        k.alias("Record"), F.col("o_custkey").alias("User_ID"),
        F.concat(F.lit("User "), F.col("o_custkey").cast("string")).alias("Full Name"),
        choice(5, ["male", " Female ", "FEMALE", None, "Other"]).alias("Gender"),
        F.when(k % 11 != 0, F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Date"),
        choice(4, ["Running", "Yoga", "Cycling", None]).alias("Workout_Type"),
        F.when(k % 7 != 0, k % 120).alias("Active_Minutes"), (4 + k % 6).alias("Hours_Slept"),
        (55 + k % 60).alias("Heart_Rate (bpm)"),
        choice(6, ["Happy", "Sad", "Anxious", "Calm", "Angry", None]).alias("Mood"),
        F.when(k % 17 == 0, "n/a").otherwise((1 + k % 10).cast("string")).alias("Stress_Level"))


ROLES = {"daily_activity": daily_activity, "heartrate": heartrate,
         "hourly_intensities": hourly_intensities, "hourly_steps": hourly_steps,
         "minute_sleep": minute_sleep}


def roles(spark: SparkSession, sf_dir: str, names=tuple(ROLES)) -> dict[str, DataFrame]:
    events = table(spark, sf_dir, "events")
    return {name: ROLES[name](events) for name in names}
