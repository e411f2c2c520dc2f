"""Minute resampling and daily roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import as_date, col, numeric_columns

_MINUTE = 60


def _minute(c: Column) -> Column:
    return F.date_trunc("minute", c).cast("timestamp_ntz")


def resample_minute(df: DataFrame, key: str | None = "Id", time: str = "Time",
                    value: str = "Value", name: str = "HeartRate") -> DataFrame:
    """Mean per user and minute; minutes without a value are left out."""
    keys = [col(key)] if key else []
    usable = df.filter(col(value).isNotNull()).dropna(subset=[c for c in (key, time) if c])
    return (usable.groupBy(*keys, _minute(col(time)).alias(time))
            .agg(F.avg(col(value)).alias(name)))


def minute_segments(df: DataFrame, key: str | None = "Id", time: str = "Time",
                    value: str = "Value") -> DataFrame:
    """The filled minutes of a user as straight runs, one row for each observed minute.

    (key, s, v, step, before, last): the minute at second ``s`` has value ``v``, minute ``k`` after it
    ``v + k * step`` up to ``k = last``. ``before`` is 0, or minus the minutes of the user that lie before
    the first value. Each observed minute finds its successor in its day, or in a later one.
    """
    keys = [key] if key else []
    seconds = F.unix_timestamp(_minute(col(time)).cast("timestamp"))
    means = (df.dropna(subset=keys + [time])
             .groupBy(*[col(k) for k in keys], seconds.alias("__s"))
             .agg(F.avg(col(value)).alias("__v")))
    means = means.withColumn("__day", F.floor(col("__s") / 86400))
    has = col("__v").isNotNull()
    point = F.struct(col("__s").alias("s"), col("__v").alias("v"))
    # per day and user, then across days of a user: the next value and the ends of the series
    known_at = F.when(has, col("__s"))
    days = means.groupBy(*[col(k) for k in keys], "__day").agg(
        F.min(known_at).alias("__hs"), F.min_by("__v", known_at).alias("__hv"),
        F.min("__s").alias("__first"), F.max("__s").alias("__last"))
    head = F.when(col("__hs").isNotNull(), F.struct(col("__hs").alias("s"), col("__hv").alias("v")))
    days = days.withColumn("__head", head)
    per_key = Window.partitionBy(*[col(k) for k in keys])
    later = per_key.orderBy(col("__day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = days.select(
        *[col(k) for k in keys], "__day",
        F.last("__head", True).over(later).alias("__tail"),
        F.min("__head").over(per_key)["s"].alias("__start"),
        F.min("__first").over(per_key).alias("__first"),
        F.max("__last").over(per_key).alias("__end"))
    inside = Window.partitionBy(*[col(k) for k in keys], "__day").orderBy("__s")
    known = (means.filter(has).withColumn("__next", F.lead(point).over(inside))
             .join(ends, keys + ["__day"])
             .withColumn("__next", F.coalesce(col("__next"), col("__tail"))))
    minutes_before = F.when(col("__s") == col("__start"),
                            F.floor((col("__first") - col("__s")) / _MINUTE)).otherwise(F.lit(0))
    minutes_after = F.coalesce(F.floor((col("__next")["s"] - col("__s")) / _MINUTE) - 1,
                               F.floor((col("__end") - col("__s")) / _MINUTE))
    gap = (col("__next")["s"] - col("__s")) / _MINUTE
    step = F.coalesce(F.try_divide(col("__next")["v"] - col("__v"), gap), F.lit(0.0))
    return known.select(*[col(k) for k in keys], col("__s").alias("s"), col("__v").alias("v"), step.alias("step"),
                        minutes_before.cast("long").alias("before"), minutes_after.cast("long").alias("last"))


def resample_minute_filled(df: DataFrame, key: str | None = "Id", time: str = "Time",
                           value: str = "Value") -> DataFrame:
    """Mean per user and minute for every minute from the first to the last row of a user.

    Gaps are interpolated; minutes after the last value repeat it, minutes before the first
    value stay null. Each observed minute expands into the minutes up to its successor, so the
    dense grid is produced by a narrow step and never joined or sorted.
    """
    keys = [key] if key else []
    return (minute_segments(df, key, time, value).withColumn("__k", F.explode(F.sequence("before", "last")))
            .select(*[col(k) for k in keys],
                    F.timestamp_seconds(col("s") + col("__k") * _MINUTE).cast("timestamp_ntz").alias(time),
                    F.when(col("__k") >= 0, col("v") + col("step") * col("__k")).alias(value)))


def daily_hr_stats(minutes: DataFrame, key: str = "Id", time: str = "Time",
                   value: str = "HeartRate") -> DataFrame:
    """Per user and day: mean, maximum, minimum and sample deviation of the minute means."""
    v = col(value)
    return (minutes.groupBy(col(key), as_date(col(time)).alias("Date"))
            .agg(F.avg(v).alias("AvgHR"), F.max(v).alias("MaxHR"), F.min(v).alias("MinHR"),
                 F.stddev_samp(v).alias("StdHR")))


def _by_day(df: DataFrame, time: str, key: str, *sums: Column) -> DataFrame:
    """``sums`` per user and day; rows without a user or a time are ignored.

    They are dropped after the sums, as groups: a filter before them would work out the day a second time.
    """
    keys = [key] if key in df.columns else []
    known = reduce(lambda a, b: a & b, [col(c).isNotNull() for c in (*keys, "__day")])
    return (df.withColumn("__day", as_date(col(time))).groupBy(*[col(c) for c in keys], "__day")
            .agg(*sums, F.count_if(known).alias("__known")).filter("__known > 0").drop("__known")
            .withColumnRenamed("__day", "Date"))


def daily_hr_mean_raw(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: mean of the raw readings."""
    return _by_day(df, "Time", key, F.avg("Value").alias("AvgHeartRate"))


def _daily_sums(df: DataFrame, time: str, key: str, leave_out: tuple[str, ...]) -> DataFrame:
    zero = F.lit(0)
    return _by_day(df, time, key, *[F.coalesce(F.sum(col(c)), zero).alias(c) for c in numeric_columns(df, leave_out)])


def daily_intensity_sum(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: sum of every numeric intensity column."""
    return _daily_sums(df, "ActivityHour", key, (key,))


def daily_steps_sum(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: sum of hourly steps."""
    return _daily_sums(df, "ActivityHour", key, (key,))


def daily_sleep_sum(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: sum of stage codes, named ``TotalSleepMinutes``."""
    sums = _daily_sums(df, "date", key, (key, "logId"))
    first = numeric_columns(df, (key, "logId"))[0]
    return sums.withColumnRenamed(first, "TotalSleepMinutes")


def daily_sleep_count(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: number of minutes with a stage, also named ``TotalSleepMinutes``."""
    return _by_day(df, "date", key, F.count("value").alias("TotalSleepMinutes"))


def dominant_sleep_stage(df: DataFrame, key: str = "Id") -> DataFrame:
    """Per user and day: most frequent stage, the smallest one on a tie."""
    keys = [col(key)] if key in df.columns else []
    usable = df.dropna(subset=[c for c in (key, "date") if c in df.columns])
    counted = (usable.groupBy(*keys, as_date(col("date")).alias("Date"), col("value").alias("__stage"))
               .agg(F.count("*").alias("__n")))
    best = F.max(F.when(col("__stage").isNotNull(), F.struct("__n", (-col("__stage")).alias("__minus"))))
    return counted.groupBy(*keys, "Date").agg((-best["__minus"]).alias("DominantSleepStage"))


def elapsed_series(df: DataFrame, key: str = "Id", time: str = "Time",
                   value: str = "Value") -> DataFrame:
    """(id, whole seconds since the user's first reading, value).

    The first reading is aggregated and joined back, which a user with very many readings
    survives; a window over the user would not.
    """
    rows = df.select(col(key).alias("id"), col(time).alias("__t"), col(value).alias("value")).dropna()
    starts = rows.groupBy("id").agg(F.min("__t").alias("__start"))

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    return rows.join(starts, "id").select(
        "id", F.floor((micros(col("__t")) - micros(col("__start"))) / 1_000_000).alias("time"),
        "value")


def daily_cross_user_mean(df: DataFrame, value: str, date: str = "Date") -> DataFrame:
    """Mean over users per day."""
    return (df.filter(col(value).isNotNull() & col(date).isNotNull())
            .groupBy(col(date)).agg(F.avg(col(value)).alias(value)))


def daily_hr_two_step_mean(filled: DataFrame, key: str = "Id", time: str = "Time",
                           value: str = "Value") -> DataFrame:
    """Mean per user and day of the filled minutes, then mean over users."""
    per_user = (filled.groupBy(col(key), as_date(col(time)).alias("Date"))
                .agg(F.avg(col(value)).alias(value)))
    return per_user.groupBy("Date").agg(F.avg(col(value)).alias(value))


def daily_hr_two_step_mean_of_segments(segments: DataFrame, key: str = "Id", value: str = "Value") -> DataFrame:
    """``daily_hr_two_step_mean`` of the minutes that straight runs stand for: runs are cut at midnight."""
    day = 86_400
    days = F.sequence(F.floor((col("s") + col("before") * _MINUTE) / day), F.floor((col("s") + col("last") * _MINUTE) / day))
    a = F.greatest(F.lit(0), F.ceil((col("__d") * day - col("s")) / _MINUTE))
    b = F.least(col("last"), F.floor((col("__d") * day + day - 1 - col("s")) / _MINUTE))
    n = F.greatest(col("__b") - col("__a") + 1, F.lit(0))
    total = F.when(n > 0, n * col("v") + col("step") * (col("__a") + col("__b")) * n / 2)
    per_user = (segments.withColumn("__d", F.explode(days)).withColumn("__a", a).withColumn("__b", b)
                .groupBy(col(key), "__d").agg(F.try_divide(F.sum(total), F.sum(n)).alias(value)))
    date = F.date_add(F.lit("1970-01-01").cast("date"), col("__d").cast("int"))
    return per_user.groupBy(date.alias("Date")).agg(F.avg(col(value)).alias(value))


def daily_hr_pooled_mean(minutes: DataFrame, time: str = "Time",
                         value: str = "HeartRate") -> DataFrame:
    """Mean per day over the minutes of all users together."""
    return minutes.groupBy(as_date(col(time)).alias("ds")).agg(F.avg(col(value)).alias("y"))
