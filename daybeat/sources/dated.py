"""Tables kept by day: one folder a day, single days replaced, ranges of days read without the rest.

A day is replaced as a whole and at once: new files are staged beside the table and take the place of the
old ones when the job has ended, so a lost executor or a failed job leaves the former days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import as_date, col
from ..operators.report import filter_dates


def _by_day(df: DataFrame, date: str) -> DataFrame:
    """A day's rows beside each other; adaptive execution splits days that are large and joins small ones."""
    return df.withColumn(date, as_date(col(date))).hint("rebalance", col(date))


def write_days(df: DataFrame, path: str, date: str = "Date", mode: str = "errorifexists") -> None:
    """``df`` as Parquet with one folder for each value of ``date``; rows without a day share one of their own."""
    _by_day(df, date).write.mode(mode).partitionBy(date).parquet(path)


def replace_days(df: DataFrame, path: str, date: str = "Date") -> None:
    """The days that ``df`` has rows of hold these rows and no others; all other days stay as they are.

    Rows without a day replace those without a day. A day cannot be emptied this way. ``df`` must not read
    the files that it replaces.
    """
    (_by_day(df, date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date).parquet(path))


def read_days(spark: SparkSession, path: str, schema: T.StructType | None = None, first: str | None = None,
              last: str | None = None, date: str = "Date") -> DataFrame:
    """Rows from the day ``first`` to ``last``; only the folders of these days are read.

    ``schema`` saves reading a file for it and gives back the order of the columns; without it ``date``
    comes last. Call again after a replacement: a DataFrame keeps the files that it has found.
    """
    if schema is not None:
        schema = T.StructType([T.StructField(f.name, T.DateType()) if f.name == date else f for f in schema.fields])
        df = spark.read.schema(schema).parquet(path).select(*[col(f.name) for f in schema.fields])
    else:
        df = spark.read.parquet(path)
        if not isinstance(df.schema[date].dataType, T.DateType):        # no day is known
            df = df.withColumn(date, F.to_date(col(date)))
    return filter_dates(df, first, last, date)
