"""Cleaning projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import col, text_columns
from ..functions.ordered import RANGES, carry_forward

# The text formats of the tracker exports.
EXPORT_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yy")
DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d-M-yyyy H:mm:ss",
                     "d-M-yyyy H:mm", "d.M.yyyy H:mm:ss", "d.M.yyyy H:mm", "d/M/yy", "d-M-yy", "d.M.yy")

UNKNOWN = "Unknown"
NO_WORKOUT = "No Workout"


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Drop fully equal rows; copies already collapse on the map side of the shuffle."""
    return df.dropDuplicates()


def parsed(c: Column, formats: Sequence[str]) -> Column:
    """Text to a timestamp by the first format that fits, else ISO, else null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats], F.try_to_timestamp(c))


def parse_timestamps(df: DataFrame, cols: Sequence[str],
                     formats: Sequence[str] = EXPORT_FORMATS) -> DataFrame:
    """Text to zone-less timestamps, trying the formats and then ISO row by row; bad text -> null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {c: (parsed(col(c), formats) if isinstance(types[c], T.StringType) else col(c))
           .cast("timestamp_ntz") for c in cols if c in types}
    return df.withColumns(new)


def drop_invalid_timestamps(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose key timestamp is null."""
    return df.filter(col(column).isNotNull())


def normalise_utc(df: DataFrame, column: str = "Date") -> DataFrame:
    """Day-first text to an instant in UTC (the session zone); bad text -> null."""
    return df.withColumn(column, parsed(col(column), DAY_FIRST_FORMATS))


def date_like_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]


def parse_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Day-first text to dates; bad text -> null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: (parsed(col(c), DAY_FIRST_FORMATS) if isinstance(types[c], T.StringType) else col(c))
        .cast("date") for c in cols})


def normalise_dates(df: DataFrame, order: Sequence[str], cols: Sequence[str] | None = None,
                    chunk: Column | str = RANGES) -> DataFrame:
    """Day-first text to dates; gaps take the last valid date in row order."""
    cols = list(cols if cols is not None else date_like_columns(df))
    return carry_forward(parse_dates(df, cols), cols, order, chunk=chunk)


def fill_unknown(df: DataFrame, leave_out: Sequence[str] = ()) -> DataFrame:
    """Missing texts become "Unknown"."""
    texts = text_columns(df, tuple(leave_out))
    return df.withColumns({c: F.coalesce(col(c), F.lit(UNKNOWN)) for c in texts})


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Missing values become a constant, per column."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in values.items()
                           if c in df.columns})


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows that are complete in the listed columns."""
    return df.dropna(subset=list(cols))
