"""Reading, role binding and writing."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import col
from ..session import one_row

# File-name keywords, key columns and timestamp columns of the five roles.
NAME_KEYWORDS = {
    "daily_activity": ("dailyactivity", "daily_activity"),
    "heartrate": ("heartrate", "heart_rate"),
    "hourly_intensities": ("hourlyintensities", "hourly_intensities"),
    "hourly_steps": ("hourlysteps", "hourly_steps"),
    "minute_sleep": ("minutesleep", "minute_sleep"),
}
KEY_COLUMNS = {
    "daily_activity": ("ActivityDate", "TotalSteps", "Calories"),
    "hourly_steps": ("ActivityHour", "StepTotal"),
    "hourly_intensities": ("ActivityHour", "TotalIntensity"),
    "minute_sleep": ("date", "value", "logId"),
    "heartrate": ("Time", "Value"),
}
TIMESTAMP_COLUMNS = {
    "daily_activity": "ActivityDate",
    "heartrate": "Time",
    "hourly_intensities": "ActivityHour",
    "hourly_steps": "ActivityHour",
    "minute_sleep": "date",
}
# Texts that stand for a missing cell in a CSV file.
MISSING_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Column types of the tracker files, so that reading them needs no inference pass.
COLUMN_TYPES = {
    "daily_activity": {"Id": "long", "ActivityDate": "string"} | dict.fromkeys((
        "TotalSteps", "TotalDistance", "TrackerDistance", "LoggedActivitiesDistance", "VeryActiveDistance",
        "ModeratelyActiveDistance", "LightActiveDistance", "SedentaryActiveDistance", "VeryActiveMinutes",
        "FairlyActiveMinutes", "LightlyActiveMinutes", "SedentaryMinutes", "Calories"), "double"),
    "heartrate": {"Id": "long", "Time": "string", "Value": "double"},
    "hourly_intensities": {"Id": "long", "ActivityHour": "string", "TotalIntensity": "double", "AverageIntensity": "double"},
    "hourly_steps": {"Id": "long", "ActivityHour": "string", "StepTotal": "double"},
    "minute_sleep": {"Id": "long", "date": "string", "value": "long", "logId": "long"},
}
LEAST_SCORE = 2
# Errors of files that hold no table; all others (storage, rights, missing paths) are raised.
NO_TABLE = ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "MALFORMED_CSV_RECORD", "EMPTY_SCHEMA_NOT_SUPPORTED")


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: str | T.StructType | None = None,
               types: dict[str, str] | None = None) -> DataFrame:
    """CSV (with header), JSON or parquet, by suffix.

    In CSV the words of MISSING_WORDS are null, and a column has the type that ``schema`` (all columns,
    in this order) or ``types`` (some columns) gives it; others get the narrowest of long, double,
    boolean, date and timestamp that all their cells have, else text. NaN is null in every format.
    """
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if fmt == "csv":
        df = _read_csv(spark, path, schema, types or {})
    elif fmt in ("json", "parquet"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.json(path) if fmt == "json" else reader.parquet(path)
    else:
        raise ValueError(f"unsupported file format: {fmt}")
    return _without_nan(_naive_times(df))


def _read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None, types: dict[str, str]) -> DataFrame:
    texts = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    texts = texts.select(*[F.when(~F.trim(col(c)).isin(*MISSING_WORDS), col(c)).alias(c) for c in texts.columns])
    if schema is not None:
        fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
        return texts.select(*[_typed(f.name, f.dataType.simpleString()).alias(f.name) for f in fields])
    unknown = [c for c in texts.columns if c not in types]
    known = types | (_narrowest(texts, unknown) if unknown else {})
    return texts.select(*[_typed(c, known[c]).alias(c) for c in texts.columns])


def _typed(column: str, kind: str) -> Column:
    return col(column) if kind == "string" else col(column).try_cast(kind)


def _narrowest(texts: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that all cells of each text column have, from one pass."""
    kinds = {"long": lambda c: c.try_cast("long"), "double": lambda c: c.try_cast("double"),
             "boolean": lambda c: F.when(F.lower(c).isin("true", "false"), c),
             "date": lambda c: F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date")),
             "timestamp_ntz": lambda c: F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]"), c.try_cast("timestamp_ntz"))}
    row = one_row(texts.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)], *[
        F.count(has(col(c))).alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, has in kinds.items()]))
    return {c: next((kind for kind in kinds if row[f"n{i}"] and row[f"{kind}{i}"] == row[f"n{i}"]), "string")
            for i, c in enumerate(columns)}


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN is a missing cell."""
    return df.withColumns({f.name: F.when(~F.isnan(col(f.name)), col(f.name)) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def _naive_times(df: DataFrame) -> DataFrame:
    """Inferred timestamps are local times without a zone."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
                           for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)})


def role_by_name(name: str) -> str | None:
    """First role one of whose keywords is in the file name (case, blanks, dashes ignored)."""
    plain = name.rstrip("/").rsplit("/", 1)[-1].lower().replace(" ", "").replace("-", "")
    return next((role for role, words in NAME_KEYWORDS.items()
                 if any(w in plain for w in words)), None)


def score_columns(columns: Sequence[str], role: str) -> int:
    """Key columns of the role that are present; names are compared with their case."""
    return sum(c in columns for c in KEY_COLUMNS[role])


def roles_by_columns(tables: Sequence[DataFrame]) -> dict[str, DataFrame]:
    """Per role the table with most key columns, at least two; ties keep the earlier table."""
    bound = {}
    for role in KEY_COLUMNS:
        scores = [score_columns(df.columns, role) for df in tables]
        best = max(scores, default=0)
        if best >= LEAST_SCORE:
            bound[role] = tables[scores.index(best)]
    return bound


def load_roles(spark: SparkSession, paths: Sequence[str], by: str = "name") -> dict[str, DataFrame]:
    """Bind files or folders to roles by name or by columns.

    Files of other formats and files that hold no table are left out with a warning. Binding by columns
    looks at headers and schemas alone; only bound files are read, with the types of their role.
    """
    if by == "columns":
        headers = {p: c for p in paths if (c := _readable(p, lambda p: _columns(spark, p))) is not None}
        chosen = {}
        for role in KEY_COLUMNS:
            best = max(headers, key=lambda p: score_columns(headers[p], role), default=None)
            if best is not None and score_columns(headers[best], role) >= LEAST_SCORE:
                chosen[role] = best
    else:
        chosen = {}
        for path in paths:
            role = role_by_name(path)
            if role is not None:
                chosen.setdefault(role, path)
    loaded = {role: _readable(path, lambda p: read_table(spark, p, types=COLUMN_TYPES[role]))
              for role, path in chosen.items()}
    return {role: df for role, df in loaded.items() if df is not None}


def _columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header of a CSV file or the schema of another one."""
    if path.rstrip("/").lower().endswith(".csv"):
        return spark.read.option("header", True).csv(path).columns
    return read_table(spark, path).columns


def _readable(path: str, read):
    """What ``read`` makes of the path, or None with a warning if there is no table in it."""
    try:
        return read(path)
    except ValueError as e:
        warnings.warn(f"left out {path}: {e}", stacklevel=3)
    except PySparkException as e:
        if not str(e.getCondition() or "").startswith(NO_TABLE):
            raise
        warnings.warn(f"left out {path}: {e.getCondition()}", stacklevel=3)
    return None


def rows_per_role(tables: dict[str, DataFrame]) -> DataFrame:
    """Bound roles with their row counts."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(role).alias("role"), "rows")
        for role, df in tables.items()])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", missing: str = "", compression: str = "none") -> None:
    """CSV with header; one file per partition, timestamps without a zone, ``missing`` for missing cells.

    ``compression`` is one of Spark's, such as gzip; such a file is read by one task.
    """
    (df.write.mode(mode).option("header", True).option("nullValue", missing).option("compression", compression)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None,
                  mode: str = "errorifexists") -> None:
    """Parquet; a master table partitioned by date lets date filters prune folders."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
