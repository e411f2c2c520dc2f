"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession

# Timestamps are naive local times, so text must parse without a zone shift.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Expanding steps start from small shuffles; keep one task per core for those too.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; cluster sizing is left alone."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new path that driver and executors share, deleted when the session's JVM ends.

    It lies under ``spark.checkpoint.dir``, else the context's checkpoint folder, else the
    warehouse: Spark's own settings for storage that every executor sees.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir"))
    path = f"{base.rstrip('/')}/daybeat-{uuid.uuid4().hex}"
    _file_system(spark, path).deleteOnExit(_hadoop_path(spark, path))
    return path


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several jobs or an iteration: the lineage is cut, lost
    executors cost nothing, and later steps still get column pruning and size statistics.
    ``discard`` deletes the table once nothing reads it any more.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` wrote; results already read from them must be written."""
    for table in tables:
        path = getattr(table, "kept_at", None)
        if path:
            spark = table.sparkSession
            _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def one_row(df: DataFrame) -> Row:
    """The single row of an ungrouped aggregate: a fixed handful of numbers."""
    return df.first()


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
