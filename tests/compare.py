"""Side-by-side run of registered queries and their SQL.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("daybeat-tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            Counter(tuple(f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in rows))


def compare(df, relation) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if have[0] != want[0]:
        return f"columns {have[0]} != {want[0]}"
    missing, extra = want[1] - have[1], have[1] - want[1]
    if missing or extra:
        return (f"rows {sum(have[1].values())} vs {sum(want[1].values())}, "
                f"{sum(missing.values())} differ: spark {list(extra)[:2]} sql {list(missing)[:2]}")
    return None


def main(args: list[str]) -> int:
    import __spark_entry__ as entry
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con, bad = session(), connect(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in args[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                spark_rows = df.collect()
                mid = time.time()
                problem = compare(df.sparkSession.createDataFrame(spark_rows, df.schema), con.sql(oracles[name]))
            else:
                spark_rows, problem, mid = df.collect(), None, time.time()
        except Exception as e:      # noqa: BLE001 - reported, the next query still runs
            problem, mid, spark_rows = f"{type(e).__name__}: {str(e)[:600]}", time.time(), []
        bad += problem is not None
        state = "FAIL" if problem else "ok" if name in oracles else "rows"
        print(f"{state:5}{name:28}{len(spark_rows):8} rows {mid - start:6.2f}s sql {time.time() - mid:6.2f}s "
              f"{problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
