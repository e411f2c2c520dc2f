"""Intermediate tables: where they lie and that they go."""

import os
from urllib.parse import urlparse

from daybeat.session import discard, keep, shared_folder


def place(path: str) -> str:
    return urlparse(path).path if "://" in path or path.startswith("file:") else path


def test_discarded_tables_are_gone(spark):
    df = spark.range(5)
    kept = keep(df)
    assert kept.schema.fieldNames() == ["id"] and kept.count() == 5
    assert os.path.isdir(place(kept.kept_at))
    discard(kept, df)
    assert not os.path.exists(place(kept.kept_at))


def test_tables_lie_where_spark_has_shared_storage(spark):
    known = [x for x in (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(),
                         spark.conf.get("spark.sql.warehouse.dir")) if x]
    assert shared_folder(spark).startswith(known[0].rstrip("/") + "/")


def test_no_machine_local_folder_in_the_package():
    root = os.path.join(os.path.dirname(os.path.dirname(__file__)), "daybeat")
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    text = f.read()
                assert "tempfile" not in text and "localCheckpoint" not in text, name
