import zlib

import numpy as np
from pyspark.sql import functions as F

from daybeat.llm import quality_model as q
from daybeat.llm.catalog import QUERIES
from tests.llm.fixtures import documents, prose

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_all_documents(spark):
    found = {r.doc_id: r for r in QUERIES["op2_quality_model"](spark, MIDDLE).collect()}
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(found[x.doc_id], x.quality) for x in labels if found[x.doc_id].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.93
    good, bad = ([r.score for r, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_context_sums_equal_a_direct_count():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 2, 40)]
    places, signs = q.index_vectors()
    want = np.zeros((q.SLOTS, q.DIMENSIONS))
    for own in texts:
        for i in range(len(own)):
            for j in range(max(0, i - q.REACH), min(len(own), i + q.REACH + 1)):
                if i != j:
                    np.add.at(want[own[i]], places[own[j]], signs[own[j]])
    assert np.array_equal(q.context_sums(texts), want)


def test_word_vectors_do_not_depend_on_partitions(spark):
    df = documents(spark)
    assert np.array_equal(q.word_vectors(df.coalesce(1)), q.word_vectors(df.repartition(5)))


def test_awkward_rows_get_scores(spark):
    df = documents(spark, [None, "", *[prose(80, k) for k in range(30)], *["zz " * 90] * 8]).withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(k, int(k < 30), None) for k in range(40)] + [(None, 1, 0), (3, None, 0), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    found = q.classify(df, labels).collect()
    assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, r.score) == r.score


def test_empty_tables_and_one_class(spark):
    df, none = documents(spark), spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r.score, 6) for r in q.classify(df, none).collect()} == {0.5}
    assert q.classify(df.limit(0), none).count() == 0
    one = spark.createDataFrame([(k, 1) for k in range(18)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in q.classify(df, one).collect())


def test_temperature_lowers_overconfidence():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = (rng.random(600) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = q.fit(x, y)
    assert net.temperature > 0.5 and ((net.probabilities(x) > 0.5) == (y > 0.5)).mean() > 0.6


def test_accepted_keeps_columns(spark):
    labels = spark.createDataFrame([(k, 1) for k in range(18)], "doc_id long, quality int")
    df = documents(spark)
    assert q.accepted(df, labels).schema == df.schema
