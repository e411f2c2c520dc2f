from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from daybeat.llm import minhash, mixing, passages, quality_model
from daybeat.llm.catalog import ORACLES, QUERIES
from daybeat.session import keep
from tests.compare import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES)


def test_queries_equal_their_sql(spark):
    con = connect(SMALL)
    for name, sql in ORACLES.items():
        assert compare(QUERIES[name](spark, SMALL), con.sql(sql)) is None, name


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    after = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after[name] = keep(stage(spark, before, SMALL))
        assert after[name].columns[:len(columns)] == columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after[name].columns == columns
        before = after[name]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    chosen = quality_model.classify(docs, labels).filter("predicted = 1")
    assert ids(after["quality classifier"]) == ids(chosen)
    # Clean labelled documents stay, most of the others go.
    good, bad = (labels.filter(f"quality = {k}").join(docs, "doc_id") for k in (1, 0))
    kept = ids(after["quality classifier"])
    assert sum(i in kept for i in ids(good)) >= 0.97 * good.count() and sum(i in kept for i in ids(bad)) <= 0.4 * bad.count()
    near = minhash.near_duplicates(after["quality classifier"])
    assert ids(after["near duplicates"]) == ids(near.filter("kept"))
    cut = {r.doc_id for r in passages.repeated_passages(after["near duplicates"]).collect()}
    old, new = ({r.doc_id: r.text for r in after[n].collect()} for n in ("near duplicates", "repeated passages"))
    assert {i for i in old if old[i] != new[i]} == cut
    taken = Counter()
    for r in mixing.mix(after["repeated passages"]).collect():
        taken[r.doc_id] += r.epochs + r.extra if r.size else 0
    assert ids(after["mixture"]) == +taken
    out = after["tokens"].collect()
    assert out and all(r.round_trip and r.n_tokens == len(r.ids) for r in out)


def test_awkward_documents_run_through(spark):
    from tests.llm.fixtures import documents
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SMALL))
    assert docs.count() > 0 and docs.filter("not round_trip").isEmpty()
