from collections import Counter, defaultdict

from pyspark.sql import functions as F

from daybeat.llm import mixing
from tests.llm.fixtures import documents, rows

SMALL = "/root/testdata/sf0.001"


def filled(sizes: dict) -> dict:
    """Targets by sharing again and again what capped sources cannot take."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        if not free:
            return full
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 3 * sizes[s] for s in over}


def check(df):
    found = mixing.mix(df).collect()
    assert len(found) == df.count()
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source].append(r)
    want = filled({s: sum(r.size for r in own) for s, own in by_source.items()})
    for source, own in by_source.items():
        size = sum(r.size for r in own)
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(size, round(want[source], 6))}
        assert all(r.taken == r.size * (r.epochs + r.extra) <= 3 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= max(r.size for r in own) / 2 + 1e-6
    return found


def test_targets_and_taken_words(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))
    check(documents(spark))


def test_skewed_sources(spark):
    texts = [("src9", "a b c " * 400)] + [("src1", "x y")] * 5 + [(None, "n")] * 3 + [("src2", None), ("src3", "")]
    check(spark.createDataFrame([(k, t, s) for k, (s, t) in enumerate(texts)], "doc_id long, text string, source string"))


def test_cut_falls_in_key_order(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = rows(mixing.mix(df))
    monkeypatch.setattr(mixing, "BUCKETS", 3)
    assert rows(mixing.mix(df)) == want
    assert rows(mixing.mix(df.repartition(7))) == want


def test_mixed_rows_are_the_taken_ones(spark):
    df = documents(spark)
    times = Counter()
    for r in mixing.mix(df).collect():
        times[r.doc_id] += r.epochs + r.extra if r.size else 0
    out = mixing.mixed(df)
    assert out.schema == df.schema
    assert Counter(r.doc_id for r in out.collect()) == +times


def test_heavier_weights_come_earlier(spark):
    df = spark.createDataFrame([(k, "w", "a", k % 2) for k in range(2000)] + [(k, "w w w", "b", 0) for k in range(2000, 2400)],
                               "doc_id long, text string, source string, good int")
    weight = F.when(F.col("good") == 1, 4.0).otherwise(1.0)
    found = mixing.mix(df, weight=weight, carried=("good",)).filter("source = 'a' and extra")
    taken = Counter(r.good for r in found.collect())
    assert taken[1] > 1.3 * taken[0]


def test_empty_table(spark):
    assert mixing.mix(documents(spark).limit(0)).count() == 0
    assert mixing.mixed(documents(spark).limit(0)).count() == 0
