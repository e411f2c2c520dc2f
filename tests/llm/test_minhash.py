from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from daybeat.llm import minhash as m
from daybeat.llm.components import components
from tests.llm.fixtures import awkward_texts, documents, edited, prose, smallest_reachable


def sets(text, shingle):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set()


def brute(texts: dict, shingle: int) -> dict:
    own = {i: sets(t, shingle) for i, t in texts.items()}
    links = [(a, b) for a, b in combinations(own, 2) if own[a] and own[b]
             and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])]
    return {i: (len(own[i]), c, i == c) for i, c in smallest_reachable(own, links).items()}


def found(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in m.near_duplicates(df, **options).collect()}


def test_awkward_rows_equal_brute_force(spark):
    df = documents(spark).withColumn("kept", F.lit("own")).withColumn("component_id", F.lit(9))
    for shingle in (4, 5):
        got = found(df, shingle=shingle)
        assert got.pop(None) == (1 if shingle >= 4 else 2, None, True)
        assert got == brute(dict(enumerate(awkward_texts())), shingle)
    assert m.near_duplicates(df).count() == df.count()


def variants():
    """Chains, hubs and groups around the threshold, ids in no order."""
    base = [prose(120, k, 5000) for k in range(3)]
    texts = [*base, *[edited(base[0], e, e) for e in range(25, 60)], *[edited(base[1], 34, 100 + k) for k in range(40)]]
    chain = base[2]
    for k in range(12):
        chain = edited(chain, 55, 300 + k)
        texts.append(chain)
    order = np.random.default_rng(5).permutation(len(texts))
    return {int(order[k]): t for k, t in enumerate(texts)}


def test_links_around_the_threshold_equal_brute_force(spark, monkeypatch):
    texts = variants()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute(texts, 5)
    assert found(df) == want
    # Many small tiles: every pair still meets somewhere.
    monkeypatch.setattr(m, "TILE", 700)
    assert found(df.repartition(5)) == want


def test_deduplicated_keeps_one_row_of_each_group(spark):
    df = documents(spark)
    out = m.deduplicated(df, shingle=4)
    assert out.schema == df.schema
    kept = [r.doc_id for r in out.collect()]
    want = [i for i, r in brute(dict(enumerate(awkward_texts())), 4).items() if r[2]]
    assert sorted(kept, key=str) == sorted([*want, None], key=str)


def test_empty_tables(spark):
    assert m.near_duplicates(documents(spark).limit(0)).count() == 0
    assert m.deduplicated(documents(spark, [None] * 8)).count() == 9


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    edges += [(5000, 5000 + k) for k in range(1, 300)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    want = smallest_reachable({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    """Three unlike texts under two ids stay; a near copy goes whatever id it shares."""
    unlike = [prose(120, 70 + k) for k in range(3)]
    rows = [(1, unlike[0]), (1, unlike[1]), (2, unlike[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, m.deduplicated(docs).collect())) == sorted(rows)
    more = rows + [(1, edited(unlike[2], 100, 1)), (3, unlike[0]), (3, prose(90, 80)), (None, unlike[0]), (None, None)]
    left = m.deduplicated(spark.createDataFrame(more, "doc_id long, text string"))
    want = [(1, unlike[0]), (1, unlike[1]), (1, edited(unlike[2], 100, 1)), (3, prose(90, 80)), (None, unlike[0]), (None, None)]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(want, key=repr)
