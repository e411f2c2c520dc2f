import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybeat.llm import lm_score as lm
from tests.llm.fixtures import awkward_texts, documents, prose


def brute(texts):
    words = {k: (t or "").encode().lower().split() for k, t in texts.items()}
    one = Counter(w for own in words.values() for w in own)
    two = Counter(x for own in words.values() for x in zip(own, own[1:]))
    context = Counter(w for own in words.values() for w in own[:-1])
    size, out = sum(one.values()), {}
    for k, own in words.items():
        o1, o2, oc, score, backed = Counter(own), Counter(zip(own, own[1:])), Counter(own[:-1]), 0.0, 0
        for i, w in enumerate(own):
            pair = (own[i - 1], w) if i else None
            if pair and two[pair] > o2[pair]:
                score += math.log((two[pair] - o2[pair]) / (context[own[i - 1]] - oc[own[i - 1]]))
            else:
                backed += 1
                score += (math.log(lm.BACKOFF) if i else 0) + math.log(max(one[w] - o1[w], lm.UNSEEN) / max(size - len(own), 1))
        out[k] = (len(own), backed, score)
    return out


def check(df, texts):
    found = {r.doc_id: r for r in lm.score(df).collect()}
    want = brute(texts)
    assert set(found) == set(want)
    for k, (n, backed, score) in want.items():
        r = found[k]
        assert (r.n_words, r.n_backed_off) == (n, backed), k
        assert r.log_score == pytest.approx(score, rel=1e-9, abs=1e-6)
        assert r.mean_log_score is None if n == 0 else r.mean_log_score == pytest.approx(score / n, rel=1e-9)


@pytest.mark.parametrize("words, hot_share", [(2_500_000, 1000), (500, 1000), (300, 20)])
def test_scores_equal_brute_force(spark, monkeypatch, words, hot_share):
    """One partition; many; many with hot words dealt out."""
    monkeypatch.setattr(lm, "PARTITION_WORDS", words)
    monkeypatch.setattr(lm, "HOT_SHARE", hot_share)
    texts = {k: t for k, t in enumerate([*awkward_texts(), *["the end of the day " * 9 + prose(60, k, 50) for k in range(30)]])
             if t is None or len(t) < 100_000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("value", F.lit("own"))
    check(df.repartition(4), texts)


def test_repeated_rows_and_null_ids(spark):
    df = documents(spark)
    found = lm.score(df).collect()
    assert len(found) == df.count()
    assert sum(r.doc_id is None for r in found) == 1 and sum(r.doc_id == 7 for r in found) == 2


def test_empty_table(spark):
    assert lm.score(documents(spark).limit(0)).count() == 0
    assert [r.log_score for r in lm.score(documents(spark, [None] * 8).filter("doc_id is not null")).collect()] == [0.0] * 9
