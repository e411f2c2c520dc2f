import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybeat.llm import language_id as L
from daybeat.llm.catalog import QUERIES
from tests.llm.fixtures import awkward_texts, documents

SCALE = "/root/testdata/sf0.01"
WORDS = {"aa": "abada bacada daba caba", "bb": "mino nimo onim pimon", "cc": "zutu tuzu vutzu zuv",
         "dd": "kelke lekle fekel elkef"}


def speech(lang, words, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(words))


def plain_grams(text):
    """Letters and gaps one by one: the grams, not hashed."""
    text = f"\n{text.lower()}\n"
    kept = [c if c.isalpha() else "" for k, c in enumerate(text)
            if c.isalpha() or text[k - 1:k].isalpha() or text[k + 1:k + 2].isalpha()]
    return Counter(tuple(kept[k:k + n]) for n in L.ORDERS for k in range(len(kept) - n + 1))


def slot_of(gram):
    key = len(gram)
    for c, odd in zip(gram, L._ODD.tolist()):
        key = (key + (ord(c) if c else 0) * odd) % 2 ** 32
        key ^= key >> 15
    return key * int(L._MIX) % 2 ** 32 >> 32 - L.SLOT_BITS


def test_counts_equal_plain_counting_of_any_batch():
    texts = [t or "" for t in awkward_texts() if len(t or "") < 5000]
    found = dict(L.gram_counts([t.encode() for t in texts]))
    for k, text in enumerate(texts):
        want = np.zeros(L.SLOTS, np.int64)
        for gram, n in plain_grams(text).items():
            want[slot_of(gram)] += n
        assert (found[k] == want).all() if k in found else not any(map(str.isalpha, text))
    for k, counts in found.items():
        assert (dict(L.gram_counts([texts[k].encode()]))[0] == counts).all()


def test_long_texts_come_in_parts(monkeypatch):
    monkeypatch.setattr(L, "_STRETCH", 50)
    text = speech("aa", 200, 1)
    weights = np.random.default_rng(2).integers(-9, 9, (L.SLOTS, 3)).astype(float)
    sizes, sums = L.evidence([text.encode(), b"", b"ab"], weights)
    parts = [text[k:k + 50] for k in range(0, len(text), 50)]
    apart = [L.evidence([p.encode()], weights) for p in parts]
    assert sizes[0] == sum(a[0][0] for a in apart) and sizes[1] == 0
    assert (sums[0] == sum(a[1][0] for a in apart)).all()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 6, 7, 20, 90])
def test_codewords_differ(n):
    code = L.codewords(n)
    assert code.shape[0] == n and (n < 2) == (code.shape[1] == 0)
    for a in range(n):
        for b in range(a):
            assert (code[a] != code[b]).sum() >= (1 if n < 4 else 4)
    assert all(abs(column.sum()) < n for column in code.T)


def test_one_wrong_bit_is_corrected():
    code = L.codewords(4)
    bits = code.shape[1]
    model = L.Model(list("abcd"), code, np.zeros((L.SLOTS, bits)), np.ones(bits), np.zeros(bits), np.ones(code.shape))
    for lang in range(4):
        for wrong in range(bits):
            seen = 3 * code[lang]
            seen[wrong] *= -1
            assert model.probabilities(seen).argmax() == lang


def test_bit_weights_equal_plain_sums():
    counts = np.random.default_rng(3).integers(0, 50, (3, L.SLOTS))
    code = L.codewords(3)
    found, share = L.bit_weights(counts, code), (counts + .5) / (counts + .5).sum(axis=1, keepdims=True)
    for bit in range(code.shape[1]):
        up, down = share[code[:, bit] > 0].mean(axis=0), share[code[:, bit] < 0].mean(axis=0)
        assert np.abs(found[:, bit] / L.UNIT - np.log(up / down)).max() < 1 / L.UNIT


def test_learned_counts_are_those_of_all_rows_that_are_not_held_out(spark):
    rows = [(k, speech(lang, 5 + k % 7, k), lang) for k in range(60) for lang in [list(WORDS)[k % 3]]]
    rows += [(100, None, "aa"), (101, "123 !", "aa"), (102, "abada", None), (None, "abada abada", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs.filter(L.remainder() != 0))
    assert model.languages == ["aa", "bb", "cc"]
    totals = np.zeros((3, L.SLOTS), np.int64)
    for id, text, lang in rows:
        if id is not None and lang and zlib.crc32(str(id).encode()) % 5:
            for _, counts in L.gram_counts([(text or "").encode()]):
                totals[model.languages.index(lang)] += counts
    assert (model.weights == L.bit_weights(totals, model.code)).all()
    few = L._LOCAL
    L._LOCAL = 1
    try:
        assert (L.train(docs.filter(L.remainder() != 0)).weights == model.weights).all()
    finally:
        L._LOCAL = few


def test_awkward_rows_and_columns(spark):
    docs = (documents(spark).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").otherwise(F.col("lang")))
            .withColumn("score", F.lit("own")).withColumn("lang_pred", F.lit(1)))
    found = L.identify(docs).collect()
    assert len(found) == docs.count()
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.lang_pred in ("und", "en", "xx") and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.lang_pred != "und" or (r.score == 0 and r.ambiguous)


def test_tables_without_languages_or_rows(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(docs).collect()} == {"und"}
    assert L.identify(docs.limit(0)).count() == 0
    one = L.identify(documents(spark).withColumn("lang", F.lit("en"))).filter("lang_pred <> 'und'").collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0)}


def test_texts_between_languages_are_flagged(spark):
    rows = [(k, speech(lang, 30, k), lang) for k in range(200) for lang in [list(WORDS)[k % 4]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    mixed = [(1, speech("aa", 40, 900), "aa"), (2, "x", None)]
    found = {r.doc_id: r for r in
             L.predict(spark.createDataFrame(mixed, "doc_id long, text string, lang string"), model).collect()}
    assert found[1].lang_pred == "aa" and not found[1].ambiguous and found[1].score > 0.9
    assert found[2].score < found[1].score and found[2].ambiguous


def test_query_is_right_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SCALE}/documents.parquet").collect()}
    found = QUERIES["op13_language_id"](spark, SCALE).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert len(held) > 100
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) >= 0.99
