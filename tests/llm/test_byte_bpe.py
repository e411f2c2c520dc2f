import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from daybeat.llm import byte_bpe
from daybeat.llm.catalog import QUERIES, VOCABULARY
from tests.llm.fixtures import documents

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_those_of_the_rank_file(spark, reference):
    texts = ["", " ", "  two  spaces ", "\n a\n\nb ", "tab\t x", "a  b", "x\x85 y", "end ", " start", "don't  I'll",
             "<|endoftext|> is text", "a b c", "é ż 日本 🙂", "word\x1c next", "nul\x00 byte", "a​ b", "... !!! ??"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in byte_bpe.encode(df, VOCABULARY).collect():
        assert r.ids == reference.encode_ordinary(r.text), repr(r.text)


def test_query_equals_the_rank_file_on_all_documents(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op7_byte_bpe"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows_decode_to_themselves_and_columns_are_replaced(spark):
    df = documents(spark).withColumn("ids", F.lit("own"))
    coded = byte_bpe.encode(df, VOCABULARY, offsets=True)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "starts", "ends"]
    found = byte_bpe.decode(coded, VOCABULARY).collect()
    assert len(found) == df.count()
    for r in found:
        assert r.decoded_text == (r.text or "")
        text = r.text or ""
        for start, end in zip(r.starts, r.ends):
            assert 0 <= start < end <= len(text)
        assert not r.ids or (r.starts[0] == 0 and r.ends[-1] == len(text))


def test_split_characters_and_unknown_ids(spark):
    coded = byte_bpe.encode(spark.createDataFrame([(1, "日")], "doc_id long, text string"), VOCABULARY).first()
    assert len(coded.ids) > 1
    rows = [(1, coded.ids[:1]), (2, coded.ids), (3, None), (4, []), (5, [10 ** 6, None])]
    found = {r.doc_id: r for r in byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"),
                                                  VOCABULARY).collect()}
    assert found[1].decoded_text == "�" and found[2].decoded_text == "日"
    assert found[3].decoded is None and found[4].decoded == b"" and found[5].decoded == b""


def test_empty_table(spark):
    assert byte_bpe.encode(documents(spark).limit(0), VOCABULARY, decoded=True).count() == 0


@pytest.mark.parametrize("most, longest, together", [(3, 64, 2), (250_000, 3, 4_096), (0, 0, 1)])
def test_forgetting_changes_nothing(reference, monkeypatch, most, longest, together):
    monkeypatch.setattr(byte_bpe, "TOGETHER", together)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", most)
    monkeypatch.setattr(byte_bpe, "REMEMBERED_LENGTH", longest)
    encoder = byte_bpe._Encoder(VOCABULARY)
    for texts in (["one two three four five six", "", "two three seven"], ["eight nine nine eight", "one"], [], ["one one one"]):
        assert [x.tolist() for x in encoder.ids(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_long_unspaced_texts_are_not_remembered(reference):
    encoder = byte_bpe._Encoder(VOCABULARY)
    texts = ["漢字仮名" * 500 + str(k) for k in range(20)] + ["short " + "x" * 300]
    assert [x.tolist() for x in encoder.ids(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert not encoder.recent
    encoder.ids(["a short one " + "x" * 300])
    assert set(encoder.recent) == {"short", "one"}
