import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from daybeat.llm import token_alignment as A
from daybeat.llm.byte_bpe import byte_characters
from daybeat.llm.catalog import PIECES, QUERIES, VOCABULARY
from tests.llm.fixtures import awkward_texts, documents

SMALL = "/root/testdata/sf0.001"
ODD = ["two  spaces", " lead", "trail ", "\ttab\n\n line \n", "a▁b", "▁", "<|endoftext|> <s> </s> <unk> <0x41>",
       "nul\x00 byte", "é ż 日本 🙂👩‍👩‍👧‍👦", "a\x85b c\xa0d e　f g\x1ch", "    ", "x" * 3000, "日本語" * 500, "\r\n\r\n x",
       "one​ two", "﻿ bom", "a .. b ,, (c)", "é ́x"]


def tokens(text, tokenizer, pieces):
    """Ids and bytes of both sides of a whole text, cut nowhere; empty if they do not give the text back."""
    if not text:
        return [], [], [], []
    table = byte_characters()
    found = tokenizer.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(table[c] for c in t) for t in found.tokens]
    ids_b, bytes_b = pieces.encode(text, num_threads=1), []
    for i in ids_b:
        t = pieces.id_to_piece(i)
        bytes_b.append(bytes([int(t[3:-1], 16)]) if pieces.is_byte(i) else t.replace("▁", " ").encode())
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    return found.ids, bytes_a, ids_b, bytes_b


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """All columns by walking over the bytes and comparing all tokens nearby."""
    tokenizer, pieces = Tokenizer.from_file(VOCABULARY), SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True
    rows, holds = [], Counter()
    for text in texts:
        ids_a, bytes_a, ids_b, bytes_b = tokens(text, tokenizer, pieces)
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        both = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups = ";".join(",".join(str(i) for i, (_, e) in zip(ids_a, spans_a) if low < e <= high) + "|"
                          + ",".join(str(i) for i, (_, e) in zip(ids_b, spans_b) if low < e <= high)
                          for low, high in zip([0, *both], both)) if len(ids_a) < 4000 else None
        links, first = [], 0
        for i, (s, e) in zip(ids_a, spans_a):
            while first < len(spans_b) and spans_b[first][1] <= s:
                first += 1
            at = first
            while at < len(spans_b) and spans_b[at][0] < e:
                links.append((i, ids_b[at]))
                at += 1
        holds.update(set(links))
        rows.append((len(ids_a), len(ids_b), len(both), links, groups))
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    return [(n_a, n_b, n_groups, len(links), sum(holds[x] == most[x[0]] for x in links), sum(holds[x] for x in links),
             groups) for n_a, n_b, n_groups, links, groups in rows]


def leaves(a, b):
    a, b = np.array(a), np.array(b)
    return A.leaves(a, b, np.array([len(a)]), np.array([len(b)])).T.tolist()


@pytest.mark.parametrize("seed", range(30))
def test_leaves_are_the_intervals_between_shared_ends(seed):
    rng, end = random.Random(seed), 400
    a, b = (sorted({*rng.sample(range(1, end), rng.randrange(0, 300)), end}) for _ in range(2))
    found, both = leaves(a, b), sorted(set(a) & set(b))
    assert [(a[g[1] - 1], b[g[3] - 1]) for g in found] == [(e, e) for e in both]
    assert [g[0] for g in found] == [0, *(g[1] for g in found[:-1])] and [g[2] for g in found] == [0, *(g[3] for g in found[:-1])]
    starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
    assert set(zip(*map(np.ndarray.tolist, A.overlaps(np.array(a), np.array(b))))) == {
        (i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]}


def test_long_stretches_without_cuts():
    a, b = list(range(1, 2_000_001, 2)) + [2_000_002], list(range(2, 2_000_003, 2))
    assert leaves(a, b) == [[0, len(a), 0, len(b)]]
    assert len(leaves(a, a)) == len(a)
    assert len(leaves([*a, *range(a[-1] + 1, a[-1] + 500)], [*b, *range(a[-1] + 1, a[-1] + 500)])) == 500


def check(found, texts):
    want = plain(texts)
    for r, text, w in zip(found, texts, want):
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6], repr(text)[:80]
        assert r.n_links == r.n_a + r.n_b - r.n_groups
        if w[6] is not None:
            assert r.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else ""), repr(text)[:80]


def test_query_equals_plain_walk_over_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op11_token_alignment"](spark, SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == sorted(texts)
    check(found, [texts[k] for k in sorted(texts)])


@pytest.mark.parametrize("hot, memory, longest", [(1 << 16, 1 << 24, 64), (1, 1, 3), (40, 1, 0)])
def test_awkward_texts_whatever_is_hot_or_remembered(spark, monkeypatch, hot, memory, longest):
    monkeypatch.setattr(A, "HOT_PAIRS", hot)
    texts = awkward_texts() + ODD + ["Wörter und words"] * 3
    A._aligner.cache_clear()
    aligner = A._aligner(VOCABULARY, PIECES)
    monkeypatch.setattr(A, "REMEMBERED_BYTES", memory)
    monkeypatch.setattr(A, "LONGEST", longest)
    assert len(list(aligner.texts([(t or "").encode() for t in texts]))) == len(texts)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = A.weigh(A.align(df, VOCABULARY, PIECES).withColumn("groups_sha256", digest)).orderBy("doc_id").collect()
    check(found, texts)


def test_groups_as_ids_and_clashing_columns(spark):
    df = documents(spark).withColumn("groups", F.lit(1)).withColumn("pair", F.lit("own")).withColumn("row", F.lit(2))
    found = A.weigh(A.align(df, VOCABULARY, PIECES).withColumn("ids", A.group_ids()))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "pair", "row", "n_a", "n_b", "n_groups",
                             "n_links", "groups", "ids", "n_best", "count_sum"]
    rows = found.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert (r.pair, r.row) == ("own", 2) and len(r.ids) == r.n_groups
        assert sum(len(g.a) for g in r.ids) == r.n_a and sum(len(g.b) for g in r.ids) == r.n_b
        assert ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.ids) == r.groups


def test_empty_table(spark):
    assert A.weigh(A.align(documents(spark).limit(0), VOCABULARY, PIECES)).count() == 0


def test_parts_in_use_outlive_the_memory(monkeypatch):
    """Parts that every batch holds are learned once, while others come and are forgotten."""
    monkeypatch.setattr(A, "REMEMBERED_BYTES", 480 * 200)
    aligner, learned = A._Aligner(VOCABULARY, PIECES), []
    learn = aligner.learn
    monkeypatch.setattr(aligner, "learn", lambda parts, out: (learned.extend(parts), learn(parts, out))[1])
    usual = " ".join(f"usual{k}" for k in range(40))
    for batch in range(12):
        own = usual + " " + " ".join(f"own{batch}word{k}" for k in range(40))
        (parts,) = aligner.texts([own.encode()])
        assert b"".join(aligner.bytes_a[int(k)] for p in parts for g in p.form.split(";") for k in g.split("|")[0].split(",")) == f" {own}".encode()
        assert [p.n_groups for p in parts] == [p.form.count("|") for p in parts]
    assert len(learned) == 40 + 12 * 40 and len(aligner.known) + len(aligner.older) <= 400
