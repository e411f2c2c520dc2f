import re

from pyspark.sql import functions as F

from daybeat.llm import quality_rules as q
from tests.llm.fixtures import documents


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = list(zip(words, words[1:], words[2:]))
    covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)} if len(words) < 5000 else set()
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_statistics_of_awkward_rows(spark):
    df = documents(spark).withColumn("kept", F.lit("own"))
    found = q.apply_cascade(df).collect()
    assert len(found) == df.count()
    for r in found:
        if r.n_words < 5000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.rejected_by is None) and (r.kept or r.rejected_by) and not (r.kept and r.base_failed)


def test_each_rule_rejects_its_junk_and_prose_stays(spark):
    plain = " ".join(f"word{k}" for k in range(100))
    junk = {"symbols": plain.replace(" ", "$ "), "shouting": plain.upper(), "word_length": plain.replace("word", "x" * 40),
            "letterless": " ".join(str(k) for k in range(100, 200)),
            "repeated_lines": "\n".join([f"line {k} {'abcdefghij'[k % 2]}" for k in range(30)] + ["same"] * 60)}
    texts = [plain, *junk.values()]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    by = {r.doc_id: r.rejected_by for r in q.apply_cascade(df).collect()}
    assert by == {0: None} | {k + 1: name for k, name in enumerate(junk)}


def test_verdict_does_not_depend_on_the_order(spark, monkeypatch):
    want = {r.doc_id: r.kept for r in q.apply_cascade(documents(spark)).collect()}
    monkeypatch.setattr(q, "ordered", lambda rules, measured: tuple(reversed(rules)))
    assert {r.doc_id: r.kept for r in q.apply_cascade(documents(spark)).collect()} == want


def test_order_by_rejection_per_cost():
    rules = tuple(q.Rule(n, lambda t: False) for n in "abcd")
    measured = {"a": (1.0, 0.5), "b": (0.1, 0.4), "c": (0.2, 0.0), "d": (0.1, 0.0)}
    assert [r.name for r in q.ordered(rules, measured)] == ["b", "a", "d", "c"]


def test_empty_table(spark):
    assert q.apply_cascade(documents(spark).limit(0)).count() == 0
