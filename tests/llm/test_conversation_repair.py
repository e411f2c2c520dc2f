import functools
import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from daybeat.llm import conversation_repair as C
from daybeat.llm.catalog import ORACLES, QUERIES
from tests.compare import compare, connect

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def plain_edits(rows):
    """(cost, audit, lines) of the least edits of (role, text, kind) rows, trying everything from each place."""
    @functools.cache
    def row(at, state):
        found = [(0, "", ())] if at == len(rows) and state in "0a" else []
        if at < len(rows):
            role, text, kind = rows[at]
            cost, audit, lines = whole(at + 1, state)
            found.append((2 + cost, "D" + audit, lines))
            for letter, new in (("K", role), ("R", "user"), ("R", "assistant")):
                then = new[:1]
                if kind != "gone" and (state + then) in ("0s", "0u", "su", "ua", "au"):
                    cost, audit, lines = whole(at + 1, then)
                    found.append((cost + (letter == "R") + 5 * (kind == "truncated"), letter + audit, (f"{new}:{text}", *lines)))
        return min(found, default=(10 ** 6, "", ()))

    @functools.cache
    def whole(at, state, room=2):
        """With rows put in before the place; two are as many as ever help."""
        found = [row(at, state)]
        for new in ("user", "assistant"):
            if room and state + new[0] in ("0u", "su", "ua", "au"):
                cost, audit, lines = whole(at, new[0], room - 1)
                found.append((5 + cost, "I" + audit, (f"{new}:", *lines)))
        return min(found)

    for at in range(len(rows), 0, -20):         # from the end, so that calls stay shallow
        for state in "0sua":
            whole(at, state)
    return whole(0, "0")


def plain(table):
    by = defaultdict(list)
    for conv, turn, role, text in table:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text, rows = " " if role is None else role, " " if text is None else text, by[conv]
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [] if kind == 0 else [(turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text)] * (
            2 if kind == 3 else 1)
    out = {}
    for conv, rows in by.items():
        rows.sort()
        seen, marked, counts = set(), [], defaultdict(int)
        for _, _, role, _, text in rows:
            end = text.rstrip(WHITE)
            fault = ("blank" if not end else "duplicate" if (role, text) in seen else
                     "truncated" if end[-1] not in ".!?" else "")
            counts[fault] += 1
            seen.add((role, text))
            marked.append((role, text, "gone" if fault in ("blank", "duplicate") else fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        turns = {r[1] for r in rows if r[0]}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = plain_edits(marked)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


def rough_table(seed, conversations, most):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        for k in range(rng.randrange(most)):
            turn = rng.choice([None, k, k, k, k + rng.randrange(9), -k])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "u"])
            text = rng.choice(["Yes.", "No!", "why?", "cut off", "", " \n\t", None, "x. \r\n", f"row {k}.", f"row {k}", "a\x85", "¿é?"])
            rows += [(None if conv == 0 else conv, turn, role, text)] * rng.choice([1, 1, 1, 1, 2])
    return rows


def test_few_vectors_and_blocks_equal_single_steps():
    tables = C.Tables(3)
    assert len(tables.vectors) < 60 and all(min(v) == 0 for v in tables.vectors)
    rng = random.Random(1)
    for size in (0, 1, 2, 3, 4, 7, 50):
        symbols = bytes(rng.randrange(C.SYMBOLS) for _ in range(size))
        to, adds = tables.through(symbols)
        for vector in range(len(tables.vectors)):
            at, cost = vector, 0
            for symbol in reversed(symbols):
                at, more = tables.single[at][symbol]
                cost += more
            assert (at, cost) == (to[vector], adds[vector])


@pytest.mark.parametrize("seed", range(40))
def test_traces_equal_trying_everything(seed):
    rng, tables = random.Random(seed), C.tables()
    rows = [(rng.choice(["system", "user", "assistant", "tool"]), str(k), rng.choice(["", "", "truncated", "gone"]))
            for k in range(rng.randrange(1, 14))]
    symbols = bytes(C.GONE if kind == "gone" else "suat".index(role[0]) + 4 * (kind == "truncated") for role, _, kind in rows)
    to, adds = tables.through(symbols)
    cost, audit, lines = plain_edits(rows)
    assert adds[0] + tables.vectors[to[0]][C.START] == cost
    (letters, state), = tables.trace(symbols, 0, [C.START])
    assert letters + tables.closing(state) == audit
    stream = [(1, 0, "", audit), *((1, 1, role, text) for role, text, _ in rows)]
    assert [f"{role}:{text}" for _, _, role, text in C.edited(iter(stream))] == list(lines)
    # In two parts, with the vector that stands between them.
    cut = rng.randrange(len(symbols) + 1)
    (first, between), = tables.trace(symbols[:cut], int(tables.through(symbols[cut:])[0][0]), [C.START])
    (second, end), = tables.trace(symbols[cut:], 0, [between])
    assert first + second + tables.closing(end) == audit


@pytest.mark.parametrize("seed", [1, 2])
def test_rough_conversations_equal_plain_and_sql(spark, seed):
    rows = rough_table(seed, 60, 14)
    found = C.repair(spark.createDataFrame(rows, SCHEMA))
    assert results(found) == plain(rows)
    con = duckdb.connect()
    con.register("rows", spark.createDataFrame(rows, SCHEMA).toArrow())
    con.execute("CREATE VIEW conversations AS SELECT * FROM rows")
    assert compare(found, con.sql(ORACLES["op12_conversation_repair"])) is None


def test_long_conversations_in_small_chunks(spark, monkeypatch):
    rows = rough_table(3, 3, 400)
    want = C.repair(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert results(want) == plain(rows)
    chunks = list(C.chunks(iter([(1, k // 2, "user", str(k % 7), False, k % 3 == 0, k >= 14) for k in range(200_000)])))
    assert [len(c.symbols) for c in chunks] == [C.CHUNK] * 3 + [200_000 - 3 * C.CHUNK]
    tables, vector, parts = C.tables(), 0, []
    for c in reversed(chunks):
        parts.append((bytes(c.symbols), vector))
        vector = int(tables.through(bytes(c.symbols))[0][vector])
    state, audit = C.START, ""
    for symbols, behind in reversed(parts):
        (letters, state), = tables.trace(symbols, behind, [state])
        audit += letters
    (whole, end), = tables.trace(b"".join(bytes(c.symbols) for c in chunks), 0, [C.START])
    assert (audit, state) == (whole, end)


def test_chunks_of_a_conversation_meet(spark, monkeypatch):
    """Range partitions cut conversations, so heads, tails and turns meet at the borders."""
    rows = [(7, k // 3, "user" if k % 2 else "assistant", f"{k}." if k % 5 else "again.") for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = results(C.repair(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == plain(rows)


def test_query_equals_sql_and_plain(spark):
    found = QUERIES["op12_conversation_repair"](spark, SMALL)
    assert compare(found, connect(SMALL).sql(ORACLES["op12_conversation_repair"])) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(found) == plain(rows)


def test_repaired_rows(spark):
    rows = rough_table(4, 30, 9)
    damaged = C.damaged(spark.createDataFrame(rows, SCHEMA))
    audits = C.keep(C.repairs(C.facts(damaged)))
    lines = defaultdict(list)
    for r in sorted(C.repaired(damaged, audits).collect(), key=lambda r: r.place):
        assert r.place == len(lines[r.conv])
        lines[r.conv].append(f"{r.role}:{r.text}")
    for conv, row in plain(rows).items():
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == row[-1]


def test_empty_tables_other_columns_and_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(empty).count() == 0
    rows = rough_table(5, 20, 6)
    clashing = (spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("own")).withColumn("conv", F.lit(3))
                .withColumn("kind", F.lit(0)).withColumnRenamed("conv_id", "place"))
    found = C.repair(clashing, conv="place")
    assert results(found.withColumnRenamed("place", "conv_id")) == plain(rows)
    # All rows of the conversations dropped by damage.
    gone = [(c, t, "user", "Yes.") for c in range(200) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(results(C.repair(spark.createDataFrame(gone, SCHEMA))).values()) == {nothing}
