"""Repair of conversations: the cheapest edits after which roles alternate as they should.

Roles of a sound conversation spell ``(s?(ua)+)?``: nothing, or user and assistant in turn after at most
one system row. Edits keep, rerole, delete or insert rows. The costs of the rest of a conversation
from each of the four states of that pattern form a vector; without its least entry only a few
different vectors occur. So, as in the Four-Russians method, a table gives for every vector and every
block of a fixed number of row symbols the vector before the block and what the block adds. Rows are
looked up block by block from the last one to the first; blocks are then expanded with the vectors
behind them, and at each place the first letter in ASCII order that keeps the least cost is taken,
which makes the edits the ASCII-least of all cheapest ones.

A conversation is dealt with in chunks, each of which gives the vector before it for every vector
behind it; only those tables are walked through in order. Nothing but the hash of a repaired
conversation, which is read in order by definition, needs its texts in one place, row by row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import discard, keep

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
WHITE = " \t\n\x0b\x0c\r"
BLOCK = 4                       # symbols of one lookup
CHUNK = 1 << 16                 # rows whose symbols are one row of a table
START, SYSTEM, USER, ASSISTANT = range(4)       # states: what the roles so far end with
ENDS = (START, ASSISTANT)
INITIALS = "sua"
GONE = 8                        # symbol of a row that must go; others: initial, plus 4 if truncated
SYMBOLS = 9
_AFTER = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}

Vector = tuple[int, int, int, int]


def _inserted(costs: list[int]) -> list[int]:
    """Costs from each state when rows may be put in first."""
    costs = list(costs)
    for _ in range(2):
        for state in range(4):
            costs[state] = min(costs[state], INSERT + costs[ASSISTANT if state == USER else USER])
    return costs


def choices(symbol: int, after: list[int], state: int) -> list[tuple[int, str, int]]:
    """(cost, letter, next state) of what may be done with a row in a state, given the costs behind it."""
    out = [(DELETE + after[state], "D", state)]
    if symbol != GONE:
        extra, initial = (TRUNCATED if symbol >= 4 else 0), symbol % 4
        for role in range(3):
            there = _AFTER.get((state, role))
            if there is not None and role == initial:
                out.append((extra + after[there], "K", there))
            elif there is not None and role:
                out.append((extra + REROLE + after[there], "R", there))
    return out


def before(symbol: int, after: list[int]) -> list[int]:
    """Costs from each state before a row, given those behind it."""
    return _inserted([min(choices(symbol, after, state))[0] for state in range(4)])


class Tables:
    """Every vector that occurs, and what a symbol or a block of symbols makes of it."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.last: Vector = tuple(_inserted([0 if s in ENDS else 1 << 20 for s in range(4)]))
        self.vectors, self.single, self.moves = [self.last], [], []
        known = {self.last: 0}
        for vector in self.vectors:                  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                costs = before(symbol, vector)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((known[normal], least))
            self.single.append(row)
            self.moves.append([[self._move(symbol, vector, state) for state in range(4)] for symbol in range(SYMBOLS)])
        step = np.array(self.single)
        self.to, self.adds = step[:, :, 0], step[:, :, 1]
        to, adds = self.to, self.adds
        for _ in range(block - 1):                   # one symbol more in front
            adds = (adds[:, None, :] + self.adds[to].transpose(0, 2, 1)).reshape(len(to), -1)
            to = self.to[to].transpose(0, 2, 1).reshape(len(to), -1)
        self.block_to, self.block_adds = to, adds
        self.expanded: dict[tuple[int, bytes, int], tuple[str, int]] = {}

    @staticmethod
    def _move(symbol: int, after: Vector, state: int) -> tuple[str, int]:
        """Letters up to and with the row, and the state behind it; the first letters that cost least."""
        letters, costs = "", before(symbol, after)
        while True:
            best = [(letter, there) for cost, letter, there in choices(symbol, after, state) if cost == costs[state]]
            there = ASSISTANT if state == USER else USER
            if costs[state] == INSERT + costs[there]:
                best.append(("I", there))
            letter, state = min(best)
            letters += letter
            if letter != "I":
                return letters, state

    def closing(self, state: int) -> str:
        """Rows put in at the end."""
        return {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]

    def parts(self, symbols: bytes) -> tuple[bytes, list[bytes]]:
        """Symbols before the first whole block, and the blocks."""
        odd = len(symbols) % self.block
        return symbols[:odd], [symbols[k:k + self.block] for k in range(odd, len(symbols), self.block)]

    def codes(self, symbols: bytes) -> np.ndarray:
        odd = len(symbols) % self.block
        own = np.frombuffer(symbols, np.uint8, offset=odd).astype(np.int64).reshape(-1, self.block)
        return own @ SYMBOLS ** np.arange(self.block - 1, -1, -1)

    def through(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the symbols the one before them, and the cost they add."""
        at, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in self.codes(symbols)[::-1].tolist() if len(symbols) >= self.block else ():
            total += self.block_adds[at, code]
            at = self.block_to[at, code]
        for symbol in reversed(symbols[:len(symbols) % self.block]):
            total += self.adds[at, symbol]
            at = self.to[at, symbol]
        return at, total

    def _expand(self, vector: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Letters of some symbols and the state behind them, given the vector behind and the state before."""
        key = (vector, symbols, state)
        if key not in self.expanded:
            behind = [vector]
            for symbol in reversed(symbols[1:]):
                behind.append(self.single[behind[-1]][symbol][0])
            letters = []
            for symbol, after in zip(symbols, reversed(behind)):
                part, state = self.moves[after][symbol][state]
                letters.append(part)
            self.expanded[key] = "".join(letters), state
        return self.expanded[key]

    def trace(self, symbols: bytes, vector: int, states: Iterable[int]) -> list[tuple[str, int]]:
        """Letters and last state from each of some first states; the vector is that behind the symbols."""
        odd, blocks = self.parts(symbols)
        behind = []
        for block, code in zip(reversed(blocks), self.codes(symbols)[::-1].tolist() if blocks else ()):
            behind.append(vector)
            vector = int(self.block_to[vector, code])
        pieces = [(b, v) for b, v in zip(blocks, reversed(behind))]
        pieces = [(odd, vector), *pieces] if odd else pieces
        out = []
        for state in states:
            letters = []
            for part, after in pieces:
                text, state = self._expand(after, part, state)
                letters.append(text)
            out.append(("".join(letters), state))
        return out


@functools.cache
def tables() -> Tables:
    return Tables()


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy): the rows after damage by the crc32 of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it a user's. A
    null conversation or turn counts as one space there, and null roles and texts become one space.
    """
    def or_space(name: str) -> Column:
        return F.coalesce(df[f"`{name}`"].cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(or_space(conv), F.lit(":"), or_space(turn)), "UTF-8")) % 20
    rows = df.select(df[f"`{conv}`"].alias("conv"), df[f"`{turn}`"].cast("long").alias("turn"), or_space(role).alias("role"),
                     or_space(text).alias("text"), kind.alias("kind")).filter("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    new_text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                .otherwise(F.col("text")))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       new_text.alias("text"), F.explode(copies).alias("copy"))


def facts(rows: DataFrame) -> DataFrame:
    """Rows without their texts: (conv, turn, role, digest, copy, blank, truncated)."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    return rows.select("conv", "turn", "role", F.sha2("text", 256).alias("digest"), "copy", (trimmed == "").alias("blank"),
                       (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"))


def marked(own: DataFrame) -> DataFrame:
    """``facts`` with ``again``: an earlier turn of the conversation has the same role and text.

    Rows of one turn are compared later, where they stand side by side. Least and greatest turns are
    taken before the shuffle; a text that fills a conversation leaves one row, and its join may be split.
    """
    several = (own.groupBy(F.col("conv").alias("conv_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"))
               .agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
               .filter(~F.col("first.turn").eqNullSafe(F.col("last.turn"))))
    same = (F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_"))
            & (F.col("digest") == F.col("digest_")))
    again = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return own.join(several, same, "left").select(*own.columns, again.alias("again"))


ORDER = ("turn", "role", "digest", "copy")


@dataclass
class Chunk:
    """Rows of one conversation next to each other: symbols, counts and what stands at both ends."""
    conv: object
    symbols: bytearray = field(default_factory=bytearray)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    head: str = ""
    tail: str = ""
    turns: int = 0
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        duplicate = duplicate and not blank
        truncated = truncated and not (blank or duplicate)
        if self.symbols:
            self.illegal += self.tail + initial not in LEGAL
        else:
            self.head = initial
        self.tail = initial
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        known = INITIALS.find(initial) if initial else -1
        self.symbols.append(GONE if blank or duplicate else (known if known >= 0 else 3) + 4 * truncated)


# Pairs of initials that may follow each other.
LEGAL = ("su", "ua", "au")
_FIGURES = ("blank", "duplicate", "truncated", "illegal", "head", "tail", "turns", "low", "high")
_FIGURE_TYPES = [T.StructField(n, T.StringType() if n in ("head", "tail") else T.LongType()) for n in _FIGURES]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches that end where about ``size`` bytes of texts are reached."""
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += 100 + sum(len(v) for v in row if isinstance(v, (bytes, bytearray, str)))
        if held >= size:
            yield _batch(waiting, schema)
            waiting, held = [], 0
    if waiting:
        yield _batch(waiting, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _over(df: DataFrame, schema: T.StructType, make, size: int = 4 << 20) -> DataFrame:
    """``make`` over the rows of every partition in their order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _batches(make(_rows(batches)), arrow, size), schema)


def chunks(rows: Iterator[tuple]) -> Iterator[Chunk]:
    """Sorted rows (conv, turn, role, digest, blank, truncated, again) in chunks of one conversation each."""
    now, last = None, None
    for conv, turn, role, digest, blank, truncated, again in rows:
        if now is None or conv != now.conv or len(now.symbols) >= CHUNK:
            if now is not None:
                yield now
            now = Chunk(conv)
        key = (conv, turn, role, digest)
        now.add(turn, role[:1], blank, again or key == last, truncated)
        last = key
    if now is not None:
        yield now


def _in_order(df: DataFrame, *by: str) -> DataFrame:
    """Conversations whole in a partition, rows in order there."""
    return df.repartition("conv").sortWithinPartitions("conv", *by)


def repairs(own: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of the conversations in ``facts``."""
    conv = own.schema["conv"]
    order = ["conv", *ORDER]
    spread = (marked(own).repartitionByRange(*order[:-1]).sortWithinPartitions(*order)
              .select("conv", "turn", "role", "digest", "blank", "truncated", "again"))

    def cut(found: Iterator[tuple]) -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 32
        for k, c in enumerate(chunks(found)):
            to, adds = tables().through(bytes(c.symbols))
            yield (c.conv, first + k, bytes(c.symbols), to.tolist(), adds.tolist(),
                   *(getattr(c, n) for n in _FIGURES))

    longs, place = T.ArrayType(T.LongType()), T.StructField("place", T.LongType())
    symbols = T.StructField("symbols", T.BinaryType())
    cut_type = T.StructType([conv, place, symbols, T.StructField("to", longs), T.StructField("adds", longs), *_FIGURE_TYPES])

    def behind(found: Iterator[tuple]) -> Iterator[tuple]:
        now, vector, started = None, 0, False
        for own, at, text, to, adds, *figures in found:        # last chunk of a conversation first
            is_last = not started or own != now
            if is_last:
                now, vector, started = own, 0, True
            start = tables().vectors[to[vector]][START]
            yield own, at, text, vector, is_last, adds[vector], start, *figures
            vector = to[vector]

    costs = [T.StructField("adds", T.LongType()), T.StructField("start", T.LongType())]
    behind_type = T.StructType([conv, place, symbols, T.StructField("vector", T.LongType()),
                                T.StructField("is_last", T.BooleanType()), *costs, *_FIGURE_TYPES])

    def traced(found: Iterator[tuple]) -> Iterator[tuple]:
        for own, at, text, vector, is_last, adds, start, *figures in found:
            paths = tables().trace(text, vector, range(4))
            ends = [letters + (tables().closing(state) if is_last else "") for letters, state in paths]
            yield own, at, adds, start, ends, [state for _, state in paths], *figures

    traced_type = T.StructType([conv, place, *costs, T.StructField("audits", T.ArrayType(T.StringType())),
                                T.StructField("states", longs), *_FIGURE_TYPES])

    def followed(found: Iterator[tuple]) -> Iterator[tuple]:
        total = None
        for own, _, adds, start, audits, states, *figures in found:
            if total is None or own != total.conv:
                if total is not None:
                    yield total.row()
                total = _Total(own, start)
            total.add(adds, audits, states, **dict(zip(_FIGURES, figures)))
        if total is not None:
            yield total.row()

    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    result = T.StructType([conv, *(T.StructField(n, T.LongType()) for n in counts), T.StructField("audit", T.StringType())])
    last_first = _over(spread, cut_type, cut).repartition("conv").sortWithinPartitions("conv", F.desc("place"))
    lone = _over(last_first, behind_type, behind).repartition("conv", "place")
    return _over(_in_order(_over(lone, traced_type, traced), "place"), result, followed)


class _Total:
    """Figures of a conversation, added chunk by chunk; ``start`` is what the first vector has for the first state."""

    def __init__(self, conv, start: int):
        self.conv, self.state, self.cost, self.audit = conv, START, start, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.tail, self.low, self.high = None, None, None

    def add(self, adds, audits, states, blank, duplicate, truncated, illegal, head, tail, turns, low, high) -> None:
        self.cost += adds
        self.audit.append(audits[self.state])
        self.state = states[self.state]
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.tail is not None and self.tail + head not in LEGAL)
        self.tail = tail
        if turns:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit))


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, kind, role, text): for every conversation its letters (kind 0), then its rows (kind 1) in order."""
    head = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit("").alias("digest"), F.lit(0).alias("copy"))
    body = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", F.sha2("text", 256).alias("digest"), "copy")
    return _in_order(head.unionByName(body), "kind", *ORDER).select("conv", "kind", "role", "text")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, role, text): the rows of the repaired conversations; inserted ones have empty texts.

    ``rows`` are those of ``damaged``, ``audits`` those of ``repairs``. Partitions hold whole
    conversations in order and are read as streams: of a conversation only its letters are held.
    """
    schema = T.StructType([rows.schema["conv"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])
    return _over(_with_audits(rows, audits), schema, edited)


def edited(found: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of ``_with_audits`` made to repaired rows (conv, place, role, text)."""
    for conv, kind, role, text in found:
        if kind == 0:
            letters, at, place, state = text, 0, 0, START
            last = len(letters.rstrip("I"))
            continue
        while True:
            letter = letters[at]
            at += 1
            if letter == "K":
                state = _AFTER[state, INITIALS.index(role[0])]
                yield conv, place, role, text
            elif letter != "D":
                state = ASSISTANT if state == USER else USER
                yield conv, place, "user" if state == USER else "assistant", text if letter == "R" else ""
            place += letter != "D"
            # Rows put in behind the last one follow it at once.
            if letter != "I" and at != last or at == len(letters):
                break


def hashed(found: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, SHA-256 of ``role:text``, one to a line) from repaired rows in order, read as a stream."""
    now, digest = None, None
    for conv, _, role, text in found:
        if digest is None or conv != now:
            if digest is not None:
                yield now, digest.hexdigest()
            now, digest = conv, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield now, digest.hexdigest()


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row for every conversation of ``df``, a null one too: faults, cheapest edits and repaired hash.

    Rows are damaged first (``damaged``) and stand by turn, null turns first; rows of one turn stand by
    role, then by the SHA-256 of their text, repeated rows next to each other. A row counts with its first
    fault: blank, duplicate (role and text seen earlier in the conversation), truncated. Roles other than
    those starting with s, u or a can only be reroled or deleted. Conversations without a row
    after damage have zeros, no edits and the hash of nothing. Other columns are left out.
    """
    rows = damaged(df, conv, turn, role, text)
    own = keep(facts(rows))
    audits = keep(repairs(own))
    discard(own)
    digest = T.StructType([rows.schema["conv"], T.StructField("digest", T.StringType())])
    digests = _over(_with_audits(rows, audits), digest, lambda rows: hashed(edited(rows)))
    found = audits.join(digests.withColumnRenamed("conv", "conv_"), F.col("conv").eqNullSafe(F.col("conv_")), "left").drop("conv_")
    every = df.select(df[f"`{conv}`"].alias("original")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (every.join(found, F.col("original").eqNullSafe(F.col("conv")), "left")
            .select(F.col("original").alias(conv), *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
