"""Heuristic quality rules as a cascade: the cheapest rejection first, later rules only on what is left.

Cost and selectivity of every rule are measured on a bounded sample; rules then run in order of
rejected documents per second. The verdict is that of all rules together, whatever the order.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .arrow import add_columns

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
_SHOUTED = re.compile(rb"[A-Z]{2}")
_LETTERLESS = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+\Z")


class Text:
    """One text; every statistic is worked out when first asked for."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""
        self.text = self.raw.decode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()         # bytes split at space and \x09-\x0D

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, WHITE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(WHITE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
        covered = np.zeros(len(self.words), bool)
        for k in range(3):
            covered[k:k + len(windows)] |= again
        return int(covered.sum())

    @cached_property
    def n_shouted(self) -> int:
        """Words with two capitals A-Z in a row and no small letter a-z."""
        return sum(1 for w in self.words if _SHOUTED.search(w) and w == w.upper())

    @cached_property
    def n_letterless(self) -> int:
        """Words of ASCII characters without a letter."""
        return sum(map(bool, map(_LETTERLESS.match, self.words)))


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells whether a text breaks the rule; it looks at the whole text."""
    name: str
    rejects: Callable[[Text], bool]


# Limits of the production rules; every one is a share of the text's words or lines.
BASE = (
    Rule("too_short", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > 2 * t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 5 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
    Rule("shouting", lambda t: 10 * t.n_shouted > 3 * t.n_words),
    Rule("letterless", lambda t: 10 * t.n_letterless > 3 * t.n_words),
)


def measure(df: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = 512,
            ) -> dict[str, tuple[float, float]]:
    """Seconds and rejected share of each rule, from a random sample of about ``sample_rows`` rows.

    Each rule is timed on its own, with nothing worked out before. The sample stays where the rows
    are; only sums by rule are shuffled. An empty table gives zeros.
    """
    schema = "rule string, seconds double, rejected long, seen long"

    def run(batches):
        names, seconds, rejected = [], [], []
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                for rule in rules:
                    fresh, start = Text(raw), time.perf_counter()
                    rejected.append(int(rule.rejects(fresh)))
                    seconds.append(time.perf_counter() - start)
                    names.append(rule.name)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(seconds, pa.float64()), pa.array(rejected, pa.int64()),
                 pa.array([1] * len(names), pa.int64())],
                names=["rule", "seconds", "rejected", "seen"])
            names, seconds, rejected = [], [], []

    share = min(1.0, sample_rows / max(1, df.count()))
    rows = (df.select(F.col(text)).sample(share, seed=1).mapInArrow(run, schema).groupBy("rule")
            .agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("seen").alias("n"))
            .collect())
    found = {r.rule: (r.s / r.n, r.r / r.n) for r in rows}
    return {rule.name: found.get(rule.name, (0.0, 0.0)) for rule in rules}


def ordered(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Rules by falling rejection per second; rules that rejected nothing go last, cheap ones first."""
    def rank(rule: Rule):
        seconds, share = measured[rule.name]
        return (-share / max(seconds, 1e-9), seconds, rule.name)
    return tuple(sorted(rules, key=rank))


def apply_cascade(df: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES,
                  text: str = "text", sample_rows: int = 512) -> DataFrame:
    """``df`` with the base statistics, ``base_failed``, ``kept`` and ``rejected_by``.

    Base rules run on every text, the others in measured order and only until one rejects.
    ``rejected_by`` names the first rule that did (null if kept); it depends on the order, ``kept``
    does not. Null and empty texts have no words, so the base rules reject them. Repeated rows get
    equal results; columns of ``df`` with the names of the new ones are replaced.
    """
    cascade = ordered(rules, measure(df, rules, text, sample_rows))
    statistics = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = [T.StructField(s, T.LongType()) for s in statistics]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
               T.StructField("rejected_by", T.StringType())]

    def make(values):
        columns = [[] for _ in fields]
        for raw in values:
            t = Text(raw)
            numbers = [getattr(t, s) for s in statistics]
            failed = next((r.name for r in base if r.rejects(t)), None)
            by = failed or next((r.name for r in cascade if r.rejects(t)), None)
            for column, value in zip(columns, [*numbers, failed is not None, by is None, by]):
                column.append(value)
        kinds = [pa.int64()] * len(statistics) + [pa.bool_(), pa.bool_(), pa.string()]
        return [pa.array(c, k) for c, k in zip(columns, kinds)]

    return add_columns(df, text, fields, make)
