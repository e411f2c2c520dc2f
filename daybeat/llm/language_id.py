"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword of +1 and -1. For each bit of the code one binary classifier tells the
languages with +1 from those with -1 by the n-grams of a text: log ratios of smoothed shares, summed
over the text. A text's language is the codeword with the least loss, each bit's loss weighted by how
often its classifier is right on that language; texts between two codewords are flagged.

Everything is learned from counts over all labelled rows: n-grams by language, then, for the bits,
margins by language in bins of fixed width. Counts are added by Spark before and after the shuffle, so
what reaches the driver depends on the number of languages only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .arrow import add_columns, pieces

SLOT_BITS, ORDERS = 14, (1, 2, 3)
SLOTS = 1 << SLOT_BITS
SMOOTHING = 0.5                 # added to the count of every slot
FULL_CODE = 6                   # up to so many languages the code has every way to part them
TRIES = 200                     # random codes looked at for more languages; the widest apart is taken
BINS, WIDTH = 64, 1.0           # margins are counted in bins of this width, the outer ones open
RIDGE = 1e-3
UNIT = 1 << 16                  # weights are whole numbers of this part of one
AMBIGUOUS = 0.6                 # a best score below this is flagged
UNKNOWN = "und"
_STRETCH = 1 << 20              # letters worked on at once
_LOCAL = 64                     # languages a task holds counts of before it hands them on; bounds memory only
_ODD = np.random.default_rng(13).integers(1, 1 << 31, max(ORDERS) + 1, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = np.uint32(0x9E3779B1)    # fixed value: multiplier of a public integer hash


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of some texts, one row for each order, and where each text starts in them.

    Letters are lower-cased; a gap stands before and after every run of letters. An n-gram that would
    reach into the next text has the slot SLOTS, which counts for nothing.
    """
    own = [f"\n{t}\n" for t in map(str.lower, texts)]
    codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    near = letter.copy()
    near[1:] |= letter[:-1]
    near[:-1] |= letter[1:]
    codes = np.where(letter, codes, np.uint32(0))[near]
    ends = np.cumsum(near)[np.cumsum([len(t) for t in own]) - 1]
    out = np.full((len(ORDERS), len(codes)), SLOTS, np.int64)
    for row, order in zip(out, ORDERS):
        n = max(0, len(codes) - order + 1)
        key = np.full(n, order, np.uint32)
        for k in range(order):
            key += codes[k:k + n] * _ODD[k]
            key ^= key >> np.uint32(15)
        row[:n] = (key * _MIX) >> np.uint32(32 - SLOT_BITS)
        for k in range(1, order):
            row[np.maximum(ends - k, 0)] = SLOTS
    return out, np.concatenate([[0], ends[:-1]]).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def stretches(values: list[bytes | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """The texts that have letters, some at a time: their places in the list, slots and starts.

    A longer text comes in parts of a fixed length, each with n-grams of its own.
    """
    at, parts, size = [], [], 0
    for k, raw in enumerate(values):
        text = (raw or b"").decode()
        for start in range(0, len(text), _STRETCH):
            part = text[start:start + _STRETCH]
            if has_letter(part):
                at.append(k)
                parts.append(part)
                size += len(part)
                if size >= _STRETCH:
                    yield at, *grams(parts)
                    at, parts, size = [], [], 0
    if parts:
        yield at, *grams(parts)


def gram_counts(values: list[bytes | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Place in the list and n-gram counts of the texts that have letters, in order."""
    for at, slots, starts in stretches(values):
        for k, start, end in zip(at, starts, [*starts[1:], slots.shape[1]]):
            yield k, np.bincount(slots[:, start:end].ravel(), minlength=SLOTS + 1)[:SLOTS]


def evidence(values: list[bytes | None], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of n-grams of every text, and the sums of their weights.

    Weights and counts are whole numbers, so a text's evidence does not depend on its batch or machine.
    """
    sizes, sums = np.zeros(len(values), np.int64), np.zeros((len(values), weights.shape[1]))
    for k, counts in gram_counts(values):
        sizes[k] += counts.sum()
        sums[k] += counts.astype(np.float64) @ weights
    return sizes, sums


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 for every language; no two rows or columns are equal or opposite.

    A few languages get every way to part them in two, more of them the random code, of
    several, whose nearest two codewords differ most. One language has no bits.
    """
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= FULL_CODE:
        # The first language is always +1, so no column is another one's opposite.
        columns = [(1, *rest) for rest in product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(columns, float).T
    bits, rng, best, apart = 10 * int(np.ceil(np.log2(languages))), np.random.default_rng(languages), None, -1
    for _ in range(TRIES):
        code = np.where(rng.random((languages, bits)) < 0.5, 1.0, -1.0)
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        same = code @ code.T + 2 * code.shape[1] * -np.eye(languages)
        least = int((code.shape[1] - same.max()) // 2)
        if least > apart:
            best, apart = code, least
    return best


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, each bit's n-gram weights, scale and shift, and its weight by language."""
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, values: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams, and the bits' evidence: it grows with the root of the length, as n-grams hang together."""
        sizes, sums = evidence(values, self.weights)
        return sizes, sums / UNIT / np.sqrt(np.maximum(1, sizes))[:, None]

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        """Shares of the languages of one text by their losses."""
        sure = self.scale * margins + self.shift
        loss = (self.trust * np.logaddexp(0, -self.code * sure)).sum(axis=1)
        share = np.exp(-(loss - loss.min()))
        return share / share.sum()


def _counted(rows: DataFrame, size: int, count) -> dict[str, np.ndarray]:
    """Tables of ``size`` numbers per language, summed over all rows; ``count`` gives those of single rows.

    Tasks hand on non-zero entries only; their number is bounded by languages and ``size``.
    """
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def handed():
            for lang, own in held.items():
                used = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()),
                                                  pa.array(own[used], pa.int64())], names=["lang", "slot", "n"])
            held.clear()

        for batch in batches:
            for part in pieces(batch, "text"):
                langs, texts = part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()
                for at, counts in count(texts):
                    lang = langs[at]
                    if lang not in held:
                        if len(held) >= _LOCAL:
                            yield from handed()
                        held[lang] = np.zeros(size, np.int64)
                    held[lang] += counts
        yield from handed()

    found = (rows.mapInArrow(local, "lang string, slot long, n long").groupBy("lang", "slot")
             .agg(F.sum("n").alias("n")).toPandas())
    return {lang: _table((own["slot"].to_numpy(), own["n"].to_numpy()), size) for lang, own in found.groupby("lang")}


def _table(found: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    out = np.zeros(size)
    out[found[0]] = found[1]
    return out


def bit_weights(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log ratios, in whole UNITs, of the n-grams' mean shares in the languages with +1 and with -1."""
    share = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    up, down = (code > 0).astype(float), (code < 0).astype(float)
    ratio = np.log((share.T @ up) / up.sum(axis=0)) - np.log((share.T @ down) / down.sum(axis=0))
    return np.rint(ratio * UNIT)


def _bins(margins: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(margins / WIDTH).astype(np.int64) + BINS // 2, 0, BINS - 1)


def calibrated(seen: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scale and shift of every bit, and its share of right signs by language, from margins in bins.

    ``seen`` counts (language, bit, bin). Languages weigh alike. Newton steps on the logistic loss
    with a small penalty, which keeps the scale finite where a bit makes no mistake.
    """
    middle = (np.arange(BINS) - BINS // 2 + 0.5) * WIDTH
    weight = seen / np.maximum(seen.sum(axis=2, keepdims=True), 1)
    scale, shift = np.ones(code.shape[1]), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        x = np.stack([np.tile(middle, len(code)), np.ones(BINS * len(code))])
        y, w = np.repeat(code[:, bit] > 0, BINS), weight[:, bit].ravel()
        p = np.array([0.1, 0.0])
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(p @ x, -60, 60)))
            slope = x @ (w * (q - y)) + RIDGE * p
            bend = (x * (w * q * (1 - q))) @ x.T + RIDGE * np.eye(2)
            step = np.linalg.solve(bend, slope)
            p = p - step * min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        scale[bit], shift[bit] = p
    sign = np.where(scale[:, None] * middle + shift[:, None] >= 0, 1.0, -1.0)
    right = (seen * (sign[None] == code[:, :, None])).sum(axis=2)
    trust = (right + 1) / (seen.sum(axis=2) + 2)
    return scale, shift, trust / trust.mean(axis=1, keepdims=True)


def remainder(id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows with remainder 0 are held out."""
    return F.crc32(F.encode(F.col(id).cast("string"), "UTF-8")) % 5


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model from all rows of ``docs`` with a language and letters in their text.

    Rows with a null language or without letters teach nothing. No such row: a model without languages.
    """
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"),
                                                       F.col(text).alias("text"))
    grams_of = _counted(rows, SLOTS, gram_counts)
    languages = sorted(grams_of)
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = bit_weights(np.array([grams_of[name] for name in languages]).reshape(len(languages), SLOTS), code)
    model = Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(code.shape))
    if not bits:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def margin_entries(values):
        sizes, margins = shared.value.margins(values)
        for at in np.flatnonzero(sizes):
            yield at, np.bincount(np.arange(bits) * BINS + _bins(margins[at]), minlength=bits * BINS)

    seen = _counted(rows, bits * BINS, margin_entries)
    tables = np.array([seen[name].reshape(bits, BINS) for name in languages])
    return Model(languages, code, weights, *calibrated(tables, code))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` of every whole text.

    Null texts and texts without a letter get ``und`` and score 0 and are ambiguous, as does every
    text under a model without languages. Equal texts get equal results; ties go to the language
    first in order. Rows stay as they are; columns with the new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(values):
        own = shared.value
        sizes, margins = own.margins(values)
        pred, score = [UNKNOWN] * len(values), np.zeros(len(values))
        for at in np.flatnonzero(sizes) if own.languages else ():
            share = own.probabilities(margins[at])
            pred[at], score[at] = own.languages[int(share.argmax())], share.max()
        return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(score < AMBIGUOUS, pa.bool_())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("ambiguous", T.BooleanType())]
    return add_columns(docs, text, fields, make)


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``held_out`` and the columns of ``predict``, learned from rows that are not held out.

    Rows with a null id are held out of the learning too, but not marked so.
    """
    model = train(docs.filter(remainder(id) != 0), text, lang)
    return (predict(docs, model, text)
            .withColumn("held_out", F.coalesce(remainder(id) == 0, F.lit(False))))
