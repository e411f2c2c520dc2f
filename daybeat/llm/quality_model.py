"""Quality classifier: random-indexing word vectors pooled per text, a two-layer network, temperature.

Every token belongs to one of a fixed number of vocabulary slots. A slot has a sparse random index
vector of a few +1 and -1; its word vector is the sum of the index vectors of all tokens that stand
near it, over the whole corpus, so words in like company get like vectors. A text is pooled to the
mean and spread of its tokens' vectors, the mean over its different tokens, and three figures of
length and repetition. A network of two layers is fitted to a bounded sample of labelled rows and its
probabilities are calibrated by one temperature on labelled rows that the fit did not see.
"""

from __future__ import annotations

import functools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import discard, keep
from .arrow import add_columns, pieces

SLOTS, DIMENSIONS, NONZERO, REACH = 8192, 64, 4, 2
BLOCK = 256                     # slots of one row while word vectors are summed
TRAIN_ROWS = 20_000             # bound of the labelled sample the network is fitted to
HIDDEN, EPOCHS, SEED = 32, 60, 20_240_601
REMEMBERED = 200_000            # tokens a worker remembers the slot of; bounds memory only
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MOST = 1 << 18                 # tokens worked on at once; longer texts go in several parts


class _Slots(dict):
    """Token to slot. Case folds away except that words all in capitals are marked; numbers by length."""

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        form = token.lower() + "\0" if len(token) > 1 and token.isupper() else token.lower()
        form = f"\1{len(token)}" if token.isdigit() else form
        slot = self[token] = zlib.crc32(form.encode()) % SLOTS
        return slot


_SLOTS = _Slots()


def slots(raw: bytes | None) -> np.ndarray:
    """Vocabulary slots of the tokens of a text; null and empty texts have none."""
    tokens = _TOKEN.findall((raw or b"").decode())
    return np.fromiter(map(_SLOTS.__getitem__, tokens), np.int64, len(tokens))


@functools.cache
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every slot's index vector.

    One slot more, all zero, stands for the gaps between texts.
    """
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((SLOTS + 1, DIMENSIONS)), axis=1)[:, :NONZERO]
    signs = np.tile(np.where(np.arange(NONZERO) % 2 == 0, 1.0, -1.0), (SLOTS + 1, 1))
    signs[SLOTS] = 0
    return places.astype(np.int64), signs


def context_sums(texts: list[np.ndarray]) -> np.ndarray:
    """Sums of the neighbours' index vectors for every slot, over some texts."""
    places, signs = index_vectors()
    total, size = np.zeros((SLOTS + 1) * DIMENSIONS), (SLOTS + 1) * DIMENSIONS
    own = _joined(texts)
    for start in range(0, len(own), _MOST):
        for far in range(1, REACH + 1):
            here, there = own[start:start + _MOST], own[start + far:start + _MOST + far]
            here = here[:len(there)]
            for word, near in ((here, there), (there, here)):
                flat = (word[:, None] * DIMENSIONS + places[near]).ravel()
                total += np.bincount(flat, signs[near].ravel(), size)
    return total.reshape(SLOTS + 1, DIMENSIONS)[:SLOTS]


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Unit word vectors of all slots, from every row of ``df``.

    Each task sums its texts into one fixed table; the tables are added by block of slots. The
    result has SLOTS x DIMENSIONS numbers whatever the input, so it may go to the driver.
    """
    def local(batches):
        total, waiting, size = np.zeros((SLOTS, DIMENSIONS)), [], 0
        for batch in batches:
            for part in pieces(batch, text):
                for raw in part.column(0).cast(pa.binary()).to_pylist():
                    waiting.append(slots(raw))
                    size += len(waiting[-1])
                    if size >= _MOST:
                        total += context_sums(waiting)
                        waiting, size = [], 0
        total += context_sums(waiting)
        blocks = total.astype(np.int64).reshape(SLOTS // BLOCK, BLOCK * DIMENSIONS)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([_packed(blocks[b]) for b in used], pa.binary())],
            names=["block", "sums"])

    def added(key, rows):
        total = np.zeros(BLOCK * DIMENSIONS, np.int64)
        for packed in rows.column("sums").to_pylist():
            total += _unpacked(packed)
        return pa.table({"block": [key[0].as_py()], "sums": [total.tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("sums", pa.binary())]))

    schema = "block long, sums binary"
    rows = (df.select(F.col(text).alias(text)).mapInArrow(local, schema)
            .groupBy("block").applyInArrow(added, schema).collect())
    vectors = np.zeros((SLOTS // BLOCK, BLOCK * DIMENSIONS))
    for row in rows:
        vectors[row.block] = np.frombuffer(row.sums, np.int64)
    vectors = vectors.reshape(SLOTS, DIMENSIONS)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _joined(texts: list[np.ndarray]) -> np.ndarray:
    """Texts one after the other, with gaps so that all neighbours are of one text."""
    gap = np.full(REACH, SLOTS, np.int64)
    return np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap


def _packed(sums: np.ndarray) -> bytes:
    """Width of the integers, then the integers in the smallest width that holds them."""
    most = int(np.abs(sums).max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + sums.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"i{packed[0]}", offset=1).astype(np.int64)


def pooled(own: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of one text; a text without tokens has zeros."""
    out = np.zeros(3 * DIMENSIONS + 3, np.float32)
    if len(own):
        kinds, counts = np.unique(own, return_counts=True)
        v = vectors[kinds].astype(np.float64)
        mean = counts @ v / len(own)
        spread = np.sqrt(np.maximum(counts @ (v * v) / len(own) - mean * mean, 0))
        repeats = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0.0
        out[:] = np.concatenate([mean, spread, v.mean(axis=0),
                                 [np.log1p(len(own)) / 8, len(kinds) / len(own), repeats]])
    return out


@dataclass(frozen=True)
class Network:
    """Standardising, two layers and the temperature."""
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam on the cross entropy; a fifth of the rows is held back to set the temperature.

    Without rows, or with one class only, every score is the share of label 1 (half without rows).
    """
    n, m = x.shape
    centre, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if n else (np.zeros(m), np.ones(m))
    if n < 10 or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if n else 0.5
        return Network(centre, scale, np.zeros((m, hidden)), np.zeros(hidden), np.zeros(hidden),
                       float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    held, used = order[:n // 5], order[n // 5:]
    z = (x - centre) / scale
    p = [rng.normal(0, m ** -0.5, (m, hidden)), np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), 0.0]
    first, second, step = [0.0] * 4, [0.0] * 4, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // 256)):
            a = np.tanh(z[rows] @ p[0] + p[1])
            error = (_sigmoid(a @ p[2] + p[3]) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - a * a)
            slope = [z[rows].T @ back + 1e-3 * p[0], back.sum(axis=0), a.T @ error + 1e-3 * p[2], error.sum()]
            step += 1
            for k, g in enumerate(slope):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    rough = Network(centre, scale, p[0], p[1], p[2], float(p[3]))
    logits, truth = rough.logits(x[held]), y[held]
    choices = np.geomspace(0.25, 8, 101)

    def loss(t: float) -> float:
        q = np.clip(_sigmoid(logits / t), 1e-9, 1 - 1e-9)
        return -np.mean(truth * np.log(q) + (1 - truth) * np.log(1 - q))

    return Network(centre, scale, p[0], p[1], p[2], float(p[3]), float(min(choices, key=loss)))


def remainder(id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; rows with remainder 1 are held out."""
    return F.crc32(F.encode(F.col(id).cast("string"), "UTF-8")) % 3


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
          train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts, and the network fitted to labelled rows that are not held out.

    At most ``train_rows`` labelled rows are used, those with the smallest hashes of their ids, so the
    sample is the same in every run. Ids with several labels count with the smallest one; null ids and
    labels are left out.
    """
    vectors = word_vectors(docs, text)
    chosen = keep(labels.filter((remainder(id) != 1) & F.col(label).isNotNull())
                  .groupBy(F.col(id).alias("__id")).agg(F.min(F.col(label).cast("double")).alias("__label"))
                  .orderBy(F.xxhash64("__id"), "__id").limit(train_rows))
    # At most train_rows pairs of numbers: bounded whatever the size of the labels.
    rows = docs.select(F.col(id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def make(values):
        return [pa.array([pooled(slots(v), shared.value).tolist() for v in values], pa.list_(pa.float32()))]

    # Rows that share an id would outnumber the bound: one of each is enough to learn from.
    sample = (add_columns(rows, "text", [T.StructField("x", T.ArrayType(T.FloatType()))], make)
              .select("__id", "__label", "x").groupBy("__id", "__label").agg(F.min("x").alias("x"))
              .orderBy(F.xxhash64("__id"), "__id").toPandas())
    discard(chosen)
    x = np.array(sample["x"].tolist(), np.float64).reshape(len(sample), 3 * DIMENSIONS + 3)
    return vectors, fit(x, sample["__label"].to_numpy(np.float64))


def score(docs: DataFrame, vectors: np.ndarray, network: Network, text: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text; columns of that name are replaced.

    Null and empty texts are scored as texts without tokens. Equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def make(values):
        table, net = shared.value
        x = np.array([pooled(slots(v), table) for v in values]).reshape(len(values), -1)
        # One row at a time in the last step, so that a score does not depend on its batch.
        return [pa.array([float(net.probabilities(row[None, :])[0]) for row in x], pa.float64())]

    return add_columns(docs, text, [T.StructField(name, T.DoubleType())], make)


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``, learned from ``labels`` as in ``train``."""
    vectors, network = train(docs, labels, id, text)
    return (score(docs, vectors, network, text)
            .withColumn("held_out", F.coalesce(remainder(id) == 1, F.lit(False)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def accepted(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1, columns unchanged."""
    vectors, network = train(docs, labels, id, text)
    judged = score(docs, vectors, network, text, name="__score")
    return judged.filter(F.col("__score") >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
