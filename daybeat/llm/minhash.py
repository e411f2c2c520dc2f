"""MinHash near-duplicates of texts: universal hash minima, bands, verification, components.

1. A text's set of shingles gives many minima under universal hash functions. Texts with equal sets are
   one node from here on.
2. Minima are grouped into bands. Texts that agree in a band are led to the smallest of them; components
   of these candidate links are the clusters that may hold true links.
3. Each cluster gets its texts once. Signatures rule out pairs far from the threshold, full sets confirm
   the others; a pair whose ends are linked already need not be looked at. Large clusters are dealt out
   as pairs of tiles of bounded size, so that every pair of texts meets in some task.
4. Components of the confirmed links are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import discard, keep
from .arrow import add_columns
from .components import components
from .rows import by_row
from .shingles import mixed, shingle_set

# A pair at similarity 0.8 misses all bands with chance (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS_PER_BAND = 32, 5
HASHES = BANDS * ROWS_PER_BAND
# Pairs whose signatures agree less than so many standard errors below the threshold are not verified.
SLACK = 4.5
# Shingles of one tile; a task holds two tiles.
TILE = 2_000_000
_AT_ONCE = 1024
_RNG = np.random.default_rng(11)
_A = (_RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]
_IN_BAND = _RNG.integers(1, 1 << 63, ROWS_PER_BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

col = F.col


def minima(own: np.ndarray) -> np.ndarray:
    """Upper halves of the minima of all hash functions over a set of shingles."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(own), _AT_ONCE):
        product = _A * own[None, start:start + _AT_ONCE]
        product += _B
        np.minimum(least, product.min(axis=1), out=least)
    return least >> np.uint64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for each band; keys of different bands differ."""
    sums = (least.reshape(BANDS, ROWS_PER_BAND) * _IN_BAND).sum(axis=1, dtype=np.uint64)
    return mixed(sums + np.arange(1, BANDS + 1, dtype=np.uint64) * _IN_BAND[0]).view(np.int64)


def signature(least: np.ndarray) -> bytes:
    """The lowest byte of every minimum."""
    return least.astype(np.uint8).tobytes()


def features(df: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """(id, n, set_key, bands) of every text; texts without words have no key and no bands."""
    fields = [T.StructField("n", T.LongType()), T.StructField("set_key", T.BinaryType()),
              T.StructField("bands", T.ArrayType(T.LongType()))]

    def make(values):
        sizes, keys, bands = [], [], []
        for raw in values:
            own = shingle_set(raw, shingle)
            sizes.append(len(own))
            keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            bands.append(band_keys(minima(own)).tolist() if len(own) else None)
        return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]

    rows = df.select(col(f"`{id}`").alias("id"), col(f"`{text}`").alias("text"))
    return add_columns(rows, "text", fields, make).drop("text")


def linked(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For every text, the place of the first one that links connect it with; ``ids`` are ascending."""
    n = len(ids)
    root, sizes = np.arange(n), np.fromiter(map(len, sets), np.int64, n)
    marks = np.zeros((n, HASHES), np.uint8)
    share = percent / 100
    least = HASHES * share - SLACK * (HASHES * share * (1 - share)) ** 0.5
    for i in range(n):
        marks[i] = np.frombuffer(signature(minima(sets[i])), np.uint8)
        agree = np.count_nonzero(marks[:i] == marks[i], axis=1)
        small, large = np.minimum(sizes[:i], sizes[i]), np.maximum(sizes[:i], sizes[i])
        near = np.flatnonzero((agree >= least) & (100 * small >= percent * large))
        near = near[np.argsort(-agree[near], kind="stable")]
        while len(near):
            j, near = near[0], near[1:]
            both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                low, high = sorted((root[i], root[j]))
                root[root == high] = low
                near = near[root[near] != root[i]]
    return root


def _confirmed(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b) links between the texts of each cluster (and pair of tiles)."""
    def verify(key, rows):
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        ids = rows.column("id").to_numpy()[order]
        texts = rows.column("text").cast(pa.binary()).to_pylist()
        root = linked(ids, [shingle_set(texts[k], shingle) for k in order], percent)
        moved = root != np.arange(len(ids))
        return pa.table({"a": ids[moved], "b": ids[root[moved]]},
                        schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return members.groupBy("cluster", "left", "right").applyInArrow(verify, "a long, b long")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``df``.

    Words are lower-cased (A-Z) runs without white space; a text's set holds its different runs of
    ``shingle`` words, of all its words if it has fewer. Two texts are linked if their sets share
    ``percent`` of their union. ``component_id`` is the smallest id reachable by links, ``kept`` marks
    the text that has it. Texts without words (null, empty) are linked with nothing. Ids are whole
    numbers; rows with the same id count as one text with the links of them all; a row without an id
    has no component and is kept. No rows give an empty table.
    """
    found = keep(features(df, id, text, shingle))
    alike = keep(found.filter(col("set_key").isNotNull() & col("id").isNotNull())
                 .groupBy("set_key").agg(F.min("id").alias("node")))
    nodes = alike.select(col("node").alias("id")).distinct()
    banded = (found.join(nodes, "id", "left_semi").filter(col("bands").isNotNull())
              .select("id", F.explode("bands").alias("band")))
    hubs = (banded.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
            .filter(col("hub") < col("last")).select("band", "hub"))
    candidates = keep(banded.join(hubs, "band").filter(col("id") != col("hub")).select("id", "hub").distinct())
    clusters = keep(components(candidates))
    sized = (found.groupBy("id").agg(F.max("n").alias("n")).join(clusters.withColumnRenamed("node", "id"), "id")
             .groupBy("component").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("tiles")))
    tile = F.pmod(F.xxhash64("node"), col("tiles")).cast("int")
    # Each text of a tiled cluster meets every other tile once; an untiled cluster is one group.
    other = F.explode(F.when(col("tiles") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), col("tiles") - 1), lambda u: u != col("tile"))))
    dealt = (clusters.join(sized, "component").withColumn("tile", tile).withColumn("other", other)
             .select(col("node").alias("id"), col("component").alias("cluster"),
                     F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right")))
    texts = df.select(col(f"`{id}`").alias("id"), col(f"`{text}`").alias("text"))
    links = keep(_confirmed(texts.join(dealt, "id"), shingle, percent))
    # Equal sets are linked through their node; ids shared by several sets link those sets.
    shared = (found.filter(col("set_key").isNotNull()).select("id", "set_key").join(alike, "set_key")
              .filter(col("id") != col("node")).select(col("id").alias("a"), col("node").alias("b")))
    whole = keep(components(links.unionByName(shared)))
    discard(candidates, clusters, links)
    return (found.select("id", "n").join(whole, col("id") == col("node"), "left")
            .withColumn("component_id", F.coalesce("component", "id"))
            .select(col("id").alias(id), col("n").alias("n_shingles"), "component_id",
                    F.coalesce(col("id") == col("component_id"), F.lit(True)).alias("kept")))


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, columns unchanged.

    Rows that share an id are told apart by their texts: a text stays unless it is linked with one before
    it, by id and then by hash of the text. Of rows that share both id and text one stays.
    """
    def left(rows: DataFrame, name: str) -> DataFrame:
        judged = near_duplicates(rows, name, text, **options)
        gone = judged.filter(~col("kept")).select(col(name).alias("__gone")).distinct()
        kept = rows.join(gone, col(f"`{name}`") == col("__gone"), "left_anti")
        return kept if name == id else kept.dropDuplicates([name])

    return by_row(df, id, text, left)
