"""Near-duplicate vectors: a pigeonhole join over blocks of rotated coordinates, exact verification.

Unit vectors with cosine c lie at squared distance 2 - 2c. After a rotation their coordinates are split
into blocks; a pair within the squared distance is within a proportional part of it in one block at
least. In every block a grid over its first coordinates brings together what may be that close: a vector
stands in its own cell and as a guest in every cell that its ball touches. Tasks compare the vectors of
a cell, take a pair in the first block where it is close, verify its cosine, and give counts and one link
per vector towards a common root, never the pairs themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import discard, keep
from .components import components

BLOCK_SIZE = 16                 # rotated coordinates of one block
TILE = 4096                     # vectors of one tile; a task compares two tiles at most
_SLACK, _DIGITS, _AT_ONCE = 1e-6, 12, 512

col = F.col


@dataclass(frozen=True)
class Space:
    """The rotation, the blocks and the grid for vectors of one length."""
    rotation: np.ndarray
    budget: float               # squared distance of a link
    grid: int                   # coordinates of a block that the grid divides

    @property
    def blocks(self) -> list[slice]:
        d = len(self.rotation)
        count = max(1, d // BLOCK_SIZE)
        cuts = np.linspace(0, d, count + 1).astype(int)
        return [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    def part(self, block: slice) -> float:
        return self.budget * (block.stop - block.start) / len(self.rotation)

    def rotated(self, units: np.ndarray) -> np.ndarray:
        # Rounded, so that every task sees the same coordinates whatever its batch.
        return np.round(units @ self.rotation, _DIGITS)


def space(dimensions: int, cosine: float, grid: int) -> Space:
    """A fixed random rotation; one coordinate needs none."""
    q, r = np.linalg.qr(np.random.default_rng(dimensions).normal(size=(dimensions, dimensions)))
    return Space(q * np.sign(np.diag(r)), 2 - 2 * cosine, grid)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, which loses no digit, so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def as_units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision."""
    near_one = scaled(vectors)
    return near_one / np.linalg.norm(near_one, axis=1, keepdims=True)


def cells(x: np.ndarray, radius: float, grid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, whether it is the row's own cell) of all grid cells that the balls around rows touch."""
    width = 2 * radius
    row, used = np.arange(len(x)), np.zeros(len(x))
    key, home = np.zeros(len(x), np.uint64), np.ones(len(x), bool)
    for k in range(min(grid, x.shape[1])):
        own = np.floor(x[:, k] / width)
        parts = []
        for step in (-1, 0, 1):
            gap = (np.zeros(len(x)) if step == 0 else x[:, k] - own * width if step < 0
                   else (own + 1) * width - x[:, k])
            spent = used + gap[row] ** 2
            ok = spent <= radius * radius + _SLACK
            number = (own + step).astype(np.int64).view(np.uint64)[row]
            mixed = (key ^ number) * np.uint64(0x9E3779B97F4A7C15)      # fixed value: golden ratio
            mixed ^= mixed >> np.uint64(29)
            parts.append((row[ok], spent[ok], mixed[ok], home[ok] & (step == 0)))
        row, used, key, home = (np.concatenate(p) for p in zip(*parts))
    return row, key.view(np.int64), home


def _dealt(df: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """A row for every block and cell that a vector stands in."""
    schema = T.StructType([*df.schema.fields, T.StructField("block", T.IntegerType()),
                           T.StructField("cell", T.LongType()), T.StructField("home", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                lengths = part.column(part.schema.get_field_index("length")).to_numpy()
                values = part.column(part.schema.get_field_index("vector"))
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    own = part.take(pa.array(at))
                    x = np.array(values.take(pa.array(at)).to_pylist(), np.float64)
                    own_space = spaces[int(length)]
                    turned = own_space.rotated(as_units(x))
                    for b, block in enumerate(own_space.blocks):
                        row, key, home = cells(turned[:, block], own_space.part(block) ** 0.5, own_space.grid)
                        out = own.take(pa.array(row))
                        yield pa.RecordBatch.from_arrays(
                            [*out.columns, pa.array(np.full(len(row), b, np.int32)), pa.array(key), pa.array(home)],
                            names=schema.names)

    return df.mapInArrow(run, schema)


def compare(ids: np.ndarray, nodes: np.ndarray, copies: np.ndarray, home: np.ndarray, tiles: np.ndarray,
            x: np.ndarray, own_space: Space, block: int, across: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked vectors counted for each row, and the smallest row that links within this cell connect it with.

    A pair counts in the cell that is home to its later row (by id and node), in the first block where
    it is close, and where two different tiles meet (``across``) only between them.
    """
    units, x = as_units(x), scaled(x)
    norms = np.sqrt((x * x).sum(axis=1))
    turned, parts = own_space.rotated(units), own_space.blocks
    limit = [own_space.part(p) + _SLACK / 10 for p in parts]
    flat = np.ascontiguousarray(turned[:, parts[block]])
    square = (flat * flat).sum(axis=1)
    order = np.empty(len(ids), np.int64)
    order[np.lexsort((nodes, ids))] = np.arange(len(ids))
    count, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    homes = np.flatnonzero(home)
    for start in range(0, len(homes), _AT_ONCE):
        later = homes[start:start + _AT_ONCE]
        near = square[:, None] + square[later] - 2 * flat @ flat[later].T <= own_space.part(parts[block]) + _SLACK
        near &= order[:, None] < order[later]
        if across:
            near &= tiles[:, None] != tiles[later]
        i, k = np.nonzero(near)
        j = later[k]
        first = np.ones(len(i), bool)
        for b in range(block + 1):
            apart = ((turned[i, parts[b]] - turned[j, parts[b]]) ** 2).sum(axis=1)
            first &= (apart <= limit[b]) if b == block else (apart > limit[b])
        i, j = i[first], j[first]
        linked = (x[i] * x[j]).sum(axis=1) / (norms[i] * norms[j]) >= cosine
        i, j = i[linked], j[linked]
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        while True:
            least = np.minimum(root[i], root[j])
            before = root.copy()
            for end in (i, j):
                np.minimum.at(root, end, least)
                np.minimum.at(root, before[end], least)
            root = root[root]
            if np.array_equal(root, before):
                break
    return count, root


def _compared(dealt: DataFrame, spaces: dict[int, Space], cosine: float) -> DataFrame:
    schema = "id long, node long, links long, root long"

    def run(key, rows):
        length, block, _, _, left, right = (k.as_py() for k in key)
        # A cell whose key equals another's by chance may hold a vector twice: its home row comes first.
        ids, nodes, home = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "node", "home"))
        order = np.lexsort((~home, nodes, ids))
        keep_row = np.ones(len(order), bool)
        keep_row[1:] = (np.diff(ids[order]) != 0) | (np.diff(nodes[order]) != 0)
        order = order[keep_row]
        x = np.array(rows.column("vector").take(pa.array(order)).to_pylist(), np.float64).reshape(len(order), -1)
        copies, tiles = (rows.column(c).to_numpy()[order] for c in ("copies", "tile"))
        count, root = compare(ids[order], nodes[order], copies, home[order], tiles, x, spaces[length], block,
                              left != right, cosine)
        found = np.flatnonzero(count)
        out = [ids[order][found], nodes[order][found], count[found], ids[order][root[found]]]
        return pa.table(dict(zip(("id", "node", "links", "root"), map(pa.array, out))))

    return dealt.groupBy("length", "block", "label", "cell", "left", "right").applyInArrow(run, schema)


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, without null or non-finite components."""
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda v: v != 0), F.lit(False))


def links(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
          cosine: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``df``.

    Two vectors are linked if their labels are equal and not null and their cosine in double precision is
    ``cosine`` or more; vectors that are null, empty, zero or hold null or non-finite components, or differ
    in length, are linked with nothing. ``n_links`` counts the other rows linked directly, equal vectors
    included; ``component_id`` is the smallest id reachable by links, ``kept`` marks the row that has it.
    Ids are whole numbers; rows with the same id are one node of the components. A row without an id has
    no component and is kept. No rows give an empty table.
    """
    rows = keep(df.select(col(f"`{id}`").alias("id"), col(f"`{label}`").alias("label"),
                          col(f"`{vector}`").alias("vector")))
    fit = rows.filter(usable(col("vector")) & col("label").isNotNull() & col("id").isNotNull())
    different = keep(fit.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                     .withColumn("node", F.xxhash64("label", "vector")).withColumn("length", F.size("vector")))
    # One row for each length of vectors, with the size of its largest label: the grid grows with it.
    largest = (different.groupBy("length", "label").agg(F.count("*").alias("n"))
               .groupBy("length").agg(F.max("n").alias("n")).collect())
    spaces = {r.length: space(r.length, cosine, 2 + max(0, int(np.log2(max(1, r.n / (8 * TILE)))))) for r in largest}
    dealt = _dealt(different, spaces).withColumn("tile_of", F.pmod(F.xxhash64("node"), F.lit(1 << 20)).cast("int"))
    dealt = keep(dealt)
    place = ["length", "block", "label", "cell"]
    large = keep(dealt.groupBy(*place).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).filter("tiles > 1"))
    tiled = (dealt.join(large, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
             .withColumn("tile", col("tile_of") % col("tiles"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), col("tiles") - 1)))
             .withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other")))
    found = keep(_compared(tiled.drop("tile_of", "tiles", "other"), spaces, cosine))
    discard(dealt)
    counts = found.groupBy("id", "node").agg(F.sum("links").alias("links"))
    equal = fit.join(different.select("label", "vector", col("id").alias("first"), "node", "copies"), ["label", "vector"])
    equal = keep(equal.select("id", "label", "vector", "first", "node", "copies"))
    edges = (found.select("id", "root").unionByName(equal.select("id", col("first").alias("root")))
             .filter(col("id") != col("root")))
    whole = components(edges)
    counted = (equal.join(counts.withColumnRenamed("id", "first"), ["first", "node"], "left")
               .select("id", "label", "vector", (col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    alone = rows.filter(~(usable(col("vector")) & col("label").isNotNull() & col("id").isNotNull()))
    counted = counted.select("id", "n_links").unionByName(alone.select("id", F.lit(0).cast("long").alias("n_links")))
    return (counted.join(whole, col("id") == col("node"), "left")
            .withColumn("component_id", F.coalesce("component", "id"))
            .select(col("id").alias(id), "n_links", "component_id",
                    F.coalesce(col("id") == col("component_id"), F.lit(True)).alias("kept")))
