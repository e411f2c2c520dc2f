"""Exact, linearly interpolated quantiles of whole columns and of groups.

Whole columns are counted down: the range that holds a wanted rank is divided into equal buckets,
all columns and ranks in one pass, and the bucket that the rank falls into is the next range. Counts
merge on the map side, and a pass gives the driver a fixed number of rows whatever the size of the
table. It ends when a bucket holds one value, or few enough rows to look at them.

Groups are counted down in the same way, all of them in one pass, from a first guess: a bracket that the
mergeable ``percentile_approx`` sketch gives. The guess is never trusted. Values below and above the
bracket are counted too, and where the rank lies outside, the descent goes on there. A group is settled
once the counts prove its values; only the others are passed over again, and no values are collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..session import keep, one_row
from .columns import col

BUCKETS = 2_048
# Rows of a bucket that one row of a result may list.
FEW_ROWS = 2_048
SKETCH_ACCURACY = 1_000     # of the first guess for a group; it decides how many passes follow, nothing else
GROUP_BUCKETS = 256
_LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class _Range:
    """Values of a column from ``lo`` to ``hi``; ``below`` values of it are smaller, ``rows`` inside."""
    column: str
    lo: float
    hi: float
    below: int
    rows: int

    def bucket(self, v: Column) -> Column:
        """Number of the bucket, in order of values; the ends of a range never share one."""
        width = self.hi - self.lo
        place = ((v - F.lit(self.lo)) / F.lit(width) if math.isfinite(width)
                 else (v / 2 - F.lit(self.lo / 2)) / F.lit(self.hi / 2 - self.lo / 2)) * BUCKETS
        inside = (v >= F.lit(self.lo)) & (v <= F.lit(self.hi))
        return F.when(inside, F.least(F.floor(place), F.lit(BUCKETS - 1)).cast("int"))


def _number(name: str) -> Column:
    return _finite(col(name))


def exact_quantiles(df: DataFrame, probs: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Quantiles per column, e.g. ``{"v": [0.25, 0.75]}`` -> ``{"v": [2.0, 9.5]}``.

    Columns without values give ``None``; NaN counts as missing.
    """
    if not probs:
        return {}
    names = list(probs)
    seen = one_row(df.agg(*[a for i, c in enumerate(names) for a in (
        F.count(_number(c)).alias(f"n{i}"), F.min(_number(c)).alias(f"lo{i}"), F.max(_number(c)).alias(f"hi{i}"))]))
    whole = {c: _Range(c, seen[f"lo{i}"], seen[f"hi{i}"], 0, seen[f"n{i}"])
             for i, c in enumerate(names) if seen[f"n{i}"]}
    places = {(c, p): p * (whole[c].rows - 1) for c in whole for p in probs[c]}
    ranks = {(c, r) for (c, _), at in places.items() for r in (math.floor(at), math.ceil(at))}
    values = _at_ranks(df, {(c, r): whole[c] for c, r in ranks})

    def quantile(c: str, p: float) -> float | None:
        if c not in whole:
            return None
        at = places[c, p]
        low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    return {c: [quantile(c, p) for p in probs[c]] for c in names}


def _at_ranks(df: DataFrame, open_ranks: dict[tuple[str, int], _Range]) -> dict[tuple[str, int], float]:
    """The value at every (column, rank), counted down from the given ranges."""
    found: dict[tuple[str, int], float] = {}
    while True:
        for target, r in open_ranks.items():
            if r.lo == r.hi:
                found[target] = math.copysign(math.inf, r.lo) if abs(r.lo) == _LARGEST else r.lo
        open_ranks = {t: r for t, r in open_ranks.items() if t not in found}
        if not open_ranks:
            return found
        ranges = sorted(set(open_ranks.values()), key=lambda r: (r.column, r.lo, r.below))
        few = [r for r in ranges if r.rows <= FEW_ROWS]
        listed = _listed(df, few) if few else {}
        counted = _counted(df, [r for r in ranges if r.rows > FEW_ROWS])
        for (c, rank), r in list(open_ranks.items()):
            if r in listed:
                v = listed[r][rank - r.below]
                open_ranks[c, rank] = _Range(c, v, v, rank, 1)
                continue
            below = r.below
            for lo, hi, rows in counted[r]:
                if rank < below + rows:
                    open_ranks[c, rank] = _Range(c, lo, hi, below, rows)
                    break
                below += rows


def _listed(df: DataFrame, ranges: list[_Range]) -> dict[_Range, list[float]]:
    """The values of ranges with few rows, in order."""
    def inside(r: _Range) -> Column:
        v = _number(r.column)
        return F.when((v >= F.lit(r.lo)) & (v <= F.lit(r.hi)), v)
    row = one_row(df.agg(*[F.sort_array(F.collect_list(inside(r))).alias(f"v{i}") for i, r in enumerate(ranges)]))
    return {r: row[f"v{i}"] for i, r in enumerate(ranges)}


def _counted(df: DataFrame, ranges: list[_Range]) -> dict[_Range, list[tuple[float, float, int]]]:
    """Per range its non-empty buckets in order: smallest and largest value, rows."""
    if not ranges:
        return {}
    places = F.array(*[F.struct(F.lit(i).alias("range"), r.bucket(_number(r.column)).alias("bucket"),
                                _number(r.column).alias("v")) for i, r in enumerate(ranges)])
    rows = (df.select(F.inline(places)).filter(F.col("bucket").isNotNull()).groupBy("range", "bucket")
            .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("rows")).collect())
    out: dict[_Range, list[tuple[float, float, int]]] = {r: [] for r in ranges}
    for row in sorted(rows, key=lambda x: (x.range, x.bucket)):
        out[ranges[row.range]].append((row.lo, row.hi, row.rows))
    return out


def group_brackets(values: dict[str, Column], p: float,
                   accuracy: int = SKETCH_ACCURACY) -> list[Column]:
    """Aggregates ``__n_<name>``, ``__lo_<name>``, ``__hi_<name>`` per value: its rows in the group
    and a guess of two of its values that enclose quantile ``p``. The sketches merge, so a huge group is
    combined on the map side."""
    slack, out = 2.0 / accuracy, []
    for name, v in values.items():
        v = _finite(v)
        near = F.percentile_approx(v, F.array(
            F.lit(max(p - slack, 0.0)), F.lit(min(p + slack, 1.0))), F.lit(accuracy))
        out += [F.count(v).alias(f"__n_{name}"), near[0].alias(f"__lo_{name}"), near[1].alias(f"__hi_{name}")]
    return out


def quantiles_in_brackets(df: DataFrame, brackets: DataFrame, keys: Sequence[str],
                          values: dict[str, Column], p: float) -> DataFrame:
    """(keys, names): quantile ``p`` of every value per group, exact whatever the brackets.

    ``brackets`` has the columns of ``group_brackets`` and should be a written table, so that its size
    decides how it is joined. Groups without values have nulls.
    """
    keys = list(keys)
    by = [*[col(k) for k in keys], col("__value")]
    names = [*keys, "__value"]
    rows = df.select(*by[:-1], F.inline(F.array(*[
        F.struct(F.lit(i).alias("__value"), _finite(v).alias("__v")) for i, v in enumerate(values.values())]))
    ).filter(col("__v").isNotNull())
    open_ = brackets.select(*by[:-1], F.inline(F.array(*[
        F.struct(F.lit(i).alias("__value"), col(f"__n_{n}").alias("__n"), col(f"__lo_{n}").cast("double").alias("__lo"),
                 col(f"__hi_{n}").cast("double").alias("__hi")) for i, n in enumerate(values)]))
    ).filter("__n > 0").select(
        *by, F.floor((col("__n") - 1) * F.lit(float(p))).alias("__rank"), F.lit(0).cast("long").alias("__below"),
        "__lo", "__hi", F.lit(None).cast("double").alias("__next"))
    v, lo, hi = col("__v"), col("__lo"), col("__hi")
    place = F.floor(F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2) * GROUP_BUCKETS)
    bucket = (F.when(v < lo, -1).when(v > hi, GROUP_BUCKETS).when(v == lo, 0).when(v == hi, GROUP_BUCKETS - 1)
              .otherwise(F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(GROUP_BUCKETS - 1)))).cast("int")
    in_order = Window.partitionBy(*by).orderBy("__bucket")
    settled, guessed = [], True
    while True:
        met = rows.join(open_, names)
        if not guessed:         # the range is known to hold the rank
            met = met.filter((v >= lo) & (v <= hi))
        counted = met.groupBy(*by, bucket.alias("__bucket")).agg(
            F.count("*").alias("__rows"), F.min(v).alias("__from"), F.max(v).alias("__to"),
            *[F.first(c).alias(c) for c in ("__rank", "__below", "__next")])
        so_far = col("__below") + F.coalesce(F.sum("__rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        chosen = counted.select(
            *by, "__rank", "__rows", so_far.alias("__below"), col("__from").alias("__lo"), col("__to").alias("__hi"),
            F.coalesce(F.lead("__from").over(in_order), col("__next")).alias("__next")).filter(
            (col("__below") <= col("__rank")) & (col("__rank") < col("__below") + col("__rows")))
        # Both values of a range of two rows are known: its ends.
        known = (lo == hi) | (col("__rows") <= 2)
        seen = Observation()    # counted while the state is written
        state = keep(chosen.observe(seen, F.count_if(~known).alias("open")))
        at_first = col("__rank") == col("__below")
        more = (lo == hi) & (col("__rank") + 1 < col("__below") + col("__rows"))
        settled.append(state.filter(known).select(
            *by, F.when(at_first, lo).otherwise(hi).alias("__at"),
            F.when(more, lo).when(at_first & (lo < hi), hi).otherwise(col("__next")).alias("__above")))
        open_ = state.filter(~known).drop("__rows")
        guessed = False
        if not seen.get["open"]:
            break
    found = reduce(DataFrame.unionByName, settled)
    own = brackets.select(*by[:-1], F.inline(F.array(*[
        F.struct(F.lit(i).alias("__value"), col(f"__n_{n}").alias("__n")) for i, n in enumerate(values)])))
    part = (col("__n") - 1) * F.lit(float(p)) - F.floor((col("__n") - 1) * F.lit(float(p)))
    at, above = _restored(col("__at")), _restored(col("__above"))
    value = F.when((part > 0) & (above > at), at + (above - at) * part).otherwise(at)
    return own.join(found, names, "left").groupBy(*by[:-1]).agg(
        *[F.max(F.when(col("__value") == i, value)).alias(n) for i, n in enumerate(values)])


def _finite(v: Column) -> Column:
    """Finite doubles: NaN counts as missing, infinities as the largest numbers."""
    v = v.cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), F.greatest(F.least(v, F.lit(_LARGEST)), F.lit(-_LARGEST)))


def _restored(v: Column) -> Column:
    return F.when(F.abs(v) == F.lit(_LARGEST), F.signum(v) * F.lit(math.inf)).otherwise(v)


def quantile_by_group(df: DataFrame, keys: Sequence[str], values: dict[str, Column],
                      p: float, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Guessed brackets, then exact quantiles; reads ``df`` twice, and again for groups that are still open."""
    brackets = keep(df.groupBy(*[col(k) for k in keys]).agg(*group_brackets(values, p, accuracy)))
    return quantiles_in_brackets(df, brackets, keys, values, p)
