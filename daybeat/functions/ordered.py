"""Row-order operators that never sort one key, or one table, in a single task.

A long ordered run is cut into chunks: by a column the caller names (a day, a block of record
numbers), or, with ``RANGES``, by sampled splits of the order itself, which are even whatever its
values. Windows run inside (key, chunk) and their result is written once; one summary row per
chunk carries positions and values across the cuts and is joined back. Without keys, or with ranges,
the summary rows are scanned in levels: blocks of them first, then blocks of blocks. Without a chunk
column the window spans the whole key: use that where the key has at most one row per
calendar step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import keep, one_row
from .columns import col

_POS, _CHUNK, _GROUP = "__pos", "__chunk", "__group"
RANGES = "ranges"           # chunks by sampled splits of the order
SCAN = 256                  # chunks, or blocks of chunks, that are scanned in one window
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _shift(point: Column, base: Column) -> Column:
    return F.when(point.isNotNull(),
                  F.struct((point["pos"] + base).alias("pos"), point["val"].alias("val")))


def in_ranges(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``__chunk``: numbers that rise with (keys, order), of about as many rows each.

    Rows that agree in all these columns share a chunk.
    """
    return (df.repartitionByRange(*[col(c) for c in (*keys, *order)])
            .withColumn(_CHUNK, F.spark_partition_id().cast("long")))


def _most_ranges(df: DataFrame) -> int:
    """Bound of the chunk numbers of ``in_ranges``."""
    conf = df.sparkSession.conf
    return max(int(conf.get("spark.sql.shuffle.partitions")),
               int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0))


def _scanned(totals: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add to the summary rows of chunks what lies before and behind them within ``by``."""
    within = Window.partitionBy(*[col(c) for c in by])
    earlier = within.orderBy(_CHUNK).rowsBetween(*_BEFORE)
    later = within.orderBy(col(_CHUNK).desc()).rowsBetween(*_BEFORE)
    based = totals.withColumn("__base", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    return based.select(
        "*", *[F.last(_shift(col(f"__last_{n}"), col("__base")), True).over(earlier).alias(f"__before_{n}")
               for n in names],
        *[F.last(_shift(col(f"__first_{n}"), col("__base")), True).over(later).alias(f"__after_{n}")
          for n in names])


def _in_levels(totals: DataFrame, keys: Sequence[str], names: Sequence[str], most: int) -> DataFrame:
    """``_scanned`` over chunk numbers below ``most``: inside blocks, and then over the blocks' own summaries."""
    grouped = totals.withColumn(_GROUP, F.floor(col(_CHUNK) / F.lit(SCAN)))
    inner = _scanned(grouped, [*keys, _GROUP], names)
    if most <= SCAN:
        return inner.drop(_GROUP)
    outer = _in_levels(
        inner.groupBy(*[col(k) for k in keys], col(_GROUP).alias(_CHUNK)).agg(
            F.sum("__rows").alias("__rows"),
            *[a for n in names for a in (F.max(_shift(col(f"__last_{n}"), col("__base"))).alias(f"__last_{n}"),
                                         F.min(_shift(col(f"__first_{n}"), col("__base"))).alias(f"__first_{n}"))]),
        keys, names, -(-most // SCAN))
    outer = outer.select(*[col(k) for k in keys], col(_CHUNK).alias(_GROUP), col("__base").alias("__outer"),
                         *[col(f"__{side}_{n}").alias(f"__{side}_outer_{n}") for n in names for side in ("before", "after")])
    base = col("__outer")
    return _same(inner, outer, [*keys, _GROUP]).select(
        *[col(c) for c in totals.columns], (col("__base") + base).alias("__base"),
        *[F.coalesce(_shift(col(f"__{side}_{n}"), base), col(f"__{side}_outer_{n}")).alias(f"__{side}_{n}")
          for n in names for side in ("before", "after")])


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal columns; nulls are equal."""
    right = right.withColumnsRenamed({c: f"__on_{c}" for c in on})
    condition = [left[f"`{c}`"].eqNullSafe(right[f"`__on_{c}`"]) for c in on]
    return left.join(right, condition, "left").drop(*[f"__on_{c}" for c in on])


def _with_neighbours(df: DataFrame, values: dict[str, Column], order: Sequence[str],
                     keys: Sequence[str], chunk: Column | str | None) -> DataFrame:
    """Add ``__pos`` and, per value, structs ``__prev_<name>`` / ``__next_<name>``: the nearest
    non-null value at or before / at or after the row with its position."""
    keys, names = list(keys), df.columns
    ranges = isinstance(chunk, str)
    if ranges:
        df = in_ranges(df, order, keys)
    elif chunk is not None:
        df = df.withColumn(_CHUNK, chunk)
    inside = keys + ([_CHUNK] if chunk is not None else [])
    by = Window.partitionBy(*[col(k) for k in inside])
    in_order = by.orderBy(*[col(o) for o in order])
    placed = df.withColumn(_POS, F.row_number().over(in_order).cast("long"))
    forward = in_order.rowsBetween(*_SO_FAR)      # same sort as the row number
    backward = by.orderBy(col(_POS).desc()).rowsBetween(*_SO_FAR)
    points = {n: F.when(v.isNotNull(), F.struct(col(_POS).alias("pos"), v.alias("val")))
              for n, v in values.items()}
    placed = placed.select(
        "*", *[F.last(p, True).over(forward).alias(f"__prev_{n}") for n, p in points.items()],
        *[F.last(p, True).over(backward).alias(f"__next_{n}") for n, p in points.items()])
    if chunk is None:
        return placed
    placed = keep(placed)       # read twice: for the summary and for the rows
    totals = placed.groupBy(*[col(k) for k in inside]).agg(
        F.count("*").alias("__rows"),
        *[a for n in values for a in (F.max(f"__prev_{n}").alias(f"__last_{n}"),
                                      F.min(f"__next_{n}").alias(f"__first_{n}"))])
    if ranges:
        carries = _in_levels(totals, keys, list(values), _most_ranges(df))
    elif keys:                  # a key has a calendar's number of chunks
        carries = _scanned(totals, keys, list(values))
    else:                       # any chunks: numbered from zero first
        named = "__named"
        totals = totals.withColumnRenamed(_CHUNK, named)
        numbers = row_positions(totals.select(named), [named], chunk=RANGES).select(
            named, (col(_POS) - 1).alias(_CHUNK))
        most = one_row(numbers.agg(F.coalesce(F.max(_CHUNK) + 1, F.lit(1))))[0]
        carries = (_in_levels(_same(totals, numbers, [named]), keys, list(values), most)
                   .drop(_CHUNK).withColumnRenamed(named, _CHUNK))
    joined = _same(placed, carries.drop("__rows", *[f"__{s}_{n}" for n in values for s in ("last", "first")]), inside)
    base = F.coalesce(col("__base"), F.lit(0))
    return joined.select(
        *[col(c) for c in names], (col(_POS) + base).alias(_POS),
        *[F.coalesce(_shift(col(f"__prev_{n}"), base), col(f"__before_{n}")).alias(f"__prev_{n}")
          for n in values],
        *[F.coalesce(_shift(col(f"__next_{n}"), base), col(f"__after_{n}")).alias(f"__next_{n}")
          for n in values])


def _names(cols: Sequence[str]) -> dict[str, str]:
    return {c: f"c{i}" for i, c in enumerate(cols)}


def fill(df: DataFrame, linear: Sequence[str], forward: Sequence[str], order: Sequence[str],
         keys: Sequence[str] = (), chunk: Column | str | None = None) -> DataFrame:
    """Fill two groups of columns in one pass over the ordered rows.

    ``linear``: by row position between neighbours, then the last, then the next value; the
    result is double. ``forward``: the last value. Rows with a null key are left as they are.
    """
    if not linear and not forward:
        return df
    names = _names([*linear, *forward])
    values = {names[c]: col(c).cast("double") if c in linear else col(c) for c in names}
    wide = _with_neighbours(df, values, order, keys, chunk)
    known = [col(k).isNotNull() for k in keys]

    def filled(c: str) -> Column:
        own, prev, nxt = values[names[c]], col(f"__prev_{names[c]}"), col(f"__next_{names[c]}")
        value = F.coalesce(own, prev["val"])
        if c in linear:
            rise = F.try_divide((nxt["val"] - prev["val"]) * (col(_POS) - prev["pos"]),
                                (nxt["pos"] - prev["pos"]).cast("double"))
            value = F.coalesce(own, prev["val"] + rise, prev["val"], nxt["val"])
        for k in known:
            value = F.when(k, value).otherwise(own)
        return value.alias(c)

    return wide.select(*[filled(c) if c in names else col(c) for c in df.columns])


def interpolate(df: DataFrame, cols: Sequence[str], order: Sequence[str],
                keys: Sequence[str] = (), chunk: Column | str | None = None) -> DataFrame:
    """Fill nulls linearly by row position, then with the last, then with the next value."""
    return fill(df, cols, (), order, keys, chunk)


def carry_forward(df: DataFrame, cols: Sequence[str], order: Sequence[str],
                  keys: Sequence[str] = (), chunk: Column | str | None = None) -> DataFrame:
    """Replace nulls by the last value before them in row order."""
    return fill(df, (), cols, order, keys, chunk)


def previous_value(df: DataFrame, name: str, value: str, order: Sequence[str],
                   keys: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """Add ``name``: the value of the row before, null on the first row of a key."""
    keys = list(keys)
    if chunk is not None:
        df = df.withColumn(_CHUNK, chunk)
    inside = keys + ([_CHUNK] if chunk is not None else [])
    by = Window.partitionBy(*[col(k) for k in inside]).orderBy(*[col(o) for o in order])
    lagged = df.withColumn(name, F.lag(col(value)).over(by))
    if chunk is None:
        return lagged
    ends = df.groupBy(*[col(k) for k in inside]).agg(
        F.max_by(col(value), F.struct(*[col(o) for o in order])).alias("__end"))
    before = ends.withColumn("__end", F.lag("__end").over(
        Window.partitionBy(*[col(k) for k in keys]).orderBy(_CHUNK)))
    first = F.row_number().over(by) == 1
    return (lagged.withColumn("__first", first).join(before, inside, "left")
            .withColumn(name, F.when(col("__first"), col("__end")).otherwise(col(name)))
            .drop(_CHUNK, "__first", "__end"))


def record_block(column: str, size: int = 100_000) -> Column:
    """Chunk of a unique whole-number order column: at most ``size`` rows each."""
    return F.floor(col(column) / F.lit(size))


def time_block(column: str, unit: str = "day") -> Column:
    """Chunk of a time-ordered run: one calendar day, month or year."""
    return F.date_trunc(unit, col(column)).cast("date")


def row_positions(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
                  chunk: Column | str | None = None) -> DataFrame:
    """Add ``__pos``: the row's number, from 1, in the stated order."""
    wide = _with_neighbours(df, {}, order, keys, chunk)
    return wide.select(*[col(c) for c in df.columns], _POS)
