"""Imputation of numeric gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col
from ..functions.ordered import RANGES, interpolate
from ..functions.quantiles import exact_quantiles, quantile_by_group
from ..session import discard, keep, one_row


def interpolate_by_key(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                       chunk: Column | None = None) -> DataFrame:
    """Per user: linear by row position, then last value, then next value."""
    return interpolate(df, cols, order, [key], chunk)


def interpolate_all(df: DataFrame, order: Sequence[str], cols: Sequence[str],
                    chunk: Column | str = RANGES) -> DataFrame:
    """The same over the whole table, cut into even ranges of its order unless ``chunk`` says otherwise."""
    return interpolate(df, cols, order, (), chunk)


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remaining nulls become the column median; a column without values stays null.

    The columns are written once, so that null counts and quantile passes do not compute ``df`` again.
    """
    if not cols:
        return df
    values = keep(df.select(*[col(c) for c in cols]))
    row = one_row(values.agg(*[F.count_if(col(c).isNull()) for c in cols]))
    gaps = [c for c, n in zip(cols, row) if n]
    medians = {c: q[0] for c, q in exact_quantiles(values, {c: [0.5] for c in gaps}).items()}
    discard(values)
    return df.withColumns({
        c: F.coalesce(col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in cols})


def fill_median_by_key(df: DataFrame, key: str, cols: Sequence[str],
                       few_values: bool = False) -> DataFrame:
    """Nulls become that user's median; users without any value stay null.

    Medians are aggregated and joined back, so no user is buffered by a window. With
    ``few_values`` the caller vouches that a user has few distinct values (such as one per
    calendar day); they are then simply counted. Otherwise medians come from brackets.
    """
    names = {c: f"m{i}" for i, c in enumerate(cols)}
    if few_values:
        medians = df.groupBy(col(key)).agg(
            *[F.percentile(col(c), F.lit(0.5)).alias(n) for c, n in names.items()])
    else:
        medians = quantile_by_group(df, [key], {n: col(c).cast("double") for c, n in names.items()}, 0.5)
    medians = medians.withColumnsRenamed({n: f"__{n}" for n in names.values()})
    return df.join(medians, key, "left").select(*[
        F.coalesce(col(c).cast("double"), col(f"__{names[c]}")).alias(c) if c in names else col(c)
        for c in df.columns])
