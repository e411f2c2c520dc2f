"""Column selection by type and small formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def col(name: str) -> Column:
    """Column by exact name, also when it holds blanks, dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, leave_out: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in leave_out]


def text_columns(df: DataFrame, leave_out: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in leave_out]


def first_column(df: DataFrame, *words: str) -> str | None:
    """First column whose lower-cased name contains one of the words."""
    return next((c for c in df.columns if any(w in c.lower() for w in words)), None)


def flag(condition: Column) -> Column:
    """Comparison with a missing value counts as false."""
    return F.coalesce(condition, F.lit(False))


def joined_reasons(*reasons: tuple[Column, str | Column], default: str = "") -> Column:
    """Comma-separated texts of the conditions that hold."""
    parts = [F.when(flag(cond), text if isinstance(text, Column) else F.lit(text))
             for cond, text in reasons]
    text = F.concat_ws(", ", *parts)
    return F.when(text == "", F.lit(default)).otherwise(text) if default else text


def as_date(c: Column) -> Column:
    return F.to_date(c)


def half_even(c: Column, digits: int) -> Column:
    """Round half to even on the decimal value, after dropping float noise beyond nine places."""
    return F.bround(c.cast("decimal(30,9)"), digits).cast("double")


def fixed(c: Column, digits: int) -> Column:
    """``c`` cut to ``digits`` decimals with the same IEEE steps in every engine.

    The rounding point lies a little off one half: averages of two-decimal values often end
    in an exact 5, where float noise of the summation order would decide.
    """
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5003)) / F.lit(scale)
