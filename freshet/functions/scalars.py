"""Scalar and aggregate column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_to_ts(seconds: str | Column) -> Column:
    """Epoch seconds (double, so fractions survive) to a timestamp."""
    return as_column(seconds).cast("double").cast("timestamp")


def iso_to_ts(text: str | Column) -> Column:
    """ISO-8601 text to a timestamp; text that is no timestamp gives null."""
    return F.try_to_timestamp(as_column(text))


def calendar_date(ts: str | Column) -> Column:
    return F.to_date(as_column(ts))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(as_column(a), as_column(b))


def exact_units(value: str | Column, digits: int = 2) -> Column:
    """A fixed-point number as whole units, so sums do not depend on row order."""
    return F.round(as_column(value) * float(10**digits)).cast("long")


def exact_sum(value: str | Column, digits: int = 2) -> Column:
    return F.sum(exact_units(value, digits)).cast("double") / float(10**digits)


def exact_avg(value: str | Column, digits: int = 2) -> Column:
    units = exact_units(value, digits)
    return F.sum(units).cast("double") / F.count(units) / float(10**digits)


def count_true(condition: str | Column) -> Column:
    """Rows for which the condition holds; null counts as false."""
    return F.count_if(F.expr(condition) if isinstance(condition, str) else condition)


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Turns NaN into null, so means and counts skip it."""
    floating = (T.FloatType, T.DoubleType)
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, floating)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        c: F.when(~F.isnan(c), F.col(c)) for c in chosen if isinstance(kinds[c], floating)
    }
    return df.withColumns(changed) if changed else df


def plain_number(column: str | Column) -> Column:
    """A double as text without an exponent up to 1e16, such as 15000000.0."""
    value = as_column(column)
    digits = value.cast("string").cast("decimal(38,17)").cast("string")
    whole = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    large = (F.abs(value) >= 1e7) & (F.abs(value) < 1e16)
    return F.when(large, whole).otherwise(value.cast("string"))
