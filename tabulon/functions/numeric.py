"""Small numeric expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def clip(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a column on one or both sides, NULL stays NULL."""
    out = col
    if low is not None:
        out = F.when(out < F.lit(low), F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > F.lit(high), F.lit(high)).otherwise(out)
    return F.when(col.isNotNull(), out)


def ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """Division that gives ``default`` (NULL if none) where the denominator is zero."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def log_base(col: Column, base: float) -> Column:
    return F.log(float(base), col)


def first_argmax(values: Column) -> Column:
    """0-based position of the first maximum of an array."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def tidy(col: Column, digits: int = 6) -> Column:
    """Round for reports; negative zero becomes zero."""
    return F.round(col.cast("double"), digits) + F.lit(0.0)
