"""Null-safe arithmetic under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or(value: Column, fill: float) -> Column:
    """NULL, NaN and infinities become ``fill``."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(fill))).otherwise(value)


def missing(value: Column) -> Column:
    """NULL or NaN."""
    return value.isNull() | F.isnan(value)


def present(value: Column, what: str) -> Column:
    """The value; the job fails where it is NULL or NaN, so that no row goes missing unseen."""
    return F.when(missing(value), F.raise_error(F.lit(
        f"{what} is missing in some rows: score them, leave them out or count them apart"))).otherwise(value)


def safe_div(top: Column, bottom: Column, fill: float = 0.0) -> Column:
    """Division that never raises; an undefined result becomes ``fill``."""
    return finite_or(F.try_divide(top.cast("double"), bottom.cast("double")), fill)


def ratio(top: Column, bottom: Column) -> Column:
    """Rate of two counts, 0 on an empty denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (greatest and least alone would skip it)."""
    out = value
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    return F.when(value.isNotNull(), out)


def log1p_floor0(value: Column) -> Column:
    """log(1 + max(value, 0)); NULL stays NULL."""
    return F.when(value.isNotNull(), F.log1p(F.greatest(value.cast("double"), F.lit(0.0))))
