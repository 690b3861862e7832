"""Text to value: the raw loan cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.44


def leading_number(cell: Column) -> Column:
    """First run of digits as a double, NULL when there is none."""
    return F.regexp_substr(cell.cast("string"), F.lit(r"\d+")).try_cast("double")


def parse_term(cell: Column) -> Column:
    return leading_number(cell)


def parse_emp_length(cell: Column) -> Column:
    """'10+ years' -> 10, '< 1 year' -> 0, 'n/a' -> NULL."""
    return F.when(cell.contains("< 1"), F.lit(0.0)).otherwise(leading_number(cell))


def parse_percent(cell: Column) -> Column:
    """'13.5%' -> 13.5; text that is no number -> NULL."""
    return F.trim(F.replace(cell, F.lit("%"), F.lit(""))).try_cast("double")


def parse_month(cell: Column) -> Column:
    """'Jan-2015' -> 2015-01-01; text that is no month -> NULL."""
    return F.try_to_timestamp(cell, F.lit("MMM-yyyy")).cast("date")


def months_between_days(start: Column, reference: Column) -> Column:
    """Whole months of 30.44 days from ``start`` to ``reference``.

    A tie cannot occur for whole days, so the rounding mode is immaterial.
    """
    return F.round(F.datediff(reference, start) / F.lit(DAYS_PER_MONTH)).cast("int")
