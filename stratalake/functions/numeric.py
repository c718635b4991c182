"""Exact decimal arithmetic; nothing here passes through a double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(20,0)"


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def half_up_ratio(numerator: Column, count: Column, scale: int) -> Column:
    """``numerator / count`` rounded half away from zero; NULL when the count is 0."""
    return F.round(numerator / F.nullif(count.cast(WHOLE), F.lit(0).cast(WHOLE)), scale)


def percent_of(part: Column, whole: Column, scale: int = 1) -> Column:
    """``100 * part / whole`` rounded half away from zero; NULL when the whole is 0."""
    divisor = F.nullif(whole.cast(WHOLE), F.lit(0).cast(WHOLE))
    return F.round(part.cast(WHOLE) * F.lit(100) / divisor, scale)


def cents_to_money(cents: Column, dtype: str = "decimal(10,2)") -> Column:
    """Whole cents as an amount with two decimals; an amount beyond ``dtype`` raises."""
    return (cents.cast(WHOLE) * F.lit("0.01").cast("decimal(3,2)")).cast(dtype)
