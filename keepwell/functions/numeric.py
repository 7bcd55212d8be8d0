"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """``part / whole`` as double, and ``empty`` for a zero whole."""
    quotient = F.try_divide(part.cast("double"), whole.cast("double"))
    return quotient if empty is None else F.coalesce(quotient, F.lit(float(empty)))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part.cast("double") * 100.0 / F.greatest(whole, F.lit(1)).cast("double"), digits)


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def as_null(value: Column) -> Column:
    """NULL in place of NaN."""
    return F.when(~F.isnan(value), value)


def slope(ys: Column) -> Column:
    """Least-squares slope of an array over positions 0..n-1; 0 for fewer than two values."""
    size = F.size(ys)
    middle = (size - 1) / F.lit(2.0)
    weighted = F.transform(ys, lambda y, i: y * (i - middle))
    spread = size * (size * size - 1) / F.lit(12.0)
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, term: acc + term)
    return F.when(size >= 2, F.try_divide(total, spread)).otherwise(F.lit(0.0))
