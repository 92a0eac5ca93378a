"""Rounding, clamping and money helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column, digits: int = 2) -> Column:
    """Round half up on the scaled double; the one rounding rule used for every amount."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def clip(x: Column, low: float | Column | None, high: float | Column | None) -> Column:
    """Clamp to [low, high]; a missing value stays missing, unlike bare least/greatest."""
    y = x
    if high is not None:
        y = F.least(y, high if isinstance(high, Column) else F.lit(float(high)))
    if low is not None:
        y = F.greatest(y, low if isinstance(low, Column) else F.lit(float(low)))
    return F.when(x.isNotNull(), y)


def discount_pct(initial: Column, offer: Column) -> Column:
    """Percent off when both prices are present and non-zero and the offer is lower; a tiny discount rounds to 0, not to null."""
    return F.when((initial > 0) & (offer != 0) & (initial > offer), half_up(F.try_divide(initial - offer, initial) * 100.0))


def ratio_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole`` in percent, 0 for an empty whole."""
    return F.coalesce(half_up(F.try_divide(part * 100.0, whole), digits), F.lit(0.0))


def exact_mean(x: Column, scale: int = 4) -> Column:
    """Mean whose sum does not depend on the order of the rows (values are summed as decimals)."""
    return F.sum(x.cast(f"decimal(28,{scale})")).cast("double") / F.count(x)
