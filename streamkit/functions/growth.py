"""Compound growth as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compound_growth(balance, rate, periods: int) -> Column:
    """``balance`` grown ``periods`` times by ``(1 + rate)``, multiplied one
    period at a time (a left fold, bit-equal to the sequential loop)."""
    b = F.col(balance) if isinstance(balance, str) else balance
    r = F.lit(rate) if isinstance(rate, (int, float)) else rate
    factor = F.lit(1.0) + r
    return F.aggregate(F.sequence(F.lit(1), F.lit(periods)), b.cast("double"), lambda acc, _i: acc * factor)
