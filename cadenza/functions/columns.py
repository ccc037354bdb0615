"""Scalar column expressions.

All of these are plain ``pyspark.sql.functions`` compositions, so they stay inside
whole-stage codegen and are pushed wherever Catalyst moves the projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def compressed(col: str | Column) -> Column:
    """Log compression of a count or weight: ``log1p(1 + x)``, i.e. ln(2 + x)."""
    return F.log1p(F.lit(1) + _c(col))


def decay(position: str | Column) -> Column:
    """Exponential recency weight ``exp(1 - position)``: 1.0 for position 1."""
    return F.exp(F.lit(1) - _c(position))


def threshold(col: str | Column, t: float = 4.0) -> Column:
    """Binary label 1.0 when ``col >= t``, else 0.0 (a null value gives 0.0)."""
    return F.when(_c(col) >= F.lit(t), F.lit(1.0)).otherwise(F.lit(0.0))


def fallback(primary: str | Column, secondary: str | Column) -> Column:
    """``primary`` unless it is null, then ``secondary``."""
    return F.coalesce(_c(primary), _c(secondary))


def discount(position: str | Column) -> Column:
    """DCG gain of a hit at 1-based ``position``: 1 / log2(position + 1)."""
    return F.lit(1.0) / F.log2(_c(position) + F.lit(1))
