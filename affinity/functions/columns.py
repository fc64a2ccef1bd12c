"""Scalar column expressions.

Numeric policy: a scaled user-item weight is rounded to 9 decimal places and carried
as an exact integer count of 1e-9 units (LONG). Every sum over such weights is an
integer sum -- exact, independent of partitioning and summation order, and cheap in
generated code (no BigDecimal). A weight becomes DOUBLE once, as ``units / 1e9``
(correctly rounded, since the integer is exact in a double below 2**53), before the
first division. ``exp`` and ``ln`` are the only inexact functions; their results are
rounded to 9 places immediately.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

# Fixed value: weights are kept in units of 1e-9.
UNITS_PER_WEIGHT = 1_000_000_000
ROUND_PLACES = 9
WEIGHT_TYPE = LongType()


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _c(c).cast(DoubleType())


def units_lit(x: float | int | str) -> Column:
    """Exact unit count of a threshold such as ``min_link_weight`` (0.25 -> 250000000)."""
    d = Decimal(repr(x) if isinstance(x, float) else str(x)) * UNITS_PER_WEIGHT
    return F.lit(int(d.quantize(Decimal(1), rounding=ROUND_HALF_UP))).cast(LongType())


def to_units(c: Column | str) -> Column:
    """DOUBLE weight -> LONG units, rounding half up at the 9th decimal place.

    Exact inverse of ``units_to_double`` for any unit count below 2**52.
    """
    return F.floor(to_double(c) * F.lit(float(UNITS_PER_WEIGHT)) + F.lit(0.5)).cast(LongType())


def units_to_double(c: Column | str) -> Column:
    return _c(c).cast(DoubleType()) / F.lit(float(UNITS_PER_WEIGHT))


def logistic_scale(weight: Column | str, k: float) -> Column:
    """Diminishing-returns scaling ``2 / (1 + exp(-k * w)) - 1`` in LONG units.

    Maps 0 to 0, is odd (negative evidence stays negative) and stays below 1.
    """
    w = to_double(weight)
    scaled = F.lit(2.0) / (F.lit(1.0) + F.exp(F.lit(-float(k)) * w)) - F.lit(1.0)
    return to_units(scaled)


def reciprocal(c: Column | str) -> Column:
    """``1 / x`` with NULL instead of an error for zero."""
    return F.try_divide(F.lit(1.0), to_double(c))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def clamp_at_zero(c: Column | str) -> Column:
    """``max(x, 0)``; NULL counts as no evidence, i.e. 0."""
    return F.greatest(F.coalesce(_c(c), F.lit(0.0)), F.lit(0.0))


def pop_boost(overall_weight: Column, func: str) -> Column:
    """Popularity boost applied to the target item's overall weight: SQRT, LOG or '' (linear)."""
    f = (func or "").strip().upper()
    if f == "SQRT":
        return F.sqrt(overall_weight)
    if f == "LOG":
        return F.round(F.ln(overall_weight), ROUND_PLACES)
    if f in ("", "LINEAR"):
        return overall_weight
    raise ValueError(f"unknown popularity boost function {func!r}; use 'SQRT', 'LOG' or ''")
