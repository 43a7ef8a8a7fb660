"""Null-, zero- and NaN-safe arithmetic as Column expressions.

All helpers return plain Catalyst expressions (CASE WHEN, division, ...), so
they stay inside whole-stage codegen.  Semantics follow IEEE division as the
reference computes it: ``x / 0`` is +/-Infinity by the sign of ``x`` and
``0 / 0`` is NaN, which we turn into NULL so that it never passes a ``>``
predicate (Spark orders NaN above every number).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POS_INF = float("inf")
NEG_INF = float("-inf")


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL; everything else unchanged."""
    return F.nanvl(c, F.lit(None).cast("double"))


def _signed_inf(numerator: Column) -> Column:
    return (F.when(numerator > 0, F.lit(POS_INF))
             .when(numerator < 0, F.lit(NEG_INF))
             .otherwise(F.lit(None).cast("double")))


def percent_change(curr: Column, prev: Column) -> Column:
    """``(curr / prev - 1) * 100`` with the operation order of the reference.

    NULL when either side is NULL; +/-Infinity when ``prev == 0`` and
    ``curr != 0``; NULL for ``0 / 0``.
    """
    return (F.when(curr.isNull() | prev.isNull(), F.lit(None).cast("double"))
             .when(prev != 0, (curr / prev - 1) * 100)
             .otherwise(_signed_inf(curr)))


def period_gain(first: Column, last: Column) -> Column:
    """``(last - first) / first * 100`` with the same zero rules."""
    return (F.when(first.isNull() | last.isNull(), F.lit(None).cast("double"))
             .when(first != 0, (last - first) / first * 100)
             .otherwise(_signed_inf(last - first)))


def round_half_even_long(c: Column) -> Column:
    """Python's ``round(x)`` for money: banker's rounding to a whole number."""
    return F.bround(c, 0).cast("bigint")
