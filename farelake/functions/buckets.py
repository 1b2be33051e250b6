"""Bucketing expressions (price band, direct flag, lead-time bins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.schemas import CHEAP_BELOW, LEAD_BIN_EDGES, LEAD_BIN_LABELS, MEDIUM_UP_TO


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_bucket(price) -> Column:
    """cheap / medium / expensive; a NULL price falls to 'expensive' (CASE ELSE)."""
    p = _c(price)
    return (F.when(p < CHEAP_BELOW, "cheap")
            .when(p.between(CHEAP_BELOW, MEDIUM_UP_TO), "medium")
            .otherwise("expensive"))


def is_direct(transfers) -> Column:
    """True when no transfers; NULL transfers give false."""
    return F.when(_c(transfers) == 0, True).otherwise(False)


def lead_bucket(days, include_lowest: bool = False) -> Column:
    """Right-closed bins ``(lo, hi]``; day 0 is in no bin unless ``include_lowest``."""
    d = _c(days)
    expr = None
    for i, label in enumerate(LEAD_BIN_LABELS):
        lo, hi = LEAD_BIN_EDGES[i], LEAD_BIN_EDGES[i + 1]
        cond = (d > lo) & (d <= hi)
        if include_lowest and i == 0:
            cond = (d >= lo) & (d <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def lead_bucket_order(label) -> Column:
    """1-based position of a bin label."""
    return (F.array_position(F.array(*[F.lit(x) for x in LEAD_BIN_LABELS]), _c(label))
            .cast("int"))
