"""Date and time column helpers (session zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.schemas import MONTHS_AHEAD, SEARCH_DATE_FORMAT, SEARCH_DATE_PATTERN, WEEKDAYS_SHORT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_from_text(text) -> Column:
    """``to_date(x, 'YYYY-MM')``: first of the month; a trailing ``-DD`` is ignored."""
    return F.to_date(F.substring(_c(text), 1, 7), "yyyy-MM")


def search_date_from_link(link) -> Column:
    """Date captured by ``search_date=DDMMYYYY`` in a link; NULL without a match."""
    raw = F.regexp_extract(_c(link), SEARCH_DATE_PATTERN, 1)
    return F.to_date(F.nullif(raw, F.lit("")), SEARCH_DATE_FORMAT)


def weekday_short(d) -> Column:
    """'Mon' .. 'Sun'."""
    return F.date_format(_c(d), "E")


def weekday_full(d) -> Column:
    """'Monday' .. 'Sunday'."""
    return F.date_format(_c(d), "EEEE")


def weekday_order(short) -> Column:
    """1 for Mon .. 7 for Sun (explicit sort key of the ordered categorical)."""
    return (F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS_SHORT]), _c(short))
            .cast("int"))


def days_between(later, earlier) -> Column:
    """Integer day difference ``later - earlier`` (PostgreSQL ``date - date``)."""
    return F.datediff(_c(later), _c(earlier))


def month_start(ts) -> Column:
    """``date_trunc('month', ts)::date``."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def parse_iso_ts(text) -> Column:
    """ISO-8601 text to timestamp; NULL on text that does not parse."""
    return F.try_to_timestamp(_c(text))


def month_spine_array(d, months_ahead: int = MONTHS_AHEAD) -> Column:
    """Array of 'yyyy-MM' for the month of ``d`` and ``months_ahead`` months after."""
    first = F.trunc(_c(d), "MM")
    return F.transform(F.sequence(F.lit(0), F.lit(months_ahead)),
                       lambda i: F.date_format(F.add_months(first, i), "yyyy-MM"))


def day_spine_array(d, months_ahead: int = MONTHS_AHEAD) -> Column:
    """Array of dates from ``d`` to the last day of the ``months_ahead``-th month after."""
    end = F.last_day(F.add_months(_c(d), months_ahead))
    return F.sequence(_c(d), end, F.expr("interval 1 day"))
