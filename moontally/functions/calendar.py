"""Billing-month calendar.

A billing month runs from the 20th of one Persian (Solar Hijri) month to the 19th of
the next.  Its index is ``12 * year + month``, plus one from day 20 on, so consecutive
months have consecutive indices across new year as well.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the arithmetic Persian calendar (33-year leap cycle).
_DAY_ZERO = dt.date(1600, 1, 1)
_OFFSET_DAYS = 79  # 1600-03-20 is the last day of Persian year 978
_FIRST_YEAR = 979
_CYCLE_DAYS = 12053  # 33 years
_SUBCYCLE_DAYS = 1461  # 4 years
_FIRST_LEAP = 366
_LONG_MONTHS_DAYS = 186  # six months of 31 days
_CLOSING_DAY = 20

DATE_KEY_FORMAT = "yyyyMMdd"
TIMESTAMP_FORMAT = "yyyyMMdd HH:mm:ss"


def _div(value: Column, by: int) -> Column:
    """Integer division of a non-negative integral column."""
    return F.floor(value / F.lit(by))


def month_index(day: Column) -> Column:
    """Billing-month index of a date column, as pure integer arithmetic."""
    n = F.datediff(day, F.lit(_DAY_ZERO)) - _OFFSET_DAYS
    in_cycle = n % _CYCLE_DAYS
    in_sub = in_cycle % _SUBCYCLE_DAYS
    later_year = in_sub >= _FIRST_LEAP
    year = (
        _FIRST_YEAR
        + 33 * _div(n, _CYCLE_DAYS)
        + 4 * _div(in_cycle, _SUBCYCLE_DAYS)
        + F.when(later_year, _div(in_sub - 1, 365)).otherwise(0)
    )
    day_of_year = F.when(later_year, (in_sub - 1) % 365).otherwise(in_sub)
    first_half = day_of_year < _LONG_MONTHS_DAYS
    rest = day_of_year - _LONG_MONTHS_DAYS
    month = F.when(first_half, _div(day_of_year, 31) + 1).otherwise(_div(rest, 30) + 7)
    day_of_month = F.when(first_half, day_of_year % 31).otherwise(rest % 30) + 1
    closing = F.when(day_of_month >= _CLOSING_DAY, 1).otherwise(0)
    return F.when(day.isNotNull(), 12 * year + month + closing).cast("int")


def month_index_of(day: dt.date | str) -> int:
    """Billing-month index of one date: job arguments only, never per row."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    cycles, in_cycle = divmod((day - _DAY_ZERO).days - _OFFSET_DAYS, _CYCLE_DAYS)
    subs, in_sub = divmod(in_cycle, _SUBCYCLE_DAYS)
    years, day_of_year = (0, in_sub) if in_sub < _FIRST_LEAP else divmod(in_sub - 1, 365)
    if day_of_year < _LONG_MONTHS_DAYS:
        month, day_of_month = day_of_year // 31 + 1, day_of_year % 31 + 1
    else:
        rest = day_of_year - _LONG_MONTHS_DAYS
        month, day_of_month = rest // 30 + 7, rest % 30 + 1
    year = _FIRST_YEAR + 33 * cycles + 4 * subs + years
    return 12 * year + month + (day_of_month >= _CLOSING_DAY)


@lru_cache(maxsize=4096)
def month_start(index: int) -> dt.date:
    """First day of a billing month; bisects the monotone index."""
    guess = dt.date(622, 3, 1) + dt.timedelta(days=int((index - 13) * 30.4368))
    low, high = guess - dt.timedelta(days=60), guess + dt.timedelta(days=120)
    while low < high:
        middle = low + (high - low) // 2
        if month_index_of(middle) >= index:
            high = middle
        else:
            low = middle + dt.timedelta(days=1)
    return low


def month_span(first: int, last: int) -> tuple[dt.date, dt.date]:
    """Half-open date span ``[start, end)`` of the billing months first..last."""
    return month_start(first), month_start(last + 1)


def parse_date_key(text: Column) -> Column:
    """``yyyyMMdd`` text to date; NULL when it does not parse."""
    return F.try_to_date(text, DATE_KEY_FORMAT)


def parse_ts(text: Column) -> Column:
    """``yyyyMMdd HH:mm:ss`` text to timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))


def epoch_seconds(moment: Column) -> Column:
    """Timestamp or date to epoch seconds."""
    return F.unix_timestamp(moment)
