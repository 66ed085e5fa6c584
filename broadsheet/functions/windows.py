"""Date windows on the modification stamp."""

from __future__ import annotations

import calendar
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the oldest year with modification dates.
FIRST_YEAR = 2021


class Window(NamedTuple):
    """Inclusive bounds."""

    start: datetime
    end: datetime


def month_window(
    start_year: int,
    start_month: int,
    end_year: int | None = None,
    end_month: int | None = None,
    today: date | None = None,
) -> Window:
    """First second of the first month to the last second of the last month.

    The end defaults to the current month. Raises ``ValueError`` for a window that is
    reversed, starts before the first year or reaches into a future month.
    """
    today = today or date.today()
    end_year = today.year if end_year is None else end_year
    end_month = today.month if end_month is None else end_month
    if start_year < FIRST_YEAR:
        raise ValueError(f"start year {start_year} is before {FIRST_YEAR}")
    if not (1 <= start_month <= 12 and 1 <= end_month <= 12):
        raise ValueError(f"months are 1 to 12, got {start_month} and {end_month}")
    if (start_year, start_month) > (end_year, end_month):
        raise ValueError("the window ends before it starts")
    if (end_year, end_month) > (today.year, today.month):
        raise ValueError(f"{end_year}-{end_month:02d} is in the future")
    last_day = calendar.monthrange(end_year, end_month)[1]
    return Window(
        datetime(start_year, start_month, 1),
        datetime(end_year, end_month, last_day, 23, 59, 59),
    )


def _stamp(value) -> Column:
    """Zoneless bounds mean UTC, whatever the zone of this machine."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp")


def in_window(stamp: Column, start, end) -> Column:
    return stamp.between(_stamp(start), _stamp(end))


def filter_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows with ``column`` between the inclusive bounds; reaches the Parquet scan."""
    return df.filter(in_window(F.col(column), start, end))


def months_in(start: datetime, end: datetime) -> list[tuple[int, int]]:
    """The (year, month) pairs a window touches."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [(m // 12, m % 12 + 1) for m in range(first, last + 1)]
