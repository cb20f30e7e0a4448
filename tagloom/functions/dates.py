"""Month and day arithmetic on date columns. "Today" is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of periods, days and timestamps.
MONTH = "yyyyMM"
DAY = "yyyyMMdd"
DATETIME_19 = "yyyy-MM-dd HH:mm:ss"
DATETIME_14 = "yyyyMMddHHmmss"


def fmt_datetime_19(ts: Column) -> Column:
    return F.date_format(ts, DATETIME_19)


def fmt_datetime_14(ts: Column) -> Column:
    return F.date_format(ts, DATETIME_14)


def month_of(day: Column) -> Column:
    return F.date_format(day, MONTH)


def year_ago_month(day: Column) -> Column:
    return F.date_format(F.add_months(day, -12), MONTH)


def last_month_day(day: Column) -> Column:
    """Last day of the month before ``day``."""
    return F.date_format(F.last_day(F.add_months(day, -1)), DAY)


def last_month_id(day: Column) -> Column:
    return F.date_format(F.add_months(day, -1), MONTH)


def months_before(month: Column, n: int | Column) -> Column:
    """The month ``n`` months before a ``yyyyMM`` text."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.date_format(F.add_months(F.to_date(month, MONTH), -n), MONTH)


def next_month(month: Column) -> Column:
    return months_before(month, -1)


def n_months_ago_day(day: Column, n: int | Column) -> Column:
    """Same day ``n`` months ago, clamped to the end of that month."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.date_format(F.add_months(day, -n), DAY)


def comparison_dates(day: Column) -> dict[str, Column]:
    """The days a daily report compares: yesterday and its month, the day before, one month back."""
    yesterday = F.date_sub(day, 1)
    month_back = F.add_months(yesterday, -1)
    return {
        "base_day": F.date_format(yesterday, DAY),
        "base_month": F.date_format(yesterday, MONTH),
        "day_before": F.date_format(F.date_sub(day, 2), DAY),
        "prev_month": F.date_format(month_back, MONTH),
        "prev_month_day": F.date_format(month_back, DAY),
    }


# The same arithmetic on one driver-side period, used to choose partitions and cutoffs.


def shift_month(period: str, months: int) -> str:
    year, month = int(period[:4]), int(period[4:6])
    index = year * 12 + (month - 1) + months
    return f"{index // 12:04d}{index % 12 + 1:02d}"


def first_day(period: str) -> dt.date:
    return dt.date(int(period[:4]), int(period[4:6]), 1)


def previous_period(today: dt.date) -> str:
    return shift_month(today.strftime("%Y%m"), -1)


def period_parameters(today: dt.date) -> dict[str, str]:
    """The period each partition field stands for when none is given, by field name (fixed values)."""
    this_month = today.strftime("%Y%m")
    last_month = shift_month(this_month, -1)
    last_day = (today.replace(day=1) - dt.timedelta(days=1)).strftime("%Y%m%d")
    return {
        "dt": this_month,
        "year": shift_month(this_month, -12),
        "last_month_day": last_day,
        "last_month_id": last_month,
        "day_id": last_day,
        "month_id": last_month,
    }
