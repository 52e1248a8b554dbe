"""Calendar columns and the plan-time date arithmetic of the query parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period text per granularity, and the days (Monday = 0) that count as weekend.
PERIOD_FORMATS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}
WEEKEND_DAYS = (5, 6)


def date_id(day: Column) -> Column:
    """Integer yyyymmdd of a date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_attrs(day: Column) -> list[Column]:
    """The columns of the date dimension for one calendar day."""
    return [
        date_id(day).alias("date_id"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.weekday(day).isin(*WEEKEND_DAYS).alias("is_weekend"),
    ]


def period_of_date_id(col: Column, granularity: str) -> Column:
    """Period text of an integer date id; an unknown granularity gives NULL."""
    fmt = PERIOD_FORMATS.get(granularity)
    if fmt is None:
        return F.lit(None).cast("string")
    return F.date_format(F.to_date(col.cast("string"), "yyyyMMdd"), fmt)


def period_label(year: Column, month: Column) -> Column:
    """'YYYY-MM', or 'YYYY' where the month is NULL or 0."""
    return F.when(month > 0, F.format_string("%d-%02d", year, month)).otherwise(year.cast("string"))


def quarter_label(year: Column, quarter: Column) -> Column:
    """'YYYY-Qn'."""
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def month_start(year: Column, month: Column) -> Column:
    """First day of a month as a date."""
    return F.make_date(year, month, F.lit(1))


def date_text_to_id(text: str) -> int:
    """'YYYY-MM-DD' -> yyyymmdd, for query parameters; raises ValueError for anything that is no date."""
    return int(datetime.strptime(text, "%Y-%m-%d").strftime("%Y%m%d"))


def prev_quarter(year: int, quarter: int) -> tuple[int, int]:
    """The quarter before the given one."""
    return (year, quarter - 1) if quarter > 1 else (year - 1, 4)
