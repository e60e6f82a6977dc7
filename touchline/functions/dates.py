"""Date expressions. Where a query depends on today, callers pass ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def day_of_week(day: Column | str) -> Column:
    """0 for Sunday .. 6 for Saturday."""
    return F.dayofweek(as_column(day)) - 1


def week_number(day: Column | str) -> Column:
    """ISO week of the year."""
    return F.weekofyear(as_column(day))


def week_start(day: Column | str) -> Column:
    """The Monday on or before the day, as a DATE."""
    return F.trunc(as_column(day), "week")


def week_end(day: Column | str) -> Column:
    """The Sunday on or after the day, as a DATE."""
    return F.date_add(week_start(day), 6)


def month_start(moment: Column | str) -> Column:
    """First instant of the month, as a zone-less timestamp."""
    return F.trunc(as_column(moment).cast("date"), "month").cast("timestamp_ntz")


def month_text_to_date(text: Column | str, strict: bool = True) -> Column:
    """``2024-07`` -> DATE 2024-07-01. Bad text raises, or gives NULL if not ``strict``."""
    whole = F.concat(as_column(text), F.lit("-01"))
    return whole.cast("date") if strict else whole.try_cast("date")


def year_to_date(year: Column | str) -> Column:
    """``1904`` (also ``1904.0``) -> DATE 1904-01-01."""
    return F.make_date(as_column(year).cast("int"), F.lit(1), F.lit(1))


def completed_years(since: Column | str, as_of: Column | str) -> Column:
    """Whole years between two dates, as BIGINT. 29 February counts as complete on 28 February."""
    months = F.months_between(as_column(as_of).cast("date"), as_column(since).cast("date"))
    # towards zero on both sides, so that a date in the future counts -0 before -1
    return F.when(months < 0, -F.floor(-months / 12)).otherwise(F.floor(months / 12)).cast("bigint")
