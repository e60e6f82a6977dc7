"""State at the points of a regular day grid, without a nested-loop range join.

``point >= start AND point < end`` has no equality to hash on, so Spark would compare every
point with every period. On a regular grid the points inside a period follow from its ends by
integer arithmetic: each period is exploded into exactly the points it holds. The work is the
size of the result, and nothing is shuffled.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.calendar import FIRST_DAY, numbers


@dataclass(frozen=True)
class DayGrid:
    """Points at midnight of ``first``, ``first + step`` .. up to ``last`` included."""

    first: dt.date
    last: dt.date
    step_days: int = 7

    @property
    def size(self) -> int:
        return max(0, (self.last - self.first).days // self.step_days + 1)

    def covering(self, other: DayGrid) -> DayGrid:
        """The points of both grids, whose steps meet, and any between them."""
        if not self.size or not other.size:
            return self if self.size else other
        if self.step_days != other.step_days or (self.first - other.first).days % self.step_days:
            raise ValueError("the grids have no common points")
        return DayGrid(min(self.first, other.first), max(self.last, other.last), self.step_days)

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        return numbers(spark, self.size).select(self._point(F.col("id").cast("int")).alias(name))

    def _point(self, number: Column) -> Column:
        return F.date_add(F.lit(self.first), number * self.step_days).cast("timestamp_ntz")


def weeks(start: dt.date, end: dt.date, day: int = 0) -> DayGrid:
    """Grid of the Mondays (``day=0``) .. Sundays (``day=6``) of all weeks touching [start, end)."""
    first = start - dt.timedelta(days=start.weekday()) + dt.timedelta(days=day)
    final = end - dt.timedelta(days=1)
    last = final - dt.timedelta(days=final.weekday()) + dt.timedelta(days=day)
    return DayGrid(first, last)


def weeks_of(periods: DataFrame, start: str, end: str, day: int = 0) -> DayGrid:
    """The same grid for all weeks that any of the periods touches: its bounds come from the data."""
    first, last = _bounds(periods, start, end)
    return DayGrid(FIRST_DAY, FIRST_DAY - dt.timedelta(days=1)) if first is None else weeks(first, last + dt.timedelta(days=1), day)


def days_of(periods: DataFrame, start: str, end: str) -> DayGrid:
    """Every midnight from the day of the first start to the day of the last end."""
    first, last = _bounds(periods, start, end)
    return DayGrid(FIRST_DAY, FIRST_DAY - dt.timedelta(days=1), 1) if first is None else DayGrid(first, last, 1)


def _bounds(periods: DataFrame, start: str, end: str) -> tuple[dt.date | None, dt.date | None]:
    first, last = periods.agg(F.to_date(F.min(start)), F.to_date(F.greatest(F.max(start), F.max(end)))).first()
    return first, last


def _span(grid: DayGrid, start: str, end: str, closed: bool) -> tuple[Column, Column]:
    """Numbers of the first and last grid point inside a period."""
    start_day, end_day = F.to_date(start), F.to_date(end)
    at_midnight = F.col(start) == start_day.cast("timestamp_ntz")
    first_day = F.when(at_midnight, start_day).otherwise(F.date_add(start_day, 1))
    last_day = end_day
    if not closed:
        last_day = F.when(F.col(end) == end_day.cast("timestamp_ntz"), F.date_sub(end_day, 1)).otherwise(end_day)
    origin, step = F.lit(grid.first), grid.step_days
    low = F.greatest(F.ceil(F.datediff(first_day, origin) / step).cast("int"), F.lit(0))
    high = F.least(F.floor(F.datediff(last_day, origin) / step).cast("int"), F.lit(grid.size - 1))
    return low, high


def number_of_points(grid: DayGrid, start: str, end: str, closed: bool = False) -> Column:
    """How many grid points a period holds."""
    low, high = _span(grid, start, end, closed)
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    return F.when(known, F.greatest(high - low + 1, F.lit(0))).otherwise(0).cast("bigint")


def points_within(
    periods: DataFrame, grid: DayGrid, point: str, start: str, end: str, closed: bool = False
) -> DataFrame:
    """Inner range join: one row per period and grid point with ``start <= point < end``.

    ``closed`` takes ``point <= end`` instead. A NULL end matches nothing.
    """
    low, high = _span(grid, start, end, closed)
    return (
        periods.withColumns({"__low": low, "__high": high})
        .filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col("__low") <= F.col("__high")))
        .withColumn("__number", F.explode(F.sequence("__low", "__high")))
        .withColumn(point, grid._point(F.col("__number")))
        .drop("__low", "__high", "__number")
    )


def grid_left_join(
    periods: DataFrame, grid: DayGrid, point: str, start: str, end: str, closed: bool = False
) -> DataFrame:
    """Left range join from the grid: points inside no period stay as one row of NULLs.

    Which points are taken needs only the two ends of each period, combined map-side to at
    most one row per grid point and task. Nothing is joined on the point itself: with a few
    thousand points and all the rows, that shuffle would have a few thousand huge groups.
    """
    inside = points_within(periods, grid, point, start, end, closed)
    ends = periods.select(start, end)
    taken = points_within(ends, grid, point, start, end, closed).select(point).distinct()
    empty = grid.frame(periods.sparkSession, point).join(taken, point, "left_anti")
    return inside.unionByName(empty, allowMissingColumns=True)
