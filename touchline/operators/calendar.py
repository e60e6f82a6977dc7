"""Calendar and period dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.dates import week_end, week_number, week_start

FIRST_DAY = dt.date(2000, 1, 1)
END_DAY = dt.date(2050, 1, 1)


def numbers(spark: SparkSession, count: int) -> DataFrame:
    """``id`` from 0 up to ``count``. A dimension of some thousand rows is one task, not one per core."""
    return spark.range(0, count, 1, count // 1_000_000 + 1)


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, ``end`` left out."""
    span = numbers(spark, max(0, (end - start).days))
    return span.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def calendar(spark: SparkSession, start: dt.date = FIRST_DAY, end: dt.date = END_DAY) -> DataFrame:
    """One row per day with its week (Monday to Sunday), month and year. ``end`` is left out."""
    moment = "timestamp_ntz"
    return days(spark, start, end).select(
        F.col("day").cast(moment).alias("date_day"),
        week_number("day").cast("bigint").alias("date_week"),
        week_start("day").cast(moment).alias("week_start_date"),
        week_end("day").cast(moment).alias("week_end_date"),
        F.month("day").cast("bigint").alias("date_month"),
        F.date_format("day", "MMMM").alias("month_name"),
        F.date_format("day", "MMM").alias("month_short_name"),
        F.year("day").cast("bigint").alias("date_year"),
    )


def periods(spark: SparkSession, first: dt.date, last: dt.date, step_days: int = 10) -> DataFrame:
    """Consecutive periods [start_date, end_date), one for each start up to ``last`` included."""
    count = max(0, (last - first).days // step_days + 1)
    start = F.date_add(F.lit(first), (F.col("id") * step_days).cast("int"))
    return numbers(spark, count).select(
        F.col("id").alias("period_number"), start.alias("start_date"), F.date_add(start, step_days).alias("end_date")
    )
