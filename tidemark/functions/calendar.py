"""Calendar attributes and the generated calendar spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The span of the enriched calendar, both ends included.
CALENDAR_START = dt.date(1900, 1, 1)
CALENDAR_END = dt.date(2100, 12, 31)
# day_of_week counts from 1 = Sunday, so 1 and 7 are the weekend.
WEEKEND_DAYS = (1, 7)


def calendar_attributes(date: Column) -> dict[str, Column]:
    """The derived columns of one calendar day, by output name."""
    day_of_week = F.dayofweek(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": day_of_week,
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": day_of_week.isin(*WEEKEND_DAYS),
    }


def calendar(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
) -> DataFrame:
    """One row per day of the closed range, generated on the executors."""
    if end < start:
        raise ValueError(f"calendar end {end} is before its start {start}")
    days = (end - start).days + 1
    spine = spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")
    )
    return spine.select("date", *_named_attributes())


def calendar_spanning(df: DataFrame, date: Column) -> DataFrame:
    """The calendar from the first to the last ``date`` of ``df``.

    The bounds are one partial/final aggregate; the spine is at most one row per
    day between them. An empty or all-null input has no days.
    """
    bounds = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return spine.select("date", *_named_attributes())


def _named_attributes() -> list[Column]:
    return [c.alias(name) for name, c in calendar_attributes(F.col("date")).items()]
