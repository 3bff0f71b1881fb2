"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.functions.dates import date_key

# First day, and the day after the last.
FIRST_DAY = "2015-01-01"
END_DAY = "2035-01-01"
NAME_WIDTH = 9


def date_spine(
    spark: SparkSession, first: str = FIRST_DAY, end: str = END_DAY
) -> DataFrame:
    """One row per day, ``end`` excluded."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    days = F.sequence(F.lit(first).cast("date"), last, F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def dim_date(
    spark: SparkSession, first: str = FIRST_DAY, end: str = END_DAY
) -> DataFrame:
    day = F.col("date_day")
    weekday = F.weekday(day) + 1

    def padded(pattern: str):
        return F.rpad(F.date_format(day, pattern), NAME_WIDTH, " ")

    return date_spine(spark, first, end).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        padded("MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        padded("EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )
