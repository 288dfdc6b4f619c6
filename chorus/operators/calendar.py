"""Date dimension (a calendar spine with month keys)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's calendar span (inclusive).
DEFAULT_START = dt.date(2016, 1, 1)
DEFAULT_END = dt.date(2025, 1, 18)
DAYS_PER_SLICE = 366


def date_dim(spark: SparkSession, start: dt.date = DEFAULT_START,
             end: dt.date = DEFAULT_END, text_parts: bool = False
             ) -> DataFrame:
    """One row per day in [start, end]: date, month, year, month_year.

    The spine is generated on the executors: ``range`` splits the span into
    yearly slices, each expanded by ``sequence`` -- nothing is built on the
    driver.  ``month``/``year`` are ints unless ``text_parts`` (the
    reference's staged text form before the load casts).
    """
    n_days = (end - start).days + 1
    n_slices = max(1, -(-n_days // DAYS_PER_SLICE))
    base = F.lit(start)
    slices = spark.range(0, n_slices, 1, numPartitions=min(n_slices, 64))
    lo = F.date_add(base, (F.col("id") * DAYS_PER_SLICE).cast("int"))
    hi = F.least(F.date_add(lo, DAYS_PER_SLICE - 1), F.lit(end))
    days = slices.select(F.explode(F.sequence(lo, hi)).alias("date"))
    return _with_parts(days, text_parts)


def date_dim_span(spark: SparkSession, df: DataFrame, col: str,
                  text_parts: bool = False) -> DataFrame:
    """Date dimension covering the dates of ``df[col]`` (min to max).

    The span comes from one aggregate; the spine is then generated on the
    executors in yearly slices, so its size follows the calendar span, not
    the row count, and no date list passes through the driver.
    """
    span = df.agg(F.min(F.to_date(col)).alias("lo"),
                  F.max(F.to_date(col)).alias("hi"))
    n = F.datediff("hi", "lo") + 1
    slices = span.select("lo", "hi", F.explode(F.sequence(
        F.lit(0), F.floor((n - 1) / DAYS_PER_SLICE).cast("int"))).alias("k"))
    lo = F.date_add("lo", F.col("k") * DAYS_PER_SLICE)
    hi = F.least(F.date_add(lo, DAYS_PER_SLICE - 1), F.col("hi"))
    days = slices.select(F.explode(F.sequence(lo, hi)).alias("date"))
    return _with_parts(days, text_parts)


def _with_parts(days: DataFrame, text_parts: bool) -> DataFrame:
    month = F.date_format("date", "MM")
    year = F.date_format("date", "yyyy")
    return days.select(
        "date",
        month.alias("month") if text_parts else F.month("date").alias("month"),
        year.alias("year") if text_parts else F.year("date").alias("year"),
        F.concat_ws("-", month, year).alias("month_year"))


def distinct_months(dim: DataFrame) -> DataFrame:
    """The month level of the date dimension (one row per month_year):
    month-grain facts join here, not to the daily rows."""
    return (dim.groupBy("month_year")
            .agg(F.min("date").alias("month_start"),
                 F.min("month").alias("month"), F.min("year").alias("year")))
