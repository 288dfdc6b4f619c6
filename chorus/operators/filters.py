"""Row filters: keyword cohorts, periods and labels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.functions.text import mentions, mentions_word


def keyword_any(df: DataFrame, text: str, keywords, mode: str = "substring",
                case_sensitive: bool = False) -> DataFrame:
    """Rows whose text mentions any keyword (null text never matches)."""
    return df.filter(mentions(F.col(text), keywords, mode, case_sensitive))


def keyword_any_many(df: DataFrame, text: str, words, case_sensitive: bool = False) -> DataFrame:
    """Rows whose text holds any of the words as a token, for lists of
    thousands: the cost does not grow with the list."""
    return df.filter(mentions_word(F.col(text), words, case_sensitive))


def keyword_all_groups(df: DataFrame, text: str, groups: Sequence,
                       mode: str = "substring",
                       case_sensitive: bool = False) -> DataFrame:
    """Rows that mention at least one keyword of *every* group."""
    cond = F.lit(True)
    for g in groups:
        cond = cond & mentions(F.col(text), g, mode, case_sensitive)
    return df.filter(cond)


def exclusive_cohort(df: DataFrame, text: str, include, exclude,
                     mode: str = "substring",
                     case_sensitive: bool = False) -> DataFrame:
    """Rows that mention ``include`` and do not mention ``exclude``."""
    t = F.col(text)
    return df.filter(mentions(t, include, mode, case_sensitive)
                     & ~mentions(t, exclude, mode, case_sensitive))


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    return start, end


def period_condition(df: DataFrame, ts: str, year: int, month: int) -> Column:
    """``ts`` in the calendar month, as a half-open range whose bounds have
    the column's own type, so the predicate reaches the Parquet scan."""
    dtype = df.schema[ts].dataType
    lo, hi = month_bounds(year, month)
    c = F.col(ts)
    return (c >= F.lit(lo).cast(dtype)) & (c < F.lit(hi).cast(dtype))


def range_condition(df: DataFrame, col: str, lo, hi) -> Column:
    """``lo <= col < hi`` with bounds cast to the column's type (pushdown)."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    return (c >= F.lit(lo).cast(dtype)) & (c < F.lit(hi).cast(dtype))


def period_filter(df: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    return df.filter(period_condition(df, ts, year, month))


def label_filter(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))
