"""Date and month helpers (month keys, parsing, parts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order, mapped to "01".."12".
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_year(c, fmt: str = "MM-yyyy") -> Column:
    """``MM-yyyy`` text key of a date or timestamp (null stays null)."""
    return F.date_format(F.to_date(_c(c)), fmt)


def month_start(c) -> Column:
    """First day of the month: an orderable companion to ``month_year``."""
    return F.trunc(F.to_date(_c(c)), "month")


def month_name_to_num(c) -> Column:
    """English month name to two-digit text; unknown names give null."""
    pairs = []
    for i, name in enumerate(MONTH_NAMES, start=1):
        pairs += [F.lit(name), F.lit(f"{i:02d}")]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def concat_ws_null(sep: str, *cols) -> Column:
    """Null-skipping concatenation: ``concat_ws('-', null, 2016)`` is "2016"."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def parse_date(c, fmt: str | None = None) -> Column:
    """Text to date; malformed text gives null instead of an ANSI error."""
    return F.try_to_date(_c(c), fmt) if fmt else F.try_to_date(_c(c))


def parse_timestamp(c, fmt: str | None = None, ntz: bool = False) -> Column:
    """Text to timestamp; malformed text gives null instead of an error.

    ``ntz`` returns a zone-less timestamp with the same wall-clock time.
    """
    ts = (F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt
          else F.try_to_timestamp(_c(c)))
    return ts.cast("timestamp_ntz") if ntz else ts


def ts_to_date(c) -> Column:
    return F.to_date(_c(c))


def date_parts(c) -> tuple[Column, Column]:
    """(year, month) as integers."""
    return F.year(_c(c)), F.month(_c(c))
