"""Column types inferred from text, as one mergeable aggregate.

For each column and each type the values that spoil it are counted, all in
one scan; a column's type is the narrowest that no value spoils.  Counts of
parts add up to those of the whole, so profiles of daily files merge, and a
stray value is reported instead of turning a column into text unseen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types from narrow to wide, with the text forms they take; a date must also
# be a day of the calendar, an int must fit.
FORMS = {
    "boolean": r"^(?i:true|false)$",
    "int": r"^[+-]?[0-9]{1,10}$",
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$",
}


def _spoils(value: Column, kind: str) -> Column:
    fits = value.rlike(FORMS[kind])
    if kind == "int":
        fits = fits & value.try_cast("int").isNotNull()
    if kind in ("date", "timestamp"):
        fits = fits & value.try_cast(kind).isNotNull()
    return value.isNotNull() & ~fits


def type_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: column, n_rows, n_values (not null) and, for
    each type, the values that spoil it (``not_int``, ...).  One aggregation."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("string")
        aggs.append(F.count(v).alias(f"v{i}"))
        aggs += [F.count_if(_spoils(v, k)).alias(f"{k}{i}") for k in FORMS]
    rows = [F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"),
                     F.col(f"v{i}").alias("n_values"),
                     *[F.col(f"{k}{i}").alias(f"not_{k}") for k in FORMS])
            for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of a whole from those of its parts."""
    return profiles.groupBy("column").agg(*[
        F.sum(c).alias(c) for c in ("n_rows", "n_values", *[f"not_{k}" for k in FORMS])])


def inferred(profile: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """column, type, n_rows, n_values and n_malformed: the narrowest type that
    at most ``tolerance`` of the values spoil, and how many do (they become
    null in a cast).  A column without values is text."""
    kind = F.lit("string")
    bad = F.lit(0).cast("bigint")
    for k in reversed(list(FORMS)):
        fits = (F.col("n_values") > 0) \
            & (F.col(f"not_{k}") <= F.lit(float(tolerance)) * F.col("n_values"))
        kind = F.when(fits, k).otherwise(kind)
        bad = F.when(fits, F.col(f"not_{k}")).otherwise(bad)
    return profile.select("column", kind.alias("type"), "n_rows", "n_values",
                          bad.alias("n_malformed"))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None,
                tolerance: float = 0.0) -> DataFrame:
    return inferred(type_profile(df, columns), tolerance)
