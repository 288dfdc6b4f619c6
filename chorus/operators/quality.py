"""Declarative column expectations, compiled to one aggregation per suite.

A suite is a list of :class:`Expectation` records over one table.  Each
record becomes two conditional counts (missing, unexpected) inside a single
``agg``; the one-row result is exploded into one result row per record:

    suite, expectation, column, element_count, missing_count,
    unexpected_count, unexpected_percent, success

``unexpected_percent`` is over the non-missing values (over all values for
``not_null``), null when there are none; ``success`` means no unexpected
value.  Every check is a column aggregate, so a suite costs one scan at
any scale.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names accepted by the type checks, by family.
TYPE_FAMILIES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "str": (T.StringType,),
    "bool": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}
TYPE_ALIASES = {"int64": "int", "integer": "int", "long": "int",
                "float64": "float", "double": "float", "string": "str",
                "boolean": "bool", "timestamp": "datetime",
                "datetime64": "datetime", "date": "datetime",
                "bigint": "int", "smallint": "int", "tinyint": "int",
                "short": "int", "real": "float", "decimal": "float",
                "object": "str", "varchar": "str", "text": "str"}

# strftime directives and their Spark datetime-pattern equivalents.
STRFTIME_TO_SPARK = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH",
                     "%M": "mm", "%S": "ss", "%y": "yy", "%b": "MMM",
                     "%B": "MMMM", "%f": "SSSSSS", "%%": "%"}


@dataclass(frozen=True)
class Expectation:
    kind: str          # not_null | of_type | type_in_list | in_set |
    #                    datetime_format | between
    column: str
    args: tuple = ()

    @property
    def name(self) -> str:
        return {"not_null": "expect_column_values_to_not_be_null",
                "of_type": "expect_column_values_to_be_of_type",
                "type_in_list": "expect_column_values_to_be_in_type_list",
                "in_set": "expect_column_values_to_be_in_set",
                "datetime_format":
                    "expect_column_values_to_match_strftime_format",
                "between": "expect_column_values_to_be_between"}[self.kind]


def not_null(c):
    return Expectation("not_null", c)


def of_type(c, t):
    return Expectation("of_type", c, (t,))


def type_in_list(c, ts):
    return Expectation("type_in_list", c, tuple(ts))


def in_set(c, values):
    return Expectation("in_set", c, tuple(values))


def datetime_format(c, fmt):
    return Expectation("datetime_format", c, (fmt,))


def between(c, lo=None, hi=None):
    return Expectation("between", c, (lo, hi))


def strftime_to_spark(fmt: str) -> str:
    out, i = [], 0
    while i < len(fmt):
        two = fmt[i:i + 2]
        if two in STRFTIME_TO_SPARK:
            out.append(STRFTIME_TO_SPARK[two])
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)


def _family(t: str) -> str:
    t = t.lower()
    family = TYPE_ALIASES.get(t, t)
    if family not in TYPE_FAMILIES:
        raise ValueError(f"unknown type name {t!r}")
    return family


def _comparable(c: Column, dtype: T.DataType, values) -> Column:
    """A text column read as the type of the values it is compared with; text
    that does not parse is null, which counts as unexpected."""
    values = [v for v in values if v is not None]
    if not isinstance(dtype, T.StringType) or not values:
        return c
    if all(isinstance(v, bool) for v in values):
        return c.try_cast("boolean")
    if all(isinstance(v, (int, float)) for v in values):
        return c.try_cast("double")
    return c


def _value_has_type(c: Column, dtype: T.DataType, family: str) -> Column:
    """Per-value type test: a typed column passes or fails as a whole; a
    text column passes value by value when the text parses as the type."""
    if isinstance(dtype, TYPE_FAMILIES[family]):
        return F.lit(True)
    if not isinstance(dtype, T.StringType):
        return F.lit(False)
    if family == "int":
        return c.try_cast("bigint").isNotNull()
    if family == "float":
        return c.try_cast("double").isNotNull()
    if family == "bool":
        return c.try_cast("boolean").isNotNull()
    if family == "datetime":
        return F.try_to_timestamp(c).isNotNull()
    return F.lit(True)  # str


def _dtype(df: DataFrame, name: str) -> T.DataType:
    """Column type, resolved case-insensitively like Spark's default."""
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f.dataType
    raise ValueError(f"no column {name!r}")


def unexpected(df: DataFrame, e: Expectation) -> Column:
    """Condition under which a non-null value violates ``e``."""
    c = F.col(e.column)
    dtype = _dtype(df, e.column)
    if e.kind == "not_null":
        return F.lit(False)
    if e.kind == "of_type":
        return ~_value_has_type(c, dtype, _family(e.args[0]))
    if e.kind == "type_in_list":
        ok = F.lit(False)
        for t in e.args:
            ok = ok | _value_has_type(c, dtype, _family(t))
        return ~ok
    if e.kind == "in_set":
        return ~_comparable(c, dtype, e.args).isin(list(e.args))
    if e.kind == "datetime_format":
        fmt = strftime_to_spark(e.args[0])
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).isNull()
    if e.kind == "between":
        lo, hi = e.args
        c = _comparable(c, dtype, e.args)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < F.lit(lo))
        if hi is not None:
            bad = bad | (c > F.lit(hi))
        return bad
    raise ValueError(f"unknown expectation {e.kind!r}")


def run_suite(df: DataFrame, suite: str, expectations: Sequence[Expectation]
              ) -> DataFrame:
    """Validate ``df`` against a suite in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(expectations):
        c = F.col(e.column)
        aggs.append(F.count_if(c.isNull()).alias(f"_m{i}"))
        if e.kind == "not_null":
            aggs.append(F.count_if(c.isNull()).alias(f"_u{i}"))
        else:
            aggs.append(F.count_if(c.isNotNull()
                                   & F.coalesce(unexpected(df, e), F.lit(True))
                                   ).alias(f"_u{i}"))
    wide = df.agg(*aggs)
    rows = []
    for i, e in enumerate(expectations):
        n, m, u = F.col("_n"), F.col(f"_m{i}"), F.col(f"_u{i}")
        base = n if e.kind == "not_null" else n - m
        pct = F.when(base > 0, F.try_divide(u.cast("double") * 100, base))
        rows.append(F.struct(
            F.lit(suite).alias("suite"), F.lit(e.name).alias("expectation"),
            F.lit(e.column).alias("column"), n.alias("element_count"),
            m.alias("missing_count"), u.alias("unexpected_count"),
            pct.alias("unexpected_percent"), (u == 0).alias("success")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def run_suites(tables: dict[str, DataFrame],
               suites: dict[str, tuple[str, Sequence[Expectation]]]
               ) -> DataFrame:
    """Several suites (each over a named table), results unioned."""
    out = None
    for suite, (table, exps) in suites.items():
        r = run_suite(tables[table], suite, exps)
        out = r if out is None else out.unionByName(r)
    return out


class QualityGateError(RuntimeError):
    pass


def assert_passed(results: DataFrame) -> DataFrame:
    """Fail fast: raise if any expectation failed (one small action)."""
    bad = results.filter(~F.col("success")).collect()    # one row per check
    if bad:
        raise QualityGateError(
            "; ".join(f"{r.suite}/{r.expectation}({r.column}): "
                      f"{r.unexpected_count} unexpected" for r in bad))
    return results
