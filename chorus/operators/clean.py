"""Projection and cleaning operators (select, drop, rename, derive, null
handling, schema conformance, deduplication)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by a mapping; case-only renames (``Events`` -> ``events``)
    are applied too, which a case-insensitive resolver would skip."""
    return df.withColumnsRenamed(dict(mapping))


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def drop_any_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset))


def drop_all_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(how="all", subset=list(subset))


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column null fill that respects the column type.

    ``na.fill`` with a boolean also fills *string* columns with 'false';
    here a boolean fill first casts the column to boolean, and every other
    value is cast to the column's own type.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = {}
    for name, v in values.items():
        dt = types.get(name.lower())
        if dt is None:
            raise ValueError(f"no column {name!r}")
        c = F.col(name)
        if isinstance(v, bool) and not isinstance(dt, T.BooleanType):
            c = c.try_cast("boolean")
            out[name] = F.coalesce(c, F.lit(v))
        else:
            out[name] = F.coalesce(c, F.lit(v).cast(dt))
    return df.withColumns(out)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into null in floating columns (Spark averages NaN)."""
    float_cols = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.FloatType, T.DoubleType))
                  and (cols is None or f.name in cols)]
    return df.withColumns({
        c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c))
        for c in float_cols})


_PARSERS = {
    "timestamp": lambda c: F.try_to_timestamp(c),
    "timestamp_ltz": lambda c: F.try_to_timestamp(c),
    "timestamp_ntz": lambda c: F.try_to_timestamp(c).cast("timestamp_ntz"),
    "date": lambda c: F.try_to_date(c),
}


def _conform_expr(src: T.DataType, name: str, target) -> Column:
    key = target.lower() if isinstance(target, str) else target.simpleString()
    parser = _PARSERS.get(key)
    if isinstance(src, T.StringType) and parser is not None:
        return parser(F.col(name))
    return F.col(name).try_cast(target)


def _types(df: DataFrame, names: Iterable[str]) -> dict[str, T.DataType]:
    """Types of the named columns, found as Spark finds them (by default in
    any letter case)."""
    found = df.select(*[F.col(n) for n in names]).schema.fields
    return {n: f.dataType for n, f in zip(names, found)}


def conform(df: DataFrame, schema: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the named columns to a target schema without ANSI failures.

    Text that does not parse becomes null; :func:`conform_report` counts how
    many values each column lost.
    """
    fields = _types(df, schema)
    return df.withColumns({name: _conform_expr(fields[name], name, target)
                           for name, target in schema.items()})


def conform_report(df: DataFrame, schema: Mapping[str, T.DataType | str]
                   ) -> DataFrame:
    """(column, lost): values that were non-null before and null after
    :func:`conform` -- one aggregation over one scan."""
    fields = _types(df, schema)
    cols = list(schema)
    wide = df.agg(*[
        F.count_if(F.col(c).isNotNull()
                   & _conform_expr(fields[c], c, schema[c]).isNull()).alias(c)
        for c in cols])
    return wide.unpivot([], cols, "column", "lost")


def dedup(df: DataFrame, keys: Sequence[str] | None = None,
          order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows.

    Without keys: exact duplicate rows.  With keys: one survivor per key,
    the row with the smallest ``order_by`` values (ties broken by the
    remaining columns, so the survivor is deterministic).  Written as a
    ``min`` over a struct, which aggregates partially per partition: a hot
    key never lands whole in one task, unlike a ``row_number`` window.
    """
    if not keys:
        return df.dropDuplicates()
    keys = list(keys)
    order_by = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_row")
    # The struct minimum runs as a sort-based aggregate; a leading 64-bit
    # hash of the keys settles almost every comparison without comparing
    # long texts (the keys themselves still decide, so the result is exact).
    out = (df.groupBy(F.xxhash64(*keys).alias("_h"), *keys)
           .agg(F.min(packed).alias("_row")))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c)
                               for c in order_by + rest]).select(*df.columns)
