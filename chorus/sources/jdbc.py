"""JDBC sink and source for serving tables.

Connection properties always come from the caller; nothing is stored here.

An append may double rows: a task that committed its rows and was then lost is
run again.  :func:`merge_jdbc` writes to a table of the run's own first; one
transaction then moves its distinct rows into the target by key, so readers see
the load whole or not at all, and a repeated run changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: Mapping[str, str] | None = None,
               batchsize: int = 10000, num_partitions: int | None = None,
               column_types: str | None = None) -> None:
    """Write one table.  ``num_partitions`` caps concurrent connections
    (the frame is coalesced to it); ``append`` duplicates rows on re-run,
    so re-runnable loads should use ``overwrite`` or :func:`merge_jdbc`.
    ``column_types``: types of a table that is made, as DDL."""
    w = (df.write.format("jdbc").mode(mode).option("url", url)
         .option("dbtable", table).option("batchsize", str(batchsize)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def _execute(spark: SparkSession, url: str, statements: Sequence[str],
             properties: Mapping[str, str]) -> None:
    """Run the statements in one transaction, from the driver."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        for sql in statements:
            statement = connection.createStatement()
            statement.executeUpdate(sql)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def merge_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str],
               properties: Mapping[str, str] | None = None,
               column_types: str | None = None, run: str | None = None, **options) -> None:
    """Load ``df`` into ``table``: its rows replace those of equal ``keys``
    (null equals null), other rows stay.

    Rows go to ``<table>_<run>`` first, by any number of tasks and attempts;
    the transaction takes the distinct ones, so rows that a retried task wrote
    twice count once.  ``column_types`` must give every column a type that the
    database can compare (Spark's default for strings is a large object in
    some).  A failed load leaves the target as it was.
    """
    spark, props = df.sparkSession, dict(properties or {})
    own = f"{table}_{run or uuid.uuid4().hex[:12]}"
    quoted = [f'"{c}"' for c in df.columns]
    same = " AND ".join(f'(s."{k}" = t."{k}" OR (s."{k}" IS NULL AND t."{k}" IS NULL))'
                        for k in keys)
    # An empty write makes the target when it is not there.
    write_jdbc(df.limit(0), url, table, "append", props, column_types=column_types)
    write_jdbc(df, url, own, "overwrite", props, column_types=column_types, **options)
    try:
        _execute(spark, url, [
            f"DELETE FROM {table} t WHERE EXISTS (SELECT 1 FROM {own} s WHERE {same})",
            f"INSERT INTO {table} ({', '.join(quoted)}) "
            f"SELECT DISTINCT {', '.join(quoted)} FROM {own}"], props)
    finally:
        _execute(spark, url, [f"DROP TABLE {own}"], props)


def write_tables(tables: Sequence[tuple[str, DataFrame]], url: str,
                 mode: str = "append",
                 properties: Mapping[str, str] | None = None, **kw) -> None:
    """Write several tables in the given order (dimensions before facts)."""
    for name, df in tables:
        write_jdbc(df, url, name, mode, properties, **kw)


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
