"""Helpers shared by the operators: staging, size-checked joins, batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.session import cut_lineage, shared_dir

#: A join side of at most this many bytes may be broadcast.
BROADCAST_BYTES = 8 << 20
#: Bytes of one Arrow batch handed to a Python worker.
ARROW_BATCH_BYTES = 8 << 20
#: ASCII white space as the contracts name it: space and 0x09 to 0x0D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by Spark's own reader, whatever file system the path is on."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ready a session for Python tasks.

    Arrow batches are bounded by bytes, so that very long texts cannot make a
    batch of 10,000 rows outgrow a worker (a smaller bound already set is
    kept), and the library's modules are sent along, so that executors need
    no installation of it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2 ** 31 - 1))) > ARROW_BATCH_BYTES:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        context.addPyFile(_package_zip())
        _SENT.add(context.applicationId)


_SENT: set[str] = set()


def _package_zip() -> str:
    """The modules of the library as a zip file for Spark to distribute."""
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="chorus-modules-")) / "chorus_modules.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    return str(path)


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back:
    computed once, and safe when an executor is lost."""
    return cut_lineage(df)


def null_key(c: Column) -> Column:
    """A string that is equal for equal values and distinct for null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("0"))


def packed(df: DataFrame) -> DataFrame:
    """``df`` as one struct column ``_row``, so that no name of its columns can
    clash with names an operator sets."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def field(name: str) -> Column:
    """A column of a packed row."""
    return F.col("_row").getField(name)


def unpacked(cols: list[str], **instead: Column) -> list[Column]:
    """The columns ``cols`` of a packed row, some of them replaced."""
    return [instead.get(c, field(c)).alias(c) for c in cols]


def broadcast_if_small(df: DataFrame, n_rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast when ``n_rows`` rows of at most ``row_bytes`` are
    proven to fit; otherwise leave the join to be shuffled (AQE splits its
    skewed partitions)."""
    return F.broadcast(df) if n_rows * row_bytes <= BROADCAST_BYTES else df


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of a partition that is sorted by ``keys`` (integers), one
    table per distinct key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        cols = np.stack([batch[k].to_numpy().astype(np.int64) for k in keys])
        edges = (np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1).tolist()
        if held and tuple(cols[:, 0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, stop in zip([0, *edges], [*edges, len(batch)]):
            held.append(batch.slice(start, stop - start))
            if stop < len(batch):
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(cols[:, -1])
    if held:
        yield pa.Table.from_batches(held)


__all__ = ["read_table", "prepare", "stage", "null_key", "sorted_groups", "packed", "field", "unpacked",
           "broadcast_if_small", "shared_dir", "SPACE_RUN", "WORD"]
