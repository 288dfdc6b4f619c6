"""Exact deduplication by a Grace hash.

Each scan task first removes the copies it meets itself (a bounded
open-addressing table), so a text with millions of copies is shuffled at most
once per task.  The remaining texts are dealt out by their hash.  In each
partition an open-addressing table compares complete contents; when its byte
budget is full, contents that are not in it are spilled to files by the next
bits of the hash, and each file is treated in the same way.  A content is
either in the table or wholly in one file, so the recursion is exact.

Spill files lie in Spark's own scratch folders of the executor, are private
to the task and are removed when it ends; a lost task simply runs again.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import SPACE_RUN, field, packed, prepare, unpacked

#: Bytes of content that a task's table may hold before it spills.
TABLE_BYTES = 128 << 20
#: Bytes of content that a scan task holds to remove copies before the shuffle.
SCAN_TABLE_BYTES = 32 << 20
#: Spill files per level, as a power of two.
FAN_BITS = 4


def normalised(text: Column) -> Column:
    """The text compared: null as empty, each run of white space as a space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def text_digest(text: Column) -> Column:
    # coalesce: declared non-null, so that no join adds a null test that
    # would compute the digest a second time.
    return F.coalesce(F.sha2(normalised(text), 256), F.lit(""))


class ContentTable:
    """Open addressing with linear probing: hash slot -> entry, where an
    entry holds the complete content, the smallest id and the row count."""

    def __init__(self, slots: int = 1024):
        self.slots: list[int] = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot)."""
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e, at
            at = (at + 1) & mask
        return -1, at

    def merge(self, e: int, row_id: int | None, n: int) -> None:
        self.counts[e] += n
        if row_id is not None and (self.ids[e] is None or row_id < self.ids[e]):
            self.ids[e] = row_id

    def insert(self, at: int, h: int, content: bytes, row_id: int | None, n: int) -> None:
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.ids.append(row_id)
        self.counts.append(n)
        self.bytes += len(content) + 200
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        size = 2 * len(self.slots)
        slots, mask = [-1] * size, size - 1
        for e, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = e
        self.slots = slots


Record = tuple[int, bytes, "int | None", int]      # hash, content, smallest id, rows


def _scratch() -> str | None:
    """Spark's scratch folder of this executor (as its own spills use)."""
    dirs = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)]
    return dirs[os.getpid() % len(dirs)] if dirs else None


def _read_spill(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while True:
            try:
                # A fresh unpickler for each batch: a kept one would resolve
                # repeated objects against the batches before.
                yield from pickle.load(f)
            except EOFError:
                return


def grace(records: Iterable[Record], budget: int = TABLE_BYTES,
          level: int = 0) -> Iterator[Record]:
    """One record per distinct content, with the smallest id and all rows.

    Below the last level of hash bits, contents that agree in the whole hash
    share a file; the table then takes them all, however many."""
    table, spills = ContentTable(), {}
    shift, fan = level * FAN_BITS, 1 << FAN_BITS
    last = shift + FAN_BITS > 48
    with tempfile.TemporaryDirectory(prefix="grace-", dir=_scratch()) as folder:
        held: dict[int, list] = {}
        for h, content, row_id, n in records:
            e, at = table.find(h, content)
            if e >= 0:
                table.merge(e, row_id, n)
            elif last or not table.hashes or table.bytes + len(content) <= budget:
                table.insert(at, h, content, row_id, n)
            else:
                k = (h >> (16 + shift)) & (fan - 1)
                held.setdefault(k, []).append((h, content, row_id, n))
                if len(held[k]) >= 64:
                    _write_spill(spills, folder, k, held.pop(k))
        for k in list(held):
            _write_spill(spills, folder, k, held.pop(k))
        for f in spills.values():
            f.close()
        for e, h in enumerate(table.hashes):
            yield h, table.contents[e], table.ids[e], table.counts[e]
        del table
        for f in spills.values():
            yield from grace(_read_spill(f.name), budget, level + 1)
            os.unlink(f.name)


def _write_spill(files: dict, folder: str, k: int, rows: list) -> None:
    if k not in files:
        files[k] = open(os.path.join(folder, str(k)), "wb")
    # A pickler of its own for each batch: no memo outlives the batch.
    pickle.dump(rows, files[k], protocol=pickle.HIGHEST_PROTOCOL)


def _before_shuffle(budget: int):
    """Scan side: drop the copies met in the same task; when the table is
    full it is passed on and a new one begun."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for h, row_id, content in zip(batch["_h"].to_pylist(), batch["_id"].to_pylist(),
                                          batch["_c"].cast(pa.binary())):
                content = content.as_py()
                e, at = table.find(h & (2 ** 64 - 1), content)
                if e >= 0:
                    table.merge(e, row_id, 1)
                else:
                    table.insert(at, h & (2 ** 64 - 1), content, row_id, 1)
                if table.bytes > budget:
                    yield _batch(table)
                    table = ContentTable()
        if table.hashes:
            yield _batch(table)
    return run


def _batch(table: ContentTable) -> pa.RecordBatch:
    signed = [h - 2 ** 64 if h >= 2 ** 63 else h for h in table.hashes]
    return pa.RecordBatch.from_arrays(
        [pa.array(signed, pa.int64()), pa.array(table.contents, pa.binary()),
         pa.array(table.ids, pa.int64()), pa.array(table.counts, pa.int64())],
        ["_h", "_c", "_id", "_n"])


def _after_shuffle(budget: int):
    def records(batches):
        for b in batches:
            yield from zip((h & (2 ** 64 - 1) for h in b["_h"].to_pylist()),
                           (c.as_py() for c in b["_c"]),
                           b["_id"].to_pylist(), b["_n"].to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for _, content, row_id, n in grace(records(batches), budget):
            out.append((sha256(content).hexdigest(), row_id, n))
            if len(out) >= 4096:
                yield _groups(out)
                out = []
        if out:
            yield _groups(out)
    return run


def _groups(rows: list) -> pa.RecordBatch:
    sha, ids, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(sha, pa.string()), pa.array(ids, pa.int64()), pa.array(n, pa.int64())],
        ["text_sha256", "keep_id", "group_size"])


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct normalised text: text_sha256, keep_id (smallest
    non-null id, null if it has none) and group_size."""
    prepare(docs.sparkSession)
    content = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), content.alias("_c")) \
        .withColumn("_h", F.xxhash64("_c"))
    met = rows.mapInArrow(_before_shuffle(min(SCAN_TABLE_BYTES, table_bytes)),
                          "_h long, _c binary, _id long, _n long")
    return met.repartition("_h").mapInArrow(
        _after_shuffle(table_bytes),
        "text_sha256 string, keep_id long, group_size long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The decision per row: doc_id, keep_id, group_size, kept, text_sha256.

    A null text equals the empty one.  Null ids rank after all others: a
    group without an id has keep_id null and keeps its rows.  Rows that share
    both id and text are one document and get the same decision.
    """
    groups = content_groups(docs, id_col, text_col, table_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_digest(F.col(text_col)).alias("text_sha256"))
    return (rows.join(groups, "text_sha256")
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs``, all columns, with one row left of each group of equal texts:
    the one with the smallest id (of rows sharing that id and text, any one).

    The join is on text digest and id together, so no group of copies meets
    in one task.
    """
    cols = docs.columns
    groups = content_groups(docs, id_col, text_col, table_bytes).select(
        F.col("text_sha256").alias("_sha"), F.col("keep_id").alias("_keep"))
    rows = packed(docs).withColumn("_sha", text_digest(field(text_col))) \
        .withColumn("_id", field(id_col).cast("long"))
    kept = rows.join(groups.withColumnRenamed("_sha", "_gsha"),
                     (F.col("_sha") == F.col("_gsha"))
                     & F.col("_id").eqNullSafe(F.col("_keep")))
    return kept.dropDuplicates(["_gsha", "_keep"]).select(*unpacked(cols))
