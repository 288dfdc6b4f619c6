"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in a seeded random order; the fractional rank
``(rank - 1/2) / rows of the source`` spreads every source evenly over
(0, 1).  Sorting all rows by it interleaves the sources in proportion, and
cutting that order into equal runs gives shards whose row counts differ by at
most one and whose source mixture matches the corpus.

No window holds a whole source or the whole table.  Both rankings count rows
per cell first (a partial aggregation), add up the cells' counts on the small
count table, and number rows only inside their cell, so a source with a third
of all rows is spread over thousands of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chorus.llm.common import field, null_key, packed, stage, unpacked

#: Cells of each ranking (a power of two): rows are numbered within a cell.
CELL_BITS = 12


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def interleave(df: DataFrame, order_cols: list[str], stratum_col: str,
               n_shards: int, seed: int = 17, shard_col: str = "shard",
               slot_col: str = "slot") -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0).

    ``order_cols`` identify a row for the seeded order; rows equal in all of
    them are interchangeable.  Null is a stratum of its own and a valid order
    value.  An empty table gives an empty table.  Input columns named like
    the two results are replaced; other columns are carried along, so select
    what the shards need first.  Row counts of shards differ by at most one.
    """
    cells = 1 << CELL_BITS
    base = df.drop(shard_col, slot_col)
    keep = base.columns
    rows = stage(packed(base).select(
        "_row", null_key(field(stratum_col)).alias("_ss"),
        F.xxhash64(F.lit(seed), *[null_key(field(c)) for c in order_cols])
        .alias("_sh"))
        .withColumn("_sb", F.shiftrightunsigned("_sh", 64 - CELL_BITS)))

    # Rank in the seeded order of each stratum: rows in earlier cells, plus
    # the row number within the cell.
    counts = rows.groupBy("_ss", "_sb").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_ss")
    before = counts.select(
        "_ss", "_sb",
        (F.sum("_n").over(whole.orderBy("_sb")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_rows"))
    order = ["_sh", *[field(c) for c in order_cols]]
    ranked = (rows
              .withColumn("_rn", F.row_number().over(
                  Window.partitionBy("_ss", "_sb").orderBy(*order)))
              .join(before, ["_ss", "_sb"])
              .withColumn("_frac", (F.col("_rn") + F.col("_before") - 0.5)
                          / F.col("_rows"))
              .withColumn("_cell", F.least(F.floor(F.col("_frac") * cells),
                                           F.lit(cells - 1)).cast("int"))
              .select("_row", "_ss", "_frac", "_cell"))
    ranked = stage(ranked)

    # Position in the order of fractional ranks, by the same two steps.  The
    # table of cells has at most 2**CELL_BITS rows.
    cell_counts = ranked.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(F.lit(0))
    starts = cell_counts.select(
        "_cell",
        (F.sum("_n").over(every.orderBy("_cell")) - F.col("_n")).alias("_start"),
        F.sum("_n").over(every).alias("_total"))
    pos = F.col("_start") + F.col("_in") - 1
    shard = F.expr(f"cast((_pos * {int(n_shards)}) div _total as int)")
    first = F.expr(f"(cast(_shard as bigint) * _total + {int(n_shards) - 1}) div {int(n_shards)}")
    return (ranked
            .withColumn("_in", F.row_number().over(
                Window.partitionBy("_cell").orderBy("_frac", "_ss")))
            .join(starts, "_cell")
            .withColumn("_pos", pos)
            .withColumn("_shard", shard)
            .select(*unpacked(keep), F.col("_shard").alias(shard_col),
                    (F.col("_pos") - first).cast("long").alias(slot_col)))


def write_shards(sharded: DataFrame, path: str, tasks_per_shard: int = 8,
                 shard_col: str = "shard", slot_col: str = "slot") -> None:
    """Write the shards as Parquet folders ``shard=k``; each is written by up
    to ``tasks_per_shard`` tasks, in runs of slots, sorted by slot."""
    part = F.pmod(F.col(slot_col), F.lit(tasks_per_shard))
    (sharded.repartition(F.col(shard_col), part)
     .sortWithinPartitions(shard_col, slot_col)
     .write.mode("overwrite").partitionBy(shard_col).parquet(path))


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 17,
                    id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The sharding decision per document: doc_id, size, text_crc32, law,
    shard, slot, grown_shard and source.

    A null text has size 8 and a null text_crc32.  Rows with equal id, source
    and text are interchangeable.  ``grown_shard`` is null: under the law
    ``rows`` the cut depends on the row count, not on the key alone.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.col(text_col)).alias("text_crc32"),
        F.col(source_col).alias("source"))
    out = interleave(narrow, ["doc_id", "text_crc32", "size"], "source",
                     n_shards, seed)
    return out.select("doc_id", "size", "text_crc32",
                      F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
