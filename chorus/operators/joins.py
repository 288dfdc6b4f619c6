"""Joins of the analysis path (full outer, left from a spine, enrichment)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows and bytes this library will broadcast on its own.  Anything above
# them (or not provably below them) is joined by shuffle, and AQE may still
# turn the join into a broadcast from runtime sizes.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
               known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when ``df`` provably has at most ``max_rows`` rows
    of at most ``BROADCAST_MAX_BYTES`` together.

    The proof is ``known_rows`` when the caller built ``df`` from data of a
    known size, else a bounded measurement while the plan is built (it keeps
    at most ``max_rows + 1`` rows and sums their bytes, written as JSON).
    Otherwise ``df`` is returned unchanged and the join shuffles.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    row = F.octet_length(F.to_json(F.struct("*")))
    n, size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= BROADCAST_MAX_BYTES else df


def outer_means(a: DataFrame, b: DataFrame, key: str, a_value: str,
                b_value: str, a_name: str, b_name: str) -> DataFrame:
    """Full outer equi-join of two per-key measures.

    Measures are renamed before the join (no suffix clash); ``using`` the
    key merges the two key columns into one.
    """
    return (a.select(key, F.col(a_value).alias(a_name))
            .join(b.select(key, F.col(b_value).alias(b_name)), key, "full"))


def spine_left(spine: DataFrame, key: str, right: DataFrame) -> DataFrame:
    """Left join from the distinct keys of ``spine`` (null key kept once)."""
    return spine.select(key).distinct().join(right, key, "left")


def enrich_left(df: DataFrame, right: DataFrame, key: str,
                fill: dict | None = None, salt_buckets: int | None = None,
                salt_col: str | None = None) -> DataFrame:
    """Left join ``right`` onto every row of ``df``; fill the misses.

    ``right`` must be unique on ``key``.  No broadcast is forced: its size
    grows with the key count, so AQE decides from runtime statistics and
    splits a skewed left partition if one key dominates.

    ``salt_buckets`` salts the join explicitly (for clusters without AQE
    skew handling): each left row gets ``hash(salt_col) mod n`` -- a
    deterministic salt, identical on a retried task -- and every right row
    is replicated once per salt, so a hot key is spread over ``n`` tasks.
    """
    if salt_buckets:
        n = int(salt_buckets)
        salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(n))
        left = df.withColumn("_salt", salt)
        rep = right.withColumn("_salt", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
        out = left.join(rep, [key, "_salt"], "left").drop("_salt")
    else:
        out = df.join(right, key, "left")
    return out.na.fill(fill) if fill else out
