"""Row sampling without replacement.

``seeded_sample`` is Spark's Bernoulli sample: it depends on how the input
is partitioned.  ``hash_sample`` keeps a row when a hash of its key falls
below ``fraction * 2^32`` -- the same rows for any partitioning, any
cluster size and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SPACE = 2 ** 32


def key_hash32(key) -> Column:
    """First 32 bits of md5(key as text), as a non-negative bigint; a null
    key hashes like an empty text, so its rows are sampled as one key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.coalesce(k.cast("string"), F.lit(""))), 1, 8), 16, 10
                  ).cast("bigint")


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    return df.filter(key_hash32(key) < F.lit(int(fraction * HASH_SPACE)))


def seeded_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
