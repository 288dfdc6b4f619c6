"""Mixing sources to target weights by repetition rates.

Words are added up per source, each source's share of the target becomes a
repetition rate, and every document is taken ``floor(rate)`` times plus one
more time when its hash-seeded uniform number is below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chorus.llm.common import (WORD, broadcast_if_small, field, null_key, packed,
                               stage, unpacked)

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is taken more than this many times over.
MAX_REPEAT = 3
#: Sets of draws per mix; each source uses the one that lands nearest its target.
N_DRAWS = 8


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_draws(*cols: Column, seed: int = 0) -> Column:
    """``N_DRAWS`` uniform numbers in [0, 1), from the values alone: each is
    eight hex digits of a seeded md5."""
    out = []
    for k in range(N_DRAWS // 4):
        digest = F.md5(F.concat_ws("|", F.lit(str(seed + k)), *[null_key(c) for c in cols]))
        out += [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
                / F.lit(2.0 ** 32) for i in range(4)]
    return F.array(*out)


def source_rates(sizes: DataFrame, source_col: str, size_col: str,
                 weights: tuple[int, ...] = WEIGHTS,
                 max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: source_size, weight, target and rate.

    The targets share the words of all sources by weight; a target stops at
    ``max_repeat`` times its source's size, and the excess is shared again by
    weight among the rest until no target is above its stop.  The fixed point
    is a water level: with sources ordered by stop / weight, the first ones
    whose stop lies below the level of the rest are stopped.  Windows here
    run over one row per source.  A source without words has target and rate 0.
    """
    per = (sizes.groupBy(F.col(source_col).alias("_src"))
           .agg(F.sum(size_col).alias("source_size")))
    ranked = (per.withColumn("_k", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("_src").isNull(), "_src")))
        .withColumn("weight", F.element_at(
            F.array(*[F.lit(int(w)) for w in weights]),
            ((F.col("_k") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_repeat))
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy(F.col("_cap") / F.col("weight"), "_k") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = (ranked
             .withColumn("_total", F.sum("source_size").over(every))
             .withColumn("_caps", F.sum("_cap").over(upto) - F.col("_cap"))
             .withColumn("_left", F.sum("weight").over(every)
                         - F.sum("weight").over(upto) + F.col("weight"))
             .withColumn("_level", (F.col("_total") - F.col("_caps")).cast("double")
                         / F.col("_left").cast("double"))
             .withColumn("_free", F.col("_level") * F.col("weight") <= F.col("_cap")))
    # Of the sources that are free, the first in order has the largest weight
    # left; its level is the water level.
    first = F.max(F.when(F.col("_free"), F.struct("_left", "_level"))).over(every)
    target = F.least(first["_level"] * F.col("weight"), F.col("_cap").cast("double"))
    return (level.withColumn("target", target)
            .select(F.col("_src"), "source_size", "weight", "target",
                    F.when(F.col("source_size") > 0,
                           F.least(F.col("target") / F.col("source_size"),
                                   F.lit(float(max_repeat))))
                    .otherwise(F.lit(0.0)).alias("rate")))


def copies(rate: Column, uniform: Column) -> Column:
    """floor(rate) copies, and one more with probability rate - floor(rate)."""
    whole = F.floor(rate)
    return (whole + F.when(uniform < rate - whole, 1).otherwise(0)).cast("long")


def _join_sources(df: DataFrame, per_source: DataFrame, source_col: str) -> DataFrame:
    """Join the staged one-row-per-source table.  Its row count and longest
    name are known: it is broadcast only when they prove it small."""
    n, longest = per_source.agg(
        F.count(F.lit(1)), F.max(F.octet_length(F.coalesce("_src", F.lit(""))))).first()
    side = broadcast_if_small(per_source, n or 0, 128 + (longest or 0))
    return df.join(side, df[source_col].eqNullSafe(side["_src"]), "left")


def plan_mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
             max_repeat: int = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """Per source: _src, source_size, target, _rate and _draw.

    ``sizes`` has doc_id, source and size.  Every set of draws is a valid
    Bernoulli sample; with few long documents one sample can lie far from its
    target, so the words that each of the ``N_DRAWS`` sets would take are
    added up and the nearest set (the first among equals) is used.
    """
    rates = stage(source_rates(sizes, "source", "size", weights, max_repeat)
                  .withColumnRenamed("rate", "_rate"))
    drawn = (_join_sources(sizes, rates.select("_src", "_rate"), "source")
             .withColumn("_u", hash_draws(F.col("doc_id"), F.col("size"), seed=seed)))
    words = [F.sum(F.col("size") * copies(F.col("_rate"), F.col("_u")[k])).alias(f"_w{k}")
             for k in range(N_DRAWS)]
    taken = drawn.groupBy(F.col("source").alias("_s")).agg(*words)
    off = F.array(*[F.struct(F.abs(F.col(f"_w{k}") - F.col("target")).alias("off"),
                             F.lit(k).alias("k")) for k in range(N_DRAWS)])
    return stage(rates.join(taken, rates["_src"].eqNullSafe(taken["_s"]))
                 .select("_src", "source_size", "target", "_rate",
                         F.array_min(off)["k"].alias("_draw")))


def _copies(df: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``df`` (doc_id, source and size as _id, _source, _size) with the
    columns of ``plan`` and ``_copies``."""
    u = F.element_at(hash_draws(F.col("_id"), F.col("_size"), seed=seed),
                     F.col("_draw") + 1)
    return _join_sources(df, plan, "_source") \
        .withColumn("_copies", copies(F.col("_rate"), u))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        max_repeat: int = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """The mixing decision per document: doc_id, size, source_size, target,
    taken (size times copies) and copies.

    A null text has size 0; null is a source of its own, ordered last.  Rows
    with the same id and size share one draw, so a re-run and a repeated row
    decide alike.  An empty table gives an empty table.
    """
    sizes = _sizes(docs, id_col, text_col, source_col)
    plan = plan_mix(sizes, weights, max_repeat, seed)
    rows = sizes.toDF("_id", "_source", "_size")
    return (_copies(rows, plan, seed)
            .select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"),
                    "source_size", "target",
                    (F.col("_size") * F.col("_copies")).alias("taken"),
                    F.col("_copies").alias("copies")))


def _sizes(docs, id_col, text_col, source_col):
    return stage(docs.select(F.col(id_col).alias("doc_id"),
                             F.col(source_col).alias("source"),
                             word_count(F.col(text_col)).alias("size")))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
         max_repeat: int = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """The mixed corpus itself: every row of ``docs``, all its columns, as
    often as the mix takes it (0 to ``max_repeat`` times).

    Decides like :func:`mix`.
    """
    cols = docs.columns
    plan = plan_mix(_sizes(docs, id_col, text_col, source_col), weights,
                    max_repeat, seed).select("_src", "_rate", "_draw")
    rows = (packed(docs).withColumn("_id", field(id_col))
            .withColumn("_source", field(source_col))
            .withColumn("_size", word_count(field(text_col))))
    return (_copies(rows, plan, seed).filter(F.col("_copies") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select(*unpacked(cols)))
