"""Grouped and whole-table aggregates of the analysis path.

Every aggregate here is a hash aggregate with a partial (map-side) phase,
so a key that holds a third of all rows is pre-combined in every task
before the shuffle.  No group is ever materialised as a list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorus.session import cut_lineage


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """Grouping as a pandas user expects: rows with a null key form no group."""
    cond = None
    for k in _keys(keys):
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def grouped_mean(df: DataFrame, keys, value: str, alias: str = "mean",
                 null_keys: bool = False) -> DataFrame:
    src = df if null_keys else drop_null_keys(df, keys)
    return src.groupBy(*_keys(keys)).agg(F.avg(value).alias(alias))


def group_count(df: DataFrame, keys, counted: str, alias: str = "n",
                null_keys: bool = False) -> DataFrame:
    """Non-null ``counted`` values per group (zero-count groups stay)."""
    src = df if null_keys else drop_null_keys(df, keys)
    return src.groupBy(*_keys(keys)).agg(F.count(counted).alias(alias))


def value_counts(df: DataFrame, col: str, count_name: str = "count"
                 ) -> DataFrame:
    """Counts per non-null value, most frequent first (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(col)))


def value_counts_total(df: DataFrame, col: str, count_name: str = "count",
                       total_name: str = "total") -> DataFrame:
    """Value counts with the overall total beside each row.  The total is a
    scalar subquery: one extra aggregate job, no join, no global window."""
    counts = value_counts(df, col, count_name)
    total = counts.select(F.sum(count_name)).scalar()
    return counts.withColumn(total_name, total)


def _labelled_means(df: DataFrame, value: str, cells) -> DataFrame:
    """One aggregation of ``avg/count(when(cond, value))`` per cell, then
    one output row per cell carrying its label columns, mean and n."""
    aggs = []
    for i, (_, cond) in enumerate(cells):
        v = F.when(cond, F.col(value))
        aggs += [F.avg(v).alias(f"m{i}"), F.count(v).alias(f"n{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(*[F.lit(v).alias(k) for k, v in labels.items()],
                     F.col(f"m{i}").alias("mean"), F.col(f"n{i}").alias("n"))
            for i, (labels, _) in enumerate(cells)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def conditional_means(df: DataFrame, value: str,
                      cells: Mapping[str, Column]) -> DataFrame:
    """Mean and count of ``value`` for each named row condition, all in one
    scan: ``avg(when(cond, value))``.  Returns (cell, mean, n)."""
    return _labelled_means(df, value, [({"cell": name}, cond)
                                       for name, cond in cells.items()])


def cohort_period_means(df: DataFrame, value: str,
                        cohorts: Mapping[str, Column],
                        periods: Mapping[str, Column]) -> DataFrame:
    """(period, cohort, mean, n): every cohort x period cell plus each
    period overall (cohort 'all'), from one aggregation."""
    cells = []
    for p, pc in periods.items():
        cells.append(({"period": p, "cohort": "all"}, pc))
        cells += [({"period": p, "cohort": c}, pc & cc)
                  for c, cc in cohorts.items()]
    return _labelled_means(df, value, cells)


def numeric_summary(df: DataFrame, col: str, exact: bool = True,
                    accuracy: int = 100000) -> DataFrame:
    """count, mean, sample std, min, quartiles, max of one column (one row;
    all but the count are null when there is no value).

    Exact quartiles come from :func:`exact_quantiles`; ``exact=False`` takes
    ``percentile_approx`` from the same scan instead.
    """
    c, names, qs = F.col(col), ["q25", "q50", "q75"], [0.25, 0.5, 0.75]
    approx = [] if exact else [F.percentile_approx(c, q, accuracy).cast("double").alias(n)
                               for n, q in zip(names, qs)]
    out = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"),
                 F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
                 F.max(c).cast("double").alias("max"), *approx)
    if exact:
        out = out.unionByName(exact_quantiles(df, col, dict(zip(names, qs))),
                              allowMissingColumns=True)
        out = out.agg(*[F.max(x).alias(x) for x in out.columns])
    return out.select("n", "mean", "std", "min", *names, "max")


def exact_quantiles(df: DataFrame, col: str, quantiles: Mapping[str, float]
                    ) -> DataFrame:
    """One row with the named quantiles as doubles (linear interpolation
    between neighbours; null without values).

    Rows are counted per value and the counts are range-partitioned, so no
    task sees more than its slice.  Slice totals (one row per slice) tell in
    which slices the wanted ranks lie; only those are ordered.  The slices are
    checkpointed while the plan is built, as a second reading of a sampled
    range partitioning might cut elsewhere.
    """
    counts = (df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull())
              .groupBy("_v").agg(F.count(F.lit(1)).alias("_n")))
    slices = cut_lineage(counts.repartitionByRange("_v")
                         .withColumn("_p", F.spark_partition_id()))
    first, size, total = F.col("_first"), F.col("_in"), F.col("_total")
    per = (slices.groupBy("_p").agg(F.sum("_n").alias("_in"))
           .withColumn("_first", F.sum("_in").over(Window.orderBy("_p")) - size)
           .withColumn("_total", F.sum("_in").over(Window.partitionBy())))

    def ranks(q: float):
        at = F.lit(float(q)) * (total - 1)
        return F.floor(at), F.ceil(at), at - F.floor(at)

    wanted = F.lit(False)
    for q in quantiles.values():
        for r in ranks(q)[:2]:
            wanted = wanted | ((first <= r) & (r < first + size))
    # At most two slices per quantile pass.
    rows = slices.join(F.broadcast(per.where(wanted)), "_p").withColumn(
        "_before", first - F.col("_n")
        + F.sum("_n").over(Window.partitionBy("_p").orderBy("_v")))
    v, before = F.col("_v").cast("double"), F.col("_before")

    def at_rank(r):
        return F.max(F.when((before <= r) & (r < before + F.col("_n")), v))

    out = rows.agg(*[x for name, q in quantiles.items() for lo, hi, part in [ranks(q)]
                     for x in (at_rank(lo).alias(f"{name}_lo"), at_rank(hi).alias(f"{name}_hi"),
                               F.max(part).alias(f"{name}_part"))])
    return out.select(*[(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo"))
                         * F.col(f"{n}_part")).alias(n) for n in quantiles])


def null_profile(df: DataFrame, cols: Sequence[str] | None = None
                 ) -> DataFrame:
    """(column, null_count) for every column, from one aggregation."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "null_count")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column; null is kept as a value."""
    return df.select(col).distinct()


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by an explicit order (Spark rows have none)."""
    return df.orderBy(*order_by).limit(n)


def top_k(df: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """Top ``k`` rows by ``by`` descending, ties by ``tie`` ascending;
    planned as a per-task bounded heap (TakeOrderedAndProject)."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def dimension(df: DataFrame, keys, maxes: Mapping[str, str] | None = None,
              mins: Mapping[str, str] | None = None) -> DataFrame:
    """A dimension table: one row per key with max / min attributes
    (``{source column: output name}``).  Null keys form a group, as in any
    Spark ``groupBy``."""
    aggs = [F.max(c).alias(a) for c, a in (maxes or {}).items()]
    aggs += [F.min(c).alias(a) for c, a in (mins or {}).items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)
