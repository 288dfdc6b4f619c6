"""Daily state that is merged with the day's part, never recomputed.

Every load writes the next version of its tables (:mod:`chorus.sources.versions`)
under the batch's number.  A replayed batch starts again from the version
before it, so it changes nothing; batches come in order.

- Dimensions are maxima and minima per key: the old dimension and the day's
  rows are aggregated together.
- Extracts count comments by their author's stance, which may change with any
  day.  Kept are each author's exact side sums and the counts per (author,
  row keys), one part per batch.  A load reads the day's text once, adds the
  day's sums, finds the authors of the day whose stance changed, takes their
  earlier counts back from the old stance and adds them to the new one.  The
  earlier text is never read again; of the earlier counts, only the rows of
  those authors pass the join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.functions.labels import NEUTRAL
from chorus.operators.stance import exact_mean, exact_score, side_conditions
from chorus.plans import report
from chorus.session import cut_lineage
from chorus.sources import versions
from chorus.sources.files import read_parquet, write_stage

#: Parts of the author counts that are kept apart; then they are summed up.
MAX_PARTS = 32


def _load(spark: SparkSession, root: str, batch: int,
          build: Callable[[versions.Version | None, str], dict[str, str]]) -> versions.Version:
    """Publish version ``batch`` from the newest one before it.  ``build``
    gets that version and the run's folder and returns the tables' paths."""
    known = versions.version_numbers(spark, root)
    if known and known[-1] > batch:
        raise ValueError(f"batch {batch} comes after {known[-1]}: batches are merged in order")
    before = [n for n in known if n < batch]
    base = versions.read_version(spark, root, before[-1]) if before else None
    run, folder = versions.new_run(root)
    paths = build(base, folder)
    version = versions.publish(spark, root, batch, run, paths, {}, replay=batch in known)
    versions.clean_up(spark, root, keep=2)      # the one before serves a replay
    return version


# ------------------------------------------------------------------ dimensions
def merge_dimension(spark: SparkSession, root: str, batch: int, part: DataFrame,
                    keys: Sequence[str], maxima: Sequence[str], minima: Sequence[str]
                    ) -> versions.Version:
    """Merge the rows of ``part`` (the day's cleaned comments, or a dimension
    of them) into the dimension in ``root``: per key the largest of
    ``maxima`` and the smallest of ``minima``.  Null keys are keys."""
    cols = [*keys, *maxima, *minima]

    def build(base, folder):
        rows = part.select(*cols)
        if base:
            rows = rows.unionByName(read_parquet(spark, base.paths["dimension"]))
        merged = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in maxima],
                                         *[F.min(c).alias(c) for c in minima])
        write_stage(merged, f"{folder}/dimension")
        return {"dimension": f"{folder}/dimension"}
    return _load(spark, root, batch, build)


def read_dimension(spark: SparkSession, root: str) -> DataFrame:
    return versions.open_table(spark, root, "dimension")


# -------------------------------------------------------------------- extracts
ROW_KEYS = [k for k in report.EXTRACT_KEYS["topic_score"] if k != "stance"]
SUMS = ["_sa", "_ca", "_sb", "_cb"]


def _summed(parts: DataFrame, author: str) -> DataFrame:
    return (parts.filter(F.col(author).isNotNull()).groupBy(author)
            .agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in SUMS],
                 F.max("_sided").alias("_sided")))


def _stance(sums: DataFrame, author: str, p: report.ReportParams, name: str) -> DataFrame:
    a, b = exact_mean(F.col("_sa"), F.col("_ca")), exact_mean(F.col("_sb"), F.col("_cb"))
    return sums.filter("_sided").select(
        F.col(author), F.when(b > a, p.label_b).otherwise(p.label_a).alias(name))


def merge_extract(spark: SparkSession, root: str, batch: int, comments: DataFrame,
                  p: report.ReportParams) -> versions.Version:
    """Merge one day's comments into the finest extract in ``root``."""
    author, keys = p.author, report.EXTRACT_KEYS["topic_score"]

    def build(base, folder):
        c = comments.filter(F.col(p.text).isNotNull())
        only_a, only_b = side_conditions(F.col(p.text), p.side_a, p.side_b, p.mode)
        feats = report.comment_features(c, p.text, p.score, p.created, p.side_a, p.side_b,
                                        p.topic_a, p.topic_b)
        flags = feats.select(author, *ROW_KEYS, p.id_col, exact_score(F.col(p.score)).alias("_x"),
                             only_a.alias("_a"), only_b.alias("_b"))
        day = cut_lineage(report.author_counts(flags, author, p.id_col, ROW_KEYS))

        paths = dict(base.paths) if base else {}
        day_sums = _summed(day, author)
        old_sums = read_parquet(spark, paths["sums"]) if base else None
        sums = _summed(old_sums.unionByName(day_sums), author) if base else day_sums
        write_stage(sums, f"{folder}/sums")
        sums = read_parquet(spark, f"{folder}/sums")

        new = _stance(sums, author, p, "stance")
        today = (day.filter(report._not_null(ROW_KEYS)).select(author, *ROW_KEYS, "_n", "_rows")
                 .join(new, author, "left")
                 .select(F.coalesce("stance", F.lit(NEUTRAL)).alias("stance"), *ROW_KEYS,
                         "_n", "_rows"))
        moves = [today]
        if base:
            # Only authors of the day can have changed their stance.
            names = day_sums.select(author)
            flipped = cut_lineage(
                names.join(new, author, "left")
                .join(_stance(old_sums, author, p, "before"), author, "left")
                .select(author, F.coalesce("stance", F.lit(NEUTRAL)).alias("stance"),
                        F.coalesce("before", F.lit(NEUTRAL)).alias("before"))
                .filter("stance <> before"))
            parts = reduce(DataFrame.unionByName,
                           [read_parquet(spark, x) for t, x in sorted(paths.items())
                            if t.startswith("counts-")])
            moved = (parts.filter(report._not_null(ROW_KEYS)).join(flipped, author)
                     .select(*ROW_KEYS, F.explode(F.array(
                         F.struct(F.col("before").alias("stance"), (-F.col("_n")).alias("_n"),
                                  (-F.col("_rows")).alias("_rows")),
                         F.struct("stance", "_n", "_rows"))).alias("m"))
                     .select("m.stance", *ROW_KEYS, "m._n", "m._rows"))
            moves += [read_parquet(spark, paths["extract"]), moved]
        extract = (reduce(DataFrame.unionByName, moves).groupBy(*keys)
                   .agg(F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"))
                   .filter(F.col("_rows") > 0))
        write_stage(extract, f"{folder}/extract")

        counts = day
        held = [t for t in paths if t.startswith("counts-")]
        if len(held) >= MAX_PARTS:
            counts = (reduce(DataFrame.unionByName, [
                day, *[read_parquet(spark, paths.pop(t)) for t in held]])
                .groupBy(author, *ROW_KEYS)
                .agg(F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"),
                     *[F.sum(c).cast(day.schema[c].dataType).alias(c) for c in SUMS],
                     F.max("_sided").alias("_sided")))
        write_stage(counts, f"{folder}/counts")
        return {**paths, "sums": f"{folder}/sums", "extract": f"{folder}/extract",
                f"counts-{batch}": f"{folder}/counts"}
    return _load(spark, root, batch, build)


def read_extracts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three dashboard extracts as of the newest batch."""
    finest = versions.open_table(spark, root, "extract").select(
        *report.EXTRACT_KEYS["topic_score"], F.col("_n").alias("n_comments"))
    return report.roll_up(finest)
