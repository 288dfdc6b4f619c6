"""Write, audit, publish: the star schema that is served is the one checked.

A run reads each raw table once: the cleaned comments are staged, and fact
and dimensions are built from the stage.  Every table is written to the run's
folder; the quality suites then read the written files, not the plans that
made them.  Only a run that passes is published, by manifest
(:mod:`chorus.sources.versions`); a failing or lost run leaves the published
tables as they were, and its files and audit can be looked at until the next
clean-up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.operators.calendar import date_dim_span
from chorus.operators.clean import drop_any_null
from chorus.operators.lexicon import Rules
from chorus.operators.quality import assert_passed
from chorus.plans import gate, star
from chorus.sources import versions
from chorus.sources.files import read_parquet, write_bucketed, write_stage

CLEANED, AUDIT = "_cleaned_comments", "_audit"


def _staged_tables(spark: SparkSession, cleaned: DataFrame, raw_events: DataFrame,
                   lexicon: DataFrame, rules: Rules | None, dates_from: str | None,
                   lexicon_rows: int | None) -> dict[str, DataFrame]:
    tables = star.build_star_schema(spark, cleaned, raw_events, lexicon, rules=rules,
                                    lexicon_rows=lexicon_rows, already_clean=True)
    if dates_from:
        span = cleaned.select(F.to_date(dates_from).alias("d"))
        dates = drop_any_null(date_dim_span(spark, span, "d", text_parts=True),
                              ["date", "month_year"])
        tables["dim_date"] = dates.select("date", "month", "year", "month_year")
    return tables


def stage_star(spark: SparkSession, raw_comments: DataFrame, raw_events: DataFrame,
               lexicon: DataFrame, folder: str, rules: Rules | None = None,
               dates_from: str | None = None, lexicon_rows: int | None = None,
               buckets: int | None = None, bucket_table: str | None = None,
               alter: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None
               ) -> dict[str, str]:
    """Write the five tables under ``folder``; returns their paths.

    ``dates_from``: the cleaned comments' column whose dates the date
    dimension spans (default: the fixed bounds).  ``buckets``: stage the
    cleaned comments bucketed by id as table ``bucket_table``, so that scoring
    shuffles nothing.  ``alter``: a last step on the tables before the write.
    """
    path = f"{folder}/{CLEANED}"
    comments = star.clean_comments(raw_comments)
    if buckets:
        write_bucketed(comments.repartition(buckets, "comment_id"), bucket_table, path,
                       "comment_id", buckets)
        cleaned = spark.table(bucket_table)
    else:
        write_stage(comments, path)
        cleaned = read_parquet(spark, path)
    tables = _staged_tables(spark, cleaned, raw_events, lexicon, rules, dates_from,
                            lexicon_rows)
    return star.write_star(alter(tables) if alter else tables, folder)


def audit(spark: SparkSession, paths: dict[str, str], folder: str) -> DataFrame:
    """The quality suites over the written files; the results are written
    beside them and read back."""
    written = {t: read_parquet(spark, p) for t, p in paths.items()}
    write_stage(gate.quality_gate(written).coalesce(1), f"{folder}/{AUDIT}")
    return read_parquet(spark, f"{folder}/{AUDIT}")


def publish_star(spark: SparkSession, raw_comments: DataFrame, raw_events: DataFrame,
                 lexicon: DataFrame, root: str, advisory=gate.ADVISORY, keep: int = 2,
                 url: str | None = None, properties: dict | None = None,
                 load_mode: str = "overwrite", jdbc_options: dict | None = None,
                 **stage_options) -> versions.Version:
    """One run: stage, audit the written files, publish, load, clean up.

    Raises ``QualityGateError`` when a check outside ``advisory`` fails; the
    newest published version is then the same as before.  The load (with
    ``url``) reads the published files.  ``keep``: versions whose files stay.
    """
    before = versions.read_version(spark, root)
    run, folder = versions.new_run(root)
    paths = stage_star(spark, raw_comments, raw_events, lexicon, folder, **stage_options)
    results = audit(spark, paths, folder)
    assert_passed(results.filter(~gate.spared(advisory)))
    # The audit counted the rows of every table it read.
    counted = {r.suite: r.n for r in results.groupBy("suite").agg(
        F.max("element_count").alias("n")).collect()}          # one row per suite
    n_rows = {table: counted[suite] for suite, (table, _) in gate.SUITES.items()}
    version = versions.publish(spark, root, before.number + 1 if before else 1, run,
                               {**paths, AUDIT: f"{folder}/{AUDIT}"}, n_rows)
    if url:
        star.serve({t: read_parquet(spark, p) for t, p in paths.items()}, url,
                   properties or {}, load_mode, **(jdbc_options or {}))
    versions.clean_up(spark, root, keep)
    return version
