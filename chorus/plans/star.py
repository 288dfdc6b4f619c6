"""Star-schema ETL: stage raw (P1), build five tables (P2), serve (P3).

P2 needs no shared intermediate: the dimensions are aggregates of the
cleaned comments and never read the sentiment score (it is never null, so
the null filter on it is a no-op that Catalyst folds away); only the fact
table runs the lexicon scoring.  Each output is therefore one lazy plan,
safe to recompute after an executor loss, and nothing is cached.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.functions.dates import month_name_to_num, month_year
from chorus.functions.labels import score_label
from chorus.operators.calendar import (DEFAULT_END, DEFAULT_START, date_dim,
                                      date_dim_span)
from chorus.operators.clean import (conform, drop_any_null, fill_nulls,
                                    rename_columns)
from chorus.operators.lexicon import Rules, lexicon_score
from chorus.sources.files import (read_csv, read_parquet, spread,
                                  write_bucketed, write_stage)
from chorus.sources.jdbc import merge_jdbc, write_tables
from chorus.sources.sampling import hash_sample, seeded_sample

# The reference's table layout.
FACT_COMMENT_COLUMNS = ["comment_id", "score", "self_text", "subreddit",
                        "created_time", "controversiality", "author_name",
                        "post_id", "month_year", "sentiment_score",
                        "sentiment_label"]
FACT_ASSAULT_COLUMNS = ["country", "month_year", "events", "fatalities"]
COMMENT_REQUIRED = ["post_id", "score", "post_title", "comment_id",
                    "self_text", "subreddit", "author_name", "month_year"]
USER_MAX = ["user_is_verified", "user_awardee_karma", "user_awarder_karma",
            "user_link_karma", "user_comment_karma", "user_total_karma"]
POST_KEYS = ["post_id", "post_title", "post_self_text", "month_year_post"]
POST_MAX = ["post_score", "post_upvote_ratio", "post_thumbs_ups",
            "post_total_awards_received"]
LOAD_ORDER = ["dim_user", "fact_assault", "dim_post", "dim_date",
              "fact_comment"]
#: What names a row of a served table.
LOAD_KEYS = {"dim_user": ["author_name"], "fact_assault": ["country", "month_year"],
             "dim_post": ["post_id", "post_title", "post_self_text", "month_year"],
             "dim_date": ["date"], "fact_comment": ["comment_id"]}
LOAD_SCHEMA = {
    "dim_user": {"user_account_created_time": "timestamp_ntz",
                 "user_is_verified": "boolean",
                 **{c: "int" for c in USER_MAX[1:]}},
    "dim_post": {"post_score": "int", "post_upvote_ratio": "float",
                 "post_thumbs_ups": "int", "post_total_awards_received": "int",
                 "post_created_time": "timestamp_ntz"},
    "dim_date": {"month": "int", "year": "int"},
    "fact_comment": {"created_time": "timestamp_ntz", "score": "int",
                     "controversiality": "float"},
    "fact_assault": {},
}


# ---------------------------------------------------------------- P1
def stage_raw(spark: SparkSession, comments_csv: str, comments_schema,
              events_csv: str, events_schema, out_dir: str,
              fraction: float | None = None, sample_key: str | None = None,
              seed: int = 42, mode: str = "overwrite",
              buckets: int | None = None, bucket_key: str = "comment_id",
              table: str = "data_comments_raw") -> dict[str, str]:
    """CSV exports -> (sampled) Parquet stage.  With ``sample_key`` the
    sample is a key-hash sample, repeatable under any partitioning.

    With ``buckets`` the comment stage is also registered as ``table``,
    bucketed on ``bucket_key``: scoring it later (aggregate by key, join
    back on key) then runs without any shuffle of the text.
    """
    comments = read_csv(spark, comments_csv, comments_schema)
    if fraction is not None:
        comments = (hash_sample(comments, sample_key, fraction) if sample_key
                    else seeded_sample(comments, fraction, seed))
    # A multi-line CSV file is read by one task; spread what follows.
    comments = (comments.repartition(buckets, bucket_key) if buckets
                else spread(comments, bucket_key))
    events = read_csv(spark, events_csv, events_schema)
    paths = {"comments": f"{out_dir}/data_comments_raw",
             "events": f"{out_dir}/data_events_raw"}
    if buckets:
        write_bucketed(comments, table, paths["comments"], bucket_key,
                       buckets, mode)
    else:
        write_stage(comments, paths["comments"], mode)
    write_stage(events, paths["events"], mode)
    return paths


# ---------------------------------------------------------------- P2
def clean_comments(raw: DataFrame) -> DataFrame:
    """Month keys, required non-null columns, verified flag filled."""
    df = raw.withColumns({
        "month_year": month_year("created_time"),
        "month_year_post": month_year("post_created_time"),
    })
    df = drop_any_null(df, COMMENT_REQUIRED)
    return fill_nulls(df, {"user_is_verified": False})


def clean_events(raw: DataFrame) -> DataFrame:
    """Monthly events: month key from the English month name and year
    (unknown month -> key is the year alone, as ``concat_ws`` skips null),
    lower-case names, null keys dropped, counts filled with 0."""
    df = raw.withColumn("month_num", month_name_to_num(F.col("Month")))
    df = df.withColumn("month_year",
                       F.concat_ws("-", F.col("month_num"), F.col("Year")))
    df = rename_columns(df, {"Country": "country", "Events": "events",
                             "Fatalities": "fatalities"})
    df = drop_any_null(df, ["country", "month_year"])
    return fill_nulls(df, {"events": 0, "fatalities": 0})


def fact_comment(cleaned: DataFrame, lexicon: DataFrame,
                 rules: Rules | None = None, score_type: str = "float",
                 lexicon_rows: int | None = None) -> DataFrame:
    scored = lexicon_score(cleaned.select(*FACT_COMMENT_COLUMNS[:-2]),
                           "comment_id", "self_text", lexicon,
                           rules=rules, score_type=score_type,
                           lexicon_rows=lexicon_rows, null_ids=False)
    return scored.withColumn("sentiment_label",
                             score_label("sentiment_score",
                                         score_type=score_type)
                             ).select(*FACT_COMMENT_COLUMNS)


def dim_user(cleaned: DataFrame, key: str = "author_name") -> DataFrame:
    return cleaned.groupBy(key).agg(
        F.max("user_is_verified").alias("user_is_verified"),
        F.min("user_account_created_time").alias("user_account_created_time"),
        *[F.max(c).alias(c) for c in USER_MAX[1:]])


def dim_post(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy(*POST_KEYS)
            .agg(*[F.max(c).alias(c) for c in POST_MAX],
                 F.min("post_created_time").alias("post_created_time"))
            .withColumnRenamed("month_year_post", "month_year"))


def build_star_schema(spark: SparkSession, raw_comments: DataFrame,
                      raw_events: DataFrame, lexicon: DataFrame,
                      start: dt.date = DEFAULT_START,
                      end: dt.date = DEFAULT_END, rules: Rules | None = None,
                      score_type: str = "float",
                      lexicon_rows: int | None = None,
                      already_clean: bool = False) -> dict[str, DataFrame]:
    """The five star tables (lazy).  ``already_clean``: ``raw_comments`` is
    the output of :func:`clean_comments` (e.g. a staged copy)."""
    cleaned = raw_comments if already_clean else clean_comments(raw_comments)
    events = clean_events(raw_events)
    dates = drop_any_null(date_dim(spark, start, end, text_parts=True),
                          ["date", "month_year"])
    return {
        "fact_comment": fact_comment(cleaned, lexicon, rules, score_type,
                                     lexicon_rows),
        "fact_assault": events.select(*FACT_ASSAULT_COLUMNS),
        "dim_user": dim_user(cleaned),
        "dim_post": dim_post(cleaned),
        "dim_date": dates.select("date", "month", "year", "month_year"),
    }


def build_star_schema_span(spark: SparkSession, raw_comments: DataFrame,
                           raw_events: DataFrame, lexicon: DataFrame,
                           span: DataFrame, span_col: str,
                           rules: Rules | None = None,
                           score_type: str = "float",
                           lexicon_rows: int | None = None
                           ) -> dict[str, DataFrame]:
    """As :func:`build_star_schema`, with the date dimension spanning the
    dates of ``span[span_col]`` instead of fixed bounds."""
    tables = build_star_schema(spark, raw_comments, raw_events, lexicon,
                               rules=rules, score_type=score_type,
                               lexicon_rows=lexicon_rows)
    dates = drop_any_null(date_dim_span(spark, span, span_col,
                                        text_parts=True),
                          ["date", "month_year"])
    tables["dim_date"] = dates.select("date", "month", "year", "month_year")
    return tables


def write_star(tables: dict[str, DataFrame], out_dir: str,
               mode: str = "overwrite",
               partition_facts_by_month: bool = False) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out_dir}/{name}"
        part = (["month_year"] if partition_facts_by_month
                and name == "fact_comment" else None)
        if part:
            # One task (or a few, for a large month) per folder instead of
            # one file per task and month.
            df = df.hint("rebalance", *part)
        write_stage(df, paths[name], mode, part)
    return paths


def daily_etl(spark: SparkSession, comments_path: str, events_path: str,
              lexicon: DataFrame, out_dir: str, url: str | None = None,
              properties: dict | None = None, gate: bool = True,
              mode: str = "overwrite", load_mode: str = "overwrite",
              rules: Rules | None = None,
              partition_facts_by_month: bool = True,
              clean_buckets: int | None = None,
              clean_table: str = "star_cleaned_comments",
              advisory=None, **jdbc_options) -> dict[str, str]:
    """One scheduled run: staged Parquet -> star schema -> quality gate
    (fail fast, before anything is written) -> staged star tables ->
    optional JDBC load of the written tables, dimensions first.

    ``advisory``: the format checks that report without stopping the run
    (default ``gate.ADVISORY``; empty: every failing check stops it).

    A re-run replaces what it wrote and loaded before (``load_mode="append"``
    adds to the served tables instead).  ``jdbc_options`` (``batchsize``,
    ``num_partitions``: the number of connections) reach the sink.

    The gate's suites are aggregations over the lazy tables; the load
    reads back the written Parquet, so scoring is not recomputed.

    ``clean_buckets`` first stages the cleaned comments once, bucketed on
    ``comment_id`` (table ``clean_table``): lexicon scoring of the fact
    table then needs no shuffle, and the dimensions read only their own
    columns (the null filter on the text has already been applied).
    """
    from chorus.plans.gate import ADVISORY, quality_gate
    comments = read_parquet(spark, comments_path)
    if clean_buckets:
        cleaned = clean_comments(comments)
        write_bucketed(cleaned.repartition(clean_buckets, "comment_id"),
                       clean_table, f"{out_dir}/_cleaned_comments",
                       "comment_id", clean_buckets, mode)
        comments = spark.table(clean_table)
    tables = build_star_schema(spark, comments,
                               read_parquet(spark, events_path), lexicon,
                               rules=rules,
                               already_clean=bool(clean_buckets))
    if gate:
        quality_gate(tables, fail_fast=True,
                     advisory=ADVISORY if advisory is None else advisory)
    paths = write_star(tables, out_dir, mode, partition_facts_by_month)
    if url:
        written = {n: read_parquet(spark, p).select(*tables[n].columns)
                   for n, p in paths.items()}
        serve(written, url, properties or {}, load_mode, **jdbc_options)
    return paths


# ---------------------------------------------------------------- P3
def conform_for_load(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: conform(df, LOAD_SCHEMA.get(n, {})) for n, df in tables.items()}


def serve(tables: dict[str, DataFrame], url: str, properties: dict,
          mode: str = "append", **jdbc_options) -> None:
    """Cast to the load schema and write dimensions before facts.  Mode
    ``merge`` replaces rows by key, in one transaction a table, and survives
    retried tasks (:func:`chorus.sources.jdbc.merge_jdbc`; ``column_types``
    is then a mapping of table to DDL)."""
    ready = conform_for_load(tables)
    if mode == "merge":
        types = jdbc_options.pop("column_types", {})
        for n in LOAD_ORDER:
            if n in ready:
                merge_jdbc(ready[n], url, n, LOAD_KEYS[n], properties, types.get(n),
                           **jdbc_options)
        return
    write_tables([(n, ready[n]) for n in LOAD_ORDER if n in ready], url,
                 mode, properties, **jdbc_options)
