"""Projections of the test tables onto the reference's data model.

The test tables hold no social-media comments, so each concept is a fixed
projection of a given table (the same expressions appear in the SQL
oracles).  All projections are narrow ``select``s: they prune columns at
the Parquet scan and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# Fixed values of the projections.
COMMENT_EPOCH = "2023-10-01"     # created_date = epoch + doc_id % 400 days
DATE_SPAN_DAYS = 400
NULL_AUTHOR_EVERY = 11           # author is null when doc_id % 11 = 0
AUTHORS_PER_SOURCE = 7           # author = source || '-' || doc_id % 7
N_POSTS = 53                     # post_id = 'p' || doc_id % 53


_RESOLVED: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, resolved once per session (as a catalog table would
    be): later calls reuse the DataFrame instead of re-reading footers."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    df = _RESOLVED.get(key)
    if df is None:
        df = _RESOLVED[key] = spark.read.parquet(path)
    return df


def author_of(doc_id, source):
    """Proxy author: null every 11th document, else source-(doc_id % 7)."""
    return (F.when(doc_id % NULL_AUTHOR_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(source, F.lit("-"),
                                (doc_id % AUTHORS_PER_SOURCE).cast("string"))))


def comments(docs: DataFrame) -> DataFrame:
    """comment_id, author_name, self_text, created_date, score."""
    d = F.col("doc_id")
    return docs.select(
        d.alias("comment_id"),
        author_of(d, F.col("source")).alias("author_name"),
        F.col("text").alias("self_text"),
        F.date_add(F.lit(COMMENT_EPOCH).cast("date"),
                   (d % DATE_SPAN_DAYS).cast("int")).alias("created_date"),
        ((F.col("n_chars") % 201 - 100) / 100).cast("double").alias("score"),
    )


def raw_comments(docs: DataFrame) -> DataFrame:
    """The full raw comment schema of the ETL, projected from documents.

    Nulls are injected where the cleaning steps must act on them:
    author (every 11th), post_self_text (every 5th post) and
    user_is_verified (every 13th).
    """
    d = F.col("doc_id")
    post = d % N_POSTS
    created = F.date_add(F.lit(COMMENT_EPOCH).cast("date"),
                         (d % DATE_SPAN_DAYS).cast("int"))
    return docs.select(
        d.alias("comment_id"),
        (F.col("n_chars") % 201 - 100).cast("int").alias("score"),
        F.col("text").alias("self_text"),
        F.col("lang").alias("subreddit"),
        F.timestamp_add("SECOND", (d * 7919) % 86400,
                       created.cast("timestamp_ntz")).alias("created_time"),
        (d % 3 == 0).cast("float").alias("controversiality"),
        author_of(d, F.col("source")).alias("author_name"),
        F.concat(F.lit("p"), post.cast("string")).alias("post_id"),
        F.concat(F.lit("Post "), post.cast("string")).alias("post_title"),
        F.when(post % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("body "), post.cast("string")))
         .alias("post_self_text"),
        (post * 3 + d % 4).cast("int").alias("post_score"),
        ((d % 100) / 100).cast("float").alias("post_upvote_ratio"),
        (post * 2 + d % 5).cast("int").alias("post_thumbs_ups"),
        (d % 6).cast("int").alias("post_total_awards_received"),
        F.timestamp_add("HOUR", (d % 24),
                       F.date_add(F.lit("2023-09-01").cast("date"),
                                  post.cast("int")).cast("timestamp_ntz"))
         .alias("post_created_time"),
        F.when(d % 13 == 0, F.lit(None).cast("boolean"))
         .otherwise(d % 2 == 0).alias("user_is_verified"),
        F.timestamp_add("DAY", (d % 1000).cast("int"),
                       F.lit("2015-01-01 00:00:00").cast("timestamp_ntz"))
         .alias("user_account_created_time"),
        (d % 50).cast("int").alias("user_awardee_karma"),
        (d % 30).cast("int").alias("user_awarder_karma"),
        (F.col("n_chars") % 1000).cast("int").alias("user_link_karma"),
        (F.col("n_chars") % 777).cast("int").alias("user_comment_karma"),
        (F.col("n_chars") % 1777).cast("int").alias("user_total_karma"),
    )


def event_comments(events: DataFrame) -> DataFrame:
    """Comments with user and time but no text: author=user_id,
    created_time=ts, score=value, topic=event_type."""
    return events.select(
        F.col("event_id").alias("comment_id"),
        F.col("user_id").alias("author"),
        F.col("ts").alias("created_time"),
        F.col("value").alias("score"),
        F.col("event_type").alias("topic"),
    )


def monthly_events(orders: DataFrame, customer: DataFrame,
                   nation: DataFrame) -> DataFrame:
    """Monthly conflict-event rows: Country, Month (English name), Year,
    Events, Fatalities, from orders by customer nation and month."""
    o = orders.select("o_custkey", "o_orderdate", "o_orderkey")
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.col("n_name").alias("Country"),
                      F.date_format("o_orderdate", "MMMM").alias("Month"),
                      F.year("o_orderdate").alias("Year"))
             .agg(F.count("o_orderkey").cast("int").alias("Events"),
                  F.sum((F.col("o_orderkey") % 3).cast("int"))
                   .cast("int").alias("Fatalities")))
