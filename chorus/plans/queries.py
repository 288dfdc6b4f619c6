"""The registered queries.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables
(projected onto the reference's data model by
:mod:`chorus.sources.proxies`) together with its DuckDB SQL twin, written
independently from the Spark path and aliased to the same column names.
Queries without a twin are checked on row counts and by unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.functions import dates as fd
from chorus.functions.labels import score_label, topic_tag
from chorus.functions.text import english_stop_words
from chorus.operators import aggregates as agg
from chorus.operators import clean, filters, joins, quality, stats, terms
from chorus.operators import stance as st
from chorus.operators.calendar import date_dim_span
from chorus.operators.lexicon import B_DECR, B_INCR, Rules, lexicon_scores
from chorus.plans import gate, report, star
from chorus.plans.oracle import (COMMENTS, EVENTS_CLEAN, FEATURES,
                                 MONTH_NUM, MONTHLY_EVENTS, RAW_COMMENTS,
                                 SIDES, STANCE, TOKENS, in_list,
                                 scoring_tokens_sql, values_cte, with_)
from chorus.session import scratch_path
from chorus.sources import files, proxies, sampling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Fixed parameters of the test queries.  The test prose never contains
# opinion words, so sides, lexicon, negators and boosters use frequent words
# (FIXTURES.md).  Valences are binary fractions so that sums are exact in
# any order.
SIDE_A, SIDE_B = ["with"], ["was"]
LABEL_A, LABEL_B = "Pro A", "Pro B"
TOPIC_A, TOPIC_B = "with", "was"
LEXICON = [("the", 0.5), ("and", 1.25), ("with", -1.5), ("this", 2.0),
           ("that", -0.75), ("was", 1.0), ("de", -0.25), ("la", 0.75)]
NEGATORS = ["to", "it"]
BOOSTERS = {"of": B_INCR, "in": B_DECR}
TOP_K = 20
SAMPLE_FRACTION = 0.1


def _t(spark, sf, name):
    return proxies.table(spark, sf, name)


_SPREAD: dict = {}


def _docs(spark, sf):
    """The documents table, spread over the cores when under-split (the
    decision is taken once per session and table)."""
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _SPREAD:
        _SPREAD[key] = files.spread(_t(spark, sf, "documents"), "doc_id")
    return _SPREAD[key]


def _comments(spark, sf, text_work: bool = True):
    """Proxy comments; spread over the cores only for queries that do
    per-row text work (a spread of narrow columns would only add a shuffle)."""
    d = _docs(spark, sf) if text_work else _t(spark, sf, "documents")
    return proxies.comments(d)


def _lexicon(spark):
    return spark.createDataFrame(LEXICON, "term string, valence double")


def _r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


LEX_SQL = values_cte("lex", ("term", "valence"), LEXICON)


# ================================================================ sources
@query("parquet_scan", """
SELECT doc_id, text, lang, source, n_chars FROM documents""")
def parquet_scan(spark, sf):
    return files.read_parquet(spark, f"{sf.rstrip('/')}/documents.parquet")


@query("csv_roundtrip", """
SELECT doc_id, text, lang, source, n_chars FROM documents""")
def csv_roundtrip(spark, sf):
    d = _t(spark, sf, "documents")
    path = scratch_path(spark, "csv_roundtrip")
    files.write_extract(d, path)
    return files.read_csv(spark, path, d.schema)


@query("parquet_roundtrip", """
SELECT * FROM orders""")
def parquet_roundtrip(spark, sf):
    o = _t(spark, sf, "orders")
    path = scratch_path(spark, "parquet_roundtrip")
    files.write_stage(o, path)
    return files.read_parquet(spark, path)


@query("hash_sample", f"""
SELECT * FROM documents
WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
      < {int(SAMPLE_FRACTION * 2 ** 32)}""")
def hash_sample(spark, sf):
    d = _t(spark, sf, "documents")
    return sampling.hash_sample(d, "doc_id", SAMPLE_FRACTION)


@query("seeded_sample")
def seeded_sample(spark, sf):
    d = _t(spark, sf, "documents")
    return sampling.seeded_sample(d, SAMPLE_FRACTION, 42)


@query("dim_date", """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo,
                     CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
         FROM span)
SELECT date, CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
       strftime(date, '%m-%Y') AS month_year
FROM days""")
def dim_date(spark, sf):
    return date_dim_span(spark, _t(spark, sf, "orders"), "o_orderdate")


@query("preview", """
SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10""")
def preview(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source",
                                          "n_chars")
    return agg.preview(d, 10, ["doc_id"])


# ======================================================= projections
@query("drop_columns", """
SELECT doc_id, lang, n_chars FROM documents""")
def drop_columns(spark, sf):
    return clean.drop_columns(_t(spark, sf, "documents"), ["text", "source"])


@query("rename_columns", with_(MONTHLY_EVENTS) + """
SELECT Country AS country, Month, Year, Events AS events, Fatalities AS fatalities
FROM monthly_events""")
def rename_columns(spark, sf):
    ev = proxies.monthly_events(_t(spark, sf, "orders"),
                                _t(spark, sf, "customer"),
                                _t(spark, sf, "nation"))
    return clean.rename_columns(ev, {"Country": "country", "Events": "events",
                                     "Fatalities": "fatalities"})


@query("derived_columns", with_(COMMENTS) + """
SELECT comment_id, strftime(created_date, '%m-%Y') AS month_year,
       CAST(date_trunc('month', created_date) AS DATE) AS month_start,
       CASE WHEN score > 0.05 THEN 'Positive' WHEN score < -0.05 THEN 'Negative'
            ELSE 'Neutral' END AS sentiment_label
FROM comments""")
def derived_columns(spark, sf):
    c = _comments(spark, sf, text_work=False)
    out = clean.derive(c, {"month_year": fd.month_year("created_date"),
                           "month_start": fd.month_start("created_date"),
                           "sentiment_label": score_label("score")})
    return out.select("comment_id", "month_year", "month_start",
                      "sentiment_label")


def _month_names(spark, sf):
    o = _t(spark, sf, "orders")
    name = F.when(F.col("o_orderkey") % 7 == 0, F.lit("Janvier")).otherwise(
        F.date_format("o_orderdate", "MMMM"))
    return o.select("o_orderkey", name.alias("month_name"),
                    F.year("o_orderdate").alias("year"))


MONTH_NAMES_SQL = """names AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN 'Janvier'
              ELSE strftime(o_orderdate, '%B') END AS month_name,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders)"""


@query("month_name_to_num", with_(MONTH_NAMES_SQL) + """
SELECT o_orderkey, month_name, """ + MONTH_NUM.format("month_name") + """ AS month_num,
       concat_ws('-', """ + MONTH_NUM.format("month_name") + """, CAST(year AS VARCHAR)) AS month_year
FROM names""")
def month_name_to_num(spark, sf):
    n = _month_names(spark, sf)
    num = fd.month_name_to_num("month_name")
    return n.select("o_orderkey", "month_name", num.alias("month_num"),
                    fd.concat_ws_null("-", num, F.col("year"))
                    .alias("month_year"))


@query("score_label", with_(COMMENTS) + """
SELECT comment_id, score,
       CASE WHEN score > 0.05 THEN 'Positive' WHEN score < -0.05 THEN 'Negative'
            ELSE 'Neutral' END AS label_double,
       CASE WHEN CAST(CAST(score AS FLOAT) AS DOUBLE) > 0.05 THEN 'Positive'
            WHEN CAST(CAST(score AS FLOAT) AS DOUBLE) < -0.05 THEN 'Negative'
            ELSE 'Neutral' END AS label_float
FROM comments""")
def score_label_q(spark, sf):
    c = _comments(spark, sf, text_work=False)
    return c.select("comment_id", "score",
                    score_label("score").alias("label_double"),
                    score_label("score", score_type="float")
                    .alias("label_float"))


@query("topic_tag", with_(COMMENTS) + """
SELECT comment_id,
       CASE WHEN contains(self_text, 'was') AND NOT contains(self_text, 'with') THEN 'was'
            WHEN contains(self_text, 'with') AND NOT contains(self_text, 'was') THEN 'with'
            ELSE 'Neutral' END AS topic
FROM comments""")
def topic_tag_q(spark, sf):
    c = _comments(spark, sf)
    return c.select("comment_id", topic_tag(F.col("self_text"), SIDE_A,
                                            SIDE_B, TOPIC_A, TOPIC_B)
                    .alias("topic"))


# ============================================================ filters
@query("keyword_any", """
SELECT doc_id, lang FROM documents
WHERE contains(lower(text), 'with') OR contains(lower(text), 'was')""")
def keyword_any(spark, sf):
    d = _t(spark, sf, "documents")
    return filters.keyword_any(d, "text", SIDE_A + SIDE_B).select("doc_id",
                                                                  "lang")


WB = r"[^\p{L}\p{N}_]"


@query("keyword_any_word", f"""
SELECT doc_id, lang FROM documents
WHERE regexp_matches(text, '(?i)(^|{WB})(the|was)({WB}|$)')""")
def keyword_any_word(spark, sf):
    d = _t(spark, sf, "documents")
    return filters.keyword_any(d, "text", ["the", "was"], mode="word") \
        .select("doc_id", "lang")


@query("keyword_any_regex", """
SELECT doc_id, lang FROM documents
WHERE regexp_matches(text, '(?i)(?:wit[h]|th[ie]s )')""")
def keyword_any_regex(spark, sf):
    d = _t(spark, sf, "documents")
    return filters.keyword_any(d, "text", ["wit[h]", "th[ie]s "],
                               mode="regex").select("doc_id", "lang")


@query("keyword_all_groups", """
SELECT doc_id, lang FROM documents
WHERE (contains(lower(text), 'with') OR contains(lower(text), 'this'))
  AND contains(lower(text), 'was')""")
def keyword_all_groups(spark, sf):
    d = _t(spark, sf, "documents")
    return filters.keyword_all_groups(d, "text", [["with", "this"], ["was"]]) \
        .select("doc_id", "lang")


@query("exclusive_cohort", """
SELECT doc_id, lang FROM documents
WHERE contains(lower(text), 'with') AND NOT contains(lower(text), 'was')""")
def exclusive_cohort(spark, sf):
    d = _t(spark, sf, "documents")
    return filters.exclusive_cohort(d, "text", SIDE_A, SIDE_B) \
        .select("doc_id", "lang")


@query("period_filter", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-10-01' AND o_orderdate < TIMESTAMP '1996-11-01'""")
def period_filter(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate",
                                       "o_totalprice")
    return filters.period_filter(o, "o_orderdate", 1996, 10)


@query("label_filter", with_(COMMENTS) + """
SELECT comment_id, score FROM comments WHERE score < -0.05""")
def label_filter(spark, sf):
    c = _comments(spark, sf, text_work=False).withColumn("label", score_label("score"))
    return filters.label_filter(c, "label", "Negative").select("comment_id",
                                                               "score")


# ======================================================= null handling
NULLY_SQL = """nully AS (
  SELECT doc_id AS comment_id,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE source || '-' || CAST(doc_id % 7 AS VARCHAR) END AS author_name,
         CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id % 2 = 0 END AS verified,
         CASE WHEN doc_id % 5 = 0 THEN NULL
              ELSE CAST(n_chars % 201 - 100 AS DOUBLE) / 100 END AS score
  FROM documents)"""


def _nully(spark, sf):
    """Comments with nulls injected into lang, a flag and the score: one
    projection of documents (no join)."""
    d = _t(spark, sf, "documents")
    i = F.col("doc_id")
    return d.select(
        i.alias("comment_id"),
        proxies.author_of(i, F.col("source")).alias("author_name"),
        F.when(i % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.col("lang")).alias("lang"),
        F.when(i % 13 == 0, F.lit(None).cast("boolean")).otherwise(
            i % 2 == 0).alias("verified"),
        F.when(i % 5 == 0, F.lit(None).cast("double")).otherwise(
            ((F.col("n_chars") % 201 - 100) / 100).cast("double"))
        .alias("score"))


@query("drop_any_null", with_(NULLY_SQL) + """
SELECT comment_id FROM nully WHERE author_name IS NOT NULL AND lang IS NOT NULL""")
def drop_any_null(spark, sf):
    return clean.drop_any_null(_nully(spark, sf), ["author_name", "lang"]) \
        .select("comment_id")


@query("drop_all_null", with_(NULLY_SQL) + """
SELECT comment_id FROM nully WHERE author_name IS NOT NULL OR lang IS NOT NULL""")
def drop_all_null(spark, sf):
    return clean.drop_all_null(_nully(spark, sf), ["author_name", "lang"]) \
        .select("comment_id")


@query("fill_nulls", with_(NULLY_SQL) + """
SELECT comment_id, coalesce(author_name, 'unknown') AS author_name,
       coalesce(lang, 'xx') AS lang, coalesce(verified, false) AS verified,
       coalesce(score, 0.0) AS score
FROM nully""")
def fill_nulls(spark, sf):
    return clean.fill_nulls(_nully(spark, sf), {
        "author_name": "unknown", "lang": "xx", "verified": False,
        "score": 0.0})


TEXTY_SQL = """texty AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS cust,
         CASE WHEN o_orderkey % 11 = 0 THEN 'garbage'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN o_orderkey % 13 = 0 THEN 'n/a'
              ELSE CAST(round(o_totalprice) AS BIGINT)::VARCHAR END AS price,
         CASE WHEN o_orderkey % 17 = 0 THEN 'maybe'
              WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag
  FROM orders)"""


def _texty(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.when(k % 7 == 0, F.lit("x")).otherwise(
            F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 11 == 0, F.lit("garbage")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(
            F.round("o_totalprice").cast("bigint").cast("string"))
        .alias("price"),
        F.when(k % 17 == 0, F.lit("maybe")).when(k % 2 == 0, F.lit("true"))
        .otherwise(F.lit("false")).alias("flag"))


CONFORM_TO = {"cust": "int", "ts": "timestamp_ntz", "price": "float",
              "flag": "boolean"}


@query("conform_schema", with_(TEXTY_SQL) + """
SELECT id, TRY_CAST(cust AS INTEGER) AS cust, TRY_CAST(ts AS TIMESTAMP) AS ts,
       TRY_CAST(price AS FLOAT) AS price, TRY_CAST(flag AS BOOLEAN) AS flag
FROM texty""")
def conform_schema(spark, sf):
    return clean.conform(_texty(spark, sf), CONFORM_TO)


@query("conform_lost", with_(TEXTY_SQL) + """
SELECT 'cust' AS "column", CAST(count_if(TRY_CAST(cust AS INTEGER) IS NULL) AS BIGINT) AS lost FROM texty
UNION ALL SELECT 'ts', CAST(count_if(TRY_CAST(ts AS TIMESTAMP) IS NULL) AS BIGINT) FROM texty
UNION ALL SELECT 'price', CAST(count_if(TRY_CAST(price AS FLOAT) IS NULL) AS BIGINT) FROM texty
UNION ALL SELECT 'flag', CAST(count_if(TRY_CAST(flag AS BOOLEAN) IS NULL) AS BIGINT) FROM texty""")
def conform_lost(spark, sf):
    return clean.conform_report(_texty(spark, sf), CONFORM_TO)


@query("dedup_rows", """
SELECT min(doc_id) AS doc_id, text, arg_min_null(lang, doc_id) AS lang,
       arg_min_null(source, doc_id) AS source, arg_min_null(n_chars, doc_id) AS n_chars
FROM documents GROUP BY text""")
def dedup_rows(spark, sf):
    d = _t(spark, sf, "documents")
    return clean.dedup(d, keys=["text"], order_by=["doc_id"])


@query("dedup_exact", """
SELECT DISTINCT * FROM documents""")
def dedup_exact(spark, sf):
    """Whole rows, of which a third came twice."""
    d = _t(spark, sf, "documents")
    return clean.dedup(d.unionByName(d.filter(F.col("doc_id") % 3 == 0)))


# ============================================================== joins
COHORT_MEANS_SQL = """cohort_a AS (
  SELECT author_name, avg(score) AS score_a FROM sides
  WHERE only_a AND author_name IS NOT NULL GROUP BY author_name),
cohort_b AS (
  SELECT author_name, avg(score) AS score_b FROM sides
  WHERE only_b AND author_name IS NOT NULL GROUP BY author_name),
both_means AS (
  SELECT * FROM cohort_a FULL OUTER JOIN cohort_b USING (author_name))"""


def _cohort_mean(c, cond, name):
    return agg.grouped_mean(c.filter(cond), "author_name", "score", name)


def _both_means(spark, sf):
    c = _comments(spark, sf)
    a, b = st.side_conditions(F.col("self_text"), SIDE_A, SIDE_B)
    return c, joins.outer_means(_cohort_mean(c, a, "m"),
                                _cohort_mean(c, b, "m"), "author_name",
                                "m", "m", "score_a", "score_b")


@query("outer_means", with_(COMMENTS, SIDES, COHORT_MEANS_SQL) + """
SELECT author_name, round(score_a, 6) AS score_a, round(score_b, 6) AS score_b
FROM both_means""")
def outer_means(spark, sf):
    _, m = _both_means(spark, sf)
    return m.select("author_name", *_r6("score_a", "score_b"))


@query("author_spine_left", with_(COMMENTS, SIDES, COHORT_MEANS_SQL) + """
SELECT a.author_name, round(m.score_a, 6) AS score_a, round(m.score_b, 6) AS score_b
FROM (SELECT DISTINCT author_name FROM comments) a
LEFT JOIN both_means m ON a.author_name = m.author_name""")
def author_spine_left(spark, sf):
    c, m = _both_means(spark, sf)
    return joins.spine_left(c, "author_name", m).select(
        "author_name", *_r6("score_a", "score_b"))


@query("enrich_left", with_(COMMENTS, SIDES, STANCE) + """
SELECT c.comment_id, c.author_name, coalesce(s.stance, 'Neutral') AS stance
FROM comments c LEFT JOIN stance s ON c.author_name = s.author_name""")
def enrich_left(spark, sf):
    c = _comments(spark, sf)
    s = st.author_stance_onepass(c, "author_name", "self_text", "score",
                                 SIDE_A, SIDE_B, LABEL_A, LABEL_B)
    return joins.enrich_left(c.select("comment_id", "author_name"),
                             s.select("author_name", "stance"),
                             "author_name", {"stance": "Neutral"})


# ===================================================== aggregations
@query("author_mean", with_(COMMENTS, SIDES) + """
SELECT author_name, round(avg(score), 6) AS mean_score FROM sides
WHERE only_a AND author_name IS NOT NULL GROUP BY author_name""")
def author_mean(spark, sf):
    c = _comments(spark, sf)
    a, _ = st.side_conditions(F.col("self_text"), SIDE_A, SIDE_B)
    m = agg.grouped_mean(c.filter(a), "author_name", "score", "mean_score")
    return m.select("author_name", *_r6("mean_score"))


@query("dim_user", """
SELECT user_id, max(value) AS max_value, min(value) AS min_value, min(ts) AS first_ts
FROM events GROUP BY user_id""")
def dim_user(spark, sf):
    e = _t(spark, sf, "events")
    return agg.dimension(e, ["user_id"], maxes={"value": "max_value"},
                         mins={"value": "min_value", "ts": "first_ts"})


@query("dim_post", """
SELECT o_custkey, o_orderstatus, o_orderpriority,
       strftime(o_orderdate, '%m-%Y') AS month_year,
       max(o_totalprice) AS max_price, min(o_orderdate) AS first_order
FROM orders GROUP BY 1, 2, 3, 4""")
def dim_post(spark, sf):
    o = _t(spark, sf, "orders").withColumn("month_year_post",
                                           fd.month_year("o_orderdate"))
    d = agg.dimension(o, ["o_custkey", "o_orderstatus", "o_orderpriority",
                          "month_year_post"],
                      maxes={"o_totalprice": "max_price"},
                      mins={"o_orderdate": "first_order"})
    return d.withColumnRenamed("month_year_post", "month_year")


@query("extract_daily_stance", with_(COMMENTS, SIDES, STANCE, FEATURES) + """
SELECT created_date, stance, count(comment_id) AS n_comments
FROM feats WHERE created_date IS NOT NULL AND self_text IS NOT NULL
GROUP BY created_date, stance""")
def extract_daily_stance(spark, sf):
    return _extract(spark, sf, "daily_stance")


@query("extract_topic_label", with_(COMMENTS, SIDES, STANCE, FEATURES) + """
SELECT stance, topic, sentiment_label, created_date, count(comment_id) AS n_comments
FROM feats WHERE created_date IS NOT NULL AND self_text IS NOT NULL
GROUP BY stance, topic, sentiment_label, created_date""")
def extract_topic_label(spark, sf):
    return _extract(spark, sf, "topic_label")


@query("extract_topic_score", with_(COMMENTS, SIDES, STANCE, FEATURES) + """
SELECT stance, topic, sentiment_label, created_date, sentiment_score,
       count(comment_id) AS n_comments
FROM feats WHERE created_date IS NOT NULL AND self_text IS NOT NULL AND sentiment_score IS NOT NULL
GROUP BY stance, topic, sentiment_label, created_date, sentiment_score""")
def extract_topic_score(spark, sf):
    return _extract(spark, sf, "topic_score")


def _extract(spark, sf, name):
    return report.extract(_comments(spark, sf), name, "author_name",
                          "comment_id", "self_text", "score", "created_date",
                          SIDE_A, SIDE_B, LABEL_A, LABEL_B, TOPIC_A, TOPIC_B)


@query("csv_extract", with_(COMMENTS, SIDES, STANCE, FEATURES) + """
SELECT created_date, stance, count(comment_id) AS n_comments
FROM feats WHERE created_date IS NOT NULL AND self_text IS NOT NULL
GROUP BY created_date, stance""")
def csv_extract(spark, sf):
    ex = _extract(spark, sf, "daily_stance")
    path = scratch_path(spark, "csv_extract")
    files.write_extract(ex, path)
    return files.read_extract(spark, path, ex.schema)


LABELS_SQL = """labelled AS (
  SELECT comment_id,
         CASE WHEN score > 0.05 THEN 'Positive' WHEN score < -0.05 THEN 'Negative'
              ELSE 'Neutral' END AS sentiment_label
  FROM comments)"""


@query("value_counts", with_(COMMENTS, LABELS_SQL) + """
SELECT sentiment_label, count(*) AS count FROM labelled
WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""")
def value_counts(spark, sf):
    c = _comments(spark, sf, text_work=False).withColumn("sentiment_label",
                                        score_label("score"))
    return agg.value_counts(c, "sentiment_label")


@query("value_counts_total", with_(COMMENTS, LABELS_SQL) + """
SELECT sentiment_label, count(*) AS count,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM labelled WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""")
def value_counts_total(spark, sf):
    c = _comments(spark, sf, text_work=False).withColumn("sentiment_label",
                                        score_label("score"))
    return agg.value_counts_total(c, "sentiment_label")


@query("cohort_label_counts", with_(COMMENTS) + """
SELECT sentiment_label, count(*) AS count,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM (SELECT CASE WHEN score > 0.05 THEN 'Positive'
                  WHEN score < -0.05 THEN 'Negative' ELSE 'Neutral' END
               AS sentiment_label
      FROM comments
      WHERE self_text IS NOT NULL
        AND (contains(lower(self_text), 'with') OR contains(lower(self_text), 'this')))
GROUP BY sentiment_label""")
def cohort_label_counts(spark, sf):
    """Label distribution (with total) of a keyword cohort."""
    c = _comments(spark, sf).withColumn("sentiment_label",
                                        score_label("score"))
    cohort = filters.keyword_any(c.filter(F.col("self_text").isNotNull()),
                                 "self_text", ["with", "this"])
    return agg.value_counts_total(cohort, "sentiment_label")


@query("group_label_counts", with_(COMMENTS) + """
SELECT sentiment_label, count(*) AS count,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM (SELECT CASE WHEN score > 0.05 THEN 'Positive'
                  WHEN score < -0.05 THEN 'Negative' ELSE 'Neutral' END
               AS sentiment_label
      FROM comments
      WHERE self_text IS NOT NULL
        AND (contains(lower(self_text), 'with') OR contains(lower(self_text), 'this'))
        AND contains(lower(self_text), 'was'))
GROUP BY sentiment_label""")
def group_label_counts(spark, sf):
    """Label distribution (with total) of a cohort matching every keyword
    group: (with or this) and was."""
    c = _comments(spark, sf).withColumn("sentiment_label",
                                        score_label("score"))
    cohort = filters.keyword_all_groups(
        c.filter(F.col("self_text").isNotNull()), "self_text",
        [["with", "this"], ["was"]])
    return agg.value_counts_total(cohort, "sentiment_label")


PERIODS = {"2023-10": (2023, 10), "2024-11": (2024, 11)}


@query("cohort_period_means", with_(COMMENTS, SIDES) + """,
cells AS (
  SELECT p.period, k.cohort, s.score
  FROM sides s
  JOIN (VALUES ('2023-10', DATE '2023-10-01', DATE '2023-11-01'),
               ('2024-11', DATE '2024-11-01', DATE '2024-12-01')) p(period, lo, hi)
    ON s.created_date >= p.lo AND s.created_date < p.hi
  JOIN (VALUES ('all'), ('A'), ('B')) k(cohort)
    ON k.cohort = 'all' OR (k.cohort = 'A' AND s.only_a) OR (k.cohort = 'B' AND s.only_b))
SELECT g.period, g.cohort, round(avg(c.score), 6) AS mean, count(c.score) AS n
FROM (VALUES ('2023-10', 'all'), ('2023-10', 'A'), ('2023-10', 'B'),
             ('2024-11', 'all'), ('2024-11', 'A'), ('2024-11', 'B')) g(period, cohort)
LEFT JOIN cells c ON c.period = g.period AND c.cohort = g.cohort
GROUP BY g.period, g.cohort""")
def cohort_period_means(spark, sf):
    c = _comments(spark, sf)
    a, b = st.side_conditions(F.col("self_text"), SIDE_A, SIDE_B)
    periods = {name: filters.period_condition(c, "created_date", y, m)
               for name, (y, m) in PERIODS.items()}
    out = agg.cohort_period_means(c, "score", {"A": a, "B": b}, periods)
    return out.select("period", "cohort", *_r6("mean"), "n")


WEEKS = {"2024-W1": ("2024-01-01", "2024-01-08"),
         "2024-W2": ("2024-01-08", "2024-01-15")}


@query("event_period_means", """
WITH ec AS (SELECT event_id AS comment_id, user_id AS author, ts AS created_time,
                   value AS score, event_type AS topic FROM events),
cells AS (
  SELECT p.period, k.cohort, e.score
  FROM ec e
  JOIN (VALUES ('2024-W1', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08'),
               ('2024-W2', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15')) p(period, lo, hi)
    ON e.created_time >= p.lo AND e.created_time < p.hi
  JOIN (VALUES ('all'), ('click'), ('view')) k(cohort)
    ON k.cohort = 'all' OR k.cohort = e.topic)
SELECT g.period, g.cohort, round(avg(c.score), 6) AS mean, count(c.score) AS n
FROM (VALUES ('2024-W1', 'all'), ('2024-W1', 'click'), ('2024-W1', 'view'),
             ('2024-W2', 'all'), ('2024-W2', 'click'), ('2024-W2', 'view')) g(period, cohort)
LEFT JOIN cells c ON c.period = g.period AND c.cohort = g.cohort
GROUP BY g.period, g.cohort""")
def event_period_means(spark, sf):
    ec = proxies.event_comments(_t(spark, sf, "events"))
    periods = {name: filters.range_condition(ec, "created_time", lo, hi)
               for name, (lo, hi) in WEEKS.items()}
    cohorts = {t: F.col("topic") == t for t in ("click", "view")}
    out = agg.cohort_period_means(ec, "score", cohorts, periods)
    return out.select("period", "cohort", *_r6("mean"), "n")


@query("numeric_summary", with_(COMMENTS) + """
SELECT count(score) AS n, round(avg(score), 6) AS mean,
       round(stddev_samp(score), 6) AS std, min(score) AS min,
       round(quantile_cont(score, 0.25), 6) AS q25,
       round(quantile_cont(score, 0.5), 6) AS q50,
       round(quantile_cont(score, 0.75), 6) AS q75, max(score) AS max
FROM comments""")
def numeric_summary(spark, sf):
    s = agg.numeric_summary(_comments(spark, sf, text_work=False), "score")
    return s.select("n", *_r6("mean", "std"), "min",
                    *_r6("q25", "q50", "q75"), "max")


@query("numeric_summary_prices", """
SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
       round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min,
       round(quantile_cont(o_totalprice, 0.25), 6) AS q25,
       round(quantile_cont(o_totalprice, 0.5), 6) AS q50,
       round(quantile_cont(o_totalprice, 0.75), 6) AS q75, max(o_totalprice) AS max
FROM orders""")
def numeric_summary_prices(spark, sf):
    s = agg.numeric_summary(_t(spark, sf, "orders"), "o_totalprice")
    return s.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *_r6("q25", "q50", "q75"), "max")


NULL_COLS = ["comment_id", "author_name", "self_text", "post_self_text",
             "user_is_verified", "created_time"]


@query("null_profile", with_(RAW_COMMENTS) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count "
    f"FROM raw_comments" for c in NULL_COLS))
def null_profile(spark, sf):
    raw = proxies.raw_comments(_t(spark, sf, "documents"))
    return agg.null_profile(raw, NULL_COLS)


@query("distinct_values", with_(COMMENTS) + """
SELECT DISTINCT author_name FROM comments""")
def distinct_values(spark, sf):
    return agg.distinct_values(_comments(spark, sf, text_work=False), "author_name")


WELCH_SQL = """
SELECT n_a, round(mean_a, 6) AS mean_a, round(var_a, 6) AS var_a,
       n_b, round(mean_b, 6) AS mean_b, round(var_b, 6) AS var_b,
       round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), 6) AS t,
       round(pow(var_a / n_a + var_b / n_b, 2)
             / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)), 6) AS df
FROM m"""


@query("welch_ttest", """
WITH m AS (
  SELECT count(value) FILTER (WHERE event_type = 'click') AS n_a,
         avg(value) FILTER (WHERE event_type = 'click') AS mean_a,
         var_samp(value) FILTER (WHERE event_type = 'click') AS var_a,
         count(value) FILTER (WHERE event_type = 'view') AS n_b,
         avg(value) FILTER (WHERE event_type = 'view') AS mean_b,
         var_samp(value) FILTER (WHERE event_type = 'view') AS var_b
  FROM events)""" + WELCH_SQL)
def welch_ttest(spark, sf):
    e = _t(spark, sf, "events")
    r = stats.welch_ttest(e, "value", F.col("event_type") == "click",
                          F.col("event_type") == "view", with_p=False)
    return r.select("n_a", *_r6("mean_a", "var_a"), "n_b",
                    *_r6("mean_b", "var_b", "t", "df"))


@query("welch_periods", with_(COMMENTS) + """,
m AS (
  SELECT count(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                                AND created_date < DATE '2023-11-01') AS n_a,
         avg(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                              AND created_date < DATE '2023-11-01') AS mean_a,
         var_samp(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                                   AND created_date < DATE '2023-11-01') AS var_a,
         count(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                                AND created_date < DATE '2024-12-01') AS n_b,
         avg(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                              AND created_date < DATE '2024-12-01') AS mean_b,
         var_samp(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                                   AND created_date < DATE '2024-12-01') AS var_b
  FROM comments)""" + WELCH_SQL)
def welch_periods(spark, sf):
    c = _comments(spark, sf, text_work=False)
    r = stats.welch_ttest(
        c, "score", filters.period_condition(c, "created_date", 2023, 10),
        filters.period_condition(c, "created_date", 2024, 11), with_p=False)
    return r.select("n_a", *_r6("mean_a", "var_a"), "n_b",
                    *_r6("mean_b", "var_b", "t", "df"))


def _guard(e: str) -> str:
    return f"(CASE WHEN abs({e}) < 1e-300 THEN 1e-300 ELSE {e} END)"


# p = I_x(df/2, 1/2), x = df / (df + t^2): the regularised incomplete beta
# by its continued fraction (modified Lentz), iterated by a recursive CTE.
PVALUE_SQL = """,
w AS (
  SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
         pow(var_a / n_a + var_b / n_b, 2)
           / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)) AS df
  FROM m),
x AS (SELECT *, df / (df + t * t) AS xv, df / 2 AS a,
             CAST(0.5 AS DOUBLE) AS b FROM w),
br AS (
  SELECT *, xv < (a + 1) / (a + b + 2) AS direct,
         CASE WHEN xv < (a + 1) / (a + b + 2) THEN a ELSE b END AS pa,
         CASE WHEN xv < (a + 1) / (a + b + 2) THEN b ELSE a END AS pb,
         CASE WHEN xv < (a + 1) / (a + b + 2) THEN xv ELSE 1 - xv END AS px,
         exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(xv) + b * ln(1 - xv))
           AS front
  FROM x),
cf(k, c, d, h, done) AS (
  SELECT 0, CAST(1.0 AS DOUBLE),
         1 / """ + _guard("(1 - (pa + pb) * px / (pa + 1))") + """,
         1 / """ + _guard("(1 - (pa + pb) * px / (pa + 1))") + """, false
  FROM br
  UNION ALL
  SELECT k + 1, c2, d2, h * d1 * c1 * d2 * c2, abs(d2 * c2 - 1) < 3e-16
  FROM (
    SELECT cf.k, cf.h,
           (k + 1) * (pb - (k + 1)) * px / ((pa - 1 + 2 * (k + 1)) * (pa + 2 * (k + 1))) AS e1,
           1 / """ + _guard("(1 + e1 * cf.d)") + """ AS d1,
           """ + _guard("(1 + e1 / cf.c)") + """ AS c1,
           -(pa + (k + 1)) * (pa + pb + (k + 1)) * px
             / ((pa + 2 * (k + 1)) * (pa + 1 + 2 * (k + 1))) AS e2,
           1 / """ + _guard("(1 + e2 * d1)") + """ AS d2,
           """ + _guard("(1 + e2 / c1)") + """ AS c2
    FROM cf, br WHERE NOT cf.done AND cf.k < 300) step)
SELECT n_a, round(mean_a, 6) AS mean_a, round(var_a, 6) AS var_a,
       n_b, round(mean_b, 6) AS mean_b, round(var_b, 6) AS var_b,
       round(t, 6) AS t, round(df, 6) AS df,
       round(CASE WHEN direct THEN front * h / pa ELSE 1 - front * h / pa END, 6) AS p
FROM br, (SELECT h FROM cf ORDER BY k DESC LIMIT 1) last"""


@query("welch_pvalue", """
WITH RECURSIVE m AS (
  SELECT count(value) FILTER (WHERE event_type = 'click') AS n_a,
         avg(value) FILTER (WHERE event_type = 'click') AS mean_a,
         var_samp(value) FILTER (WHERE event_type = 'click') AS var_a,
         count(value) FILTER (WHERE event_type = 'view') AS n_b,
         avg(value) FILTER (WHERE event_type = 'view') AS mean_b,
         var_samp(value) FILTER (WHERE event_type = 'view') AS var_b
  FROM events)""" + PVALUE_SQL)
def welch_pvalue(spark, sf):
    e = _t(spark, sf, "events")
    r = stats.welch_ttest(e, "value", F.col("event_type") == "click",
                          F.col("event_type") == "view")
    return r.select("n_a", *_r6("mean_a", "var_a"), "n_b",
                    *_r6("mean_b", "var_b", "t", "df", "p"))


@query("period_ttest", "WITH RECURSIVE " + COMMENTS + """,
m AS (
  SELECT count(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                                AND created_date < DATE '2023-11-01') AS n_a,
         avg(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                              AND created_date < DATE '2023-11-01') AS mean_a,
         var_samp(score) FILTER (WHERE created_date >= DATE '2023-10-01'
                                   AND created_date < DATE '2023-11-01') AS var_a,
         count(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                                AND created_date < DATE '2024-12-01') AS n_b,
         avg(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                              AND created_date < DATE '2024-12-01') AS mean_b,
         var_samp(score) FILTER (WHERE created_date >= DATE '2024-11-01'
                                   AND created_date < DATE '2024-12-01') AS var_b
  FROM comments)""" + PVALUE_SQL)
def period_ttest(spark, sf):
    """The analysis's period comparison: Welch t, df and two-sided p of the
    scores of October 2023 against November 2024."""
    c = _comments(spark, sf, text_work=False)
    r = stats.welch_ttest(
        c, "score", filters.period_condition(c, "created_date", 2023, 10),
        filters.period_condition(c, "created_date", 2024, 11))
    return r.select("n_a", *_r6("mean_a", "var_a"), "n_b",
                    *_r6("mean_b", "var_b", "t", "df", "p"))


# =============================================================== text
def _stop_sql():
    return in_list(english_stop_words())


@query("top_terms", TOKENS.join(["WITH ", ",\n"]) + """counts AS (
  SELECT term, count(*) AS tf FROM toks WHERE term NOT IN """ + _stop_sql() + """
  GROUP BY term ORDER BY tf DESC, term LIMIT """ + str(TOP_K) + """)
SELECT term, tf FROM counts""")
def top_terms(spark, sf):
    return terms.top_terms(_docs(spark, sf), "text", TOP_K)


@query("doc_term_counts", "WITH " + TOKENS + """,
vocab AS (
  SELECT term FROM toks WHERE term NOT IN """ + _stop_sql() + """
  GROUP BY term ORDER BY count(*) DESC, term LIMIT """ + str(TOP_K) + """)
SELECT doc_id, term, count(*) AS tf FROM toks JOIN vocab USING (term)
GROUP BY doc_id, term""")
def doc_term_counts(spark, sf):
    return terms.doc_term_counts(_docs(spark, sf), "doc_id", "text",
                                 TOP_K)


@query("lexicon_score", "WITH " + LEX_SQL + """,
toks AS (SELECT doc_id, unnest(""" + scoring_tokens_sql("text") + """) AS term FROM documents),
sums AS (SELECT doc_id, sum(valence) AS s FROM toks JOIN lex USING (term) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS sentiment_score
FROM documents d LEFT JOIN sums USING (doc_id)""")
def lexicon_score(spark, sf):
    return lexicon_scores(_docs(spark, sf), "doc_id", "text",
                          _lexicon(spark), lexicon_rows=len(LEXICON))


NEG_SQL = in_list(NEGATORS)


def _boost_sql(p):
    return ("CASE " + " ".join(f"WHEN {p} = '{k}' THEN {v!r}"
                               for k, v in sorted(BOOSTERS.items()))
            + " ELSE 0.0 END")


def _walk_sql(value):
    """CTEs w1..w3: the valence after each token back, nearest first."""
    out, prev = [], value
    for k, w in ((1, 1.0), (2, 0.95), (3, 0.9)):
        out.append(f"""
w{k} AS (SELECT *, ({prev} + sign({prev}) * ({_boost_sql(f"p{k}")}) * {w!r})
         * CASE WHEN p{k} IN {NEG_SQL} THEN -0.74 ELSE 1.0 END AS v{k}
  FROM {"items JOIN lex USING (term)" if k == 1 else f"w{k - 1}"}),""")
        prev = f"v{k}"
    return "".join(out)


@query("lexicon_score_negated", "WITH " + LEX_SQL + """,
arrs AS (SELECT doc_id, """ + scoring_tokens_sql("text") + """ AS a
         FROM documents),
items AS (
  SELECT doc_id, a[i] AS term,
         CASE WHEN i > 1 THEN a[i - 1] END AS p1,
         CASE WHEN i > 2 THEN a[i - 2] END AS p2,
         CASE WHEN i > 3 THEN a[i - 3] END AS p3
  FROM (SELECT doc_id, a, generate_subscripts(a, 1) AS i FROM arrs)),
""" + _walk_sql("valence") + """
hits AS (SELECT doc_id, v3 AS v FROM w3),
sums AS (SELECT doc_id, sum(v) AS s FROM hits GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS sentiment_score
FROM documents d LEFT JOIN sums USING (doc_id)""")
def lexicon_score_negated(spark, sf):
    return lexicon_scores(_docs(spark, sf), "doc_id", "text",
                          _lexicon(spark), lexicon_rows=len(LEXICON),
                          rules=Rules(negators=NEGATORS, boosters=BOOSTERS))


CONTRAST = "is"


@query("lexicon_score_rules", "WITH " + LEX_SQL + """,
arrs AS (SELECT doc_id, """ + scoring_tokens_sql("text") + """ AS a
         FROM documents),
items AS (
  SELECT doc_id, a[i] AS term, i AS pos,
         coalesce(list_position(a, '""" + CONTRAST + """'), 0) AS ci,
         CASE WHEN i > 1 THEN a[i - 1] END AS p1,
         CASE WHEN i > 2 THEN a[i - 2] END AS p2,
         CASE WHEN i > 3 THEN a[i - 3] END AS p3
  FROM (SELECT doc_id, a, generate_subscripts(a, 1) AS i FROM arrs)),
""" + _walk_sql("valence") + """
hits AS (
  SELECT doc_id, v3
         * CASE WHEN ci > 0 AND pos < ci THEN 0.5
                WHEN ci > 0 AND pos > ci THEN 1.5 ELSE 1.0 END AS v
  FROM w3),
sums AS (SELECT doc_id, sum(v) AS s0 FROM hits GROUP BY doc_id),
marks AS (
  SELECT doc_id, length(text) - length(replace(text, '!', '')) AS e,
         length(text) - length(replace(text, '?', '')) AS q
  FROM documents),
amp AS (
  SELECT doc_id, least(e, 4) * 0.292
         + CASE WHEN q <= 1 THEN 0.0 WHEN q <= 3 THEN q * 0.18 ELSE 0.96 END AS amp
  FROM marks),
fin AS (
  SELECT doc_id, CASE WHEN s0 > 0 THEN s0 + amp WHEN s0 < 0 THEN s0 - amp
                      ELSE s0 END AS s
  FROM sums JOIN amp USING (doc_id))
SELECT d.doc_id, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS sentiment_score
FROM documents d LEFT JOIN fin USING (doc_id)""")
def lexicon_score_rules(spark, sf):
    return lexicon_scores(_docs(spark, sf), "doc_id", "text",
                          _lexicon(spark), lexicon_rows=len(LEXICON),
                          rules=Rules(negators=NEGATORS, boosters=BOOSTERS,
                                      contrast=CONTRAST, punctuation=True))


# ============================================================= stance
@query("author_stance_onepass", with_(COMMENTS, SIDES, STANCE) + """
SELECT author_name, round(score_a, 6) AS score_a, round(score_b, 6) AS score_b, stance
FROM stance""")
def author_stance_onepass(spark, sf):
    c = _comments(spark, sf)
    return st.author_stance_onepass(c, "author_name", "self_text", "score",
                                    SIDE_A, SIDE_B, LABEL_A, LABEL_B) \
        .select("author_name", *_r6("score_a", "score_b"), "stance")


@query("author_stance", SQL["author_stance_onepass"])
def author_stance(spark, sf):
    c = _comments(spark, sf)
    return st.author_stance(c, "author_name", "self_text", "score",
                            SIDE_A, SIDE_B, LABEL_A, LABEL_B) \
        .select("author_name", *_r6("score_a", "score_b"), "stance")


@query("stance_counts", with_(COMMENTS, SIDES, STANCE) + """
SELECT stance, count(*) AS count FROM stance GROUP BY stance""")
def stance_counts(spark, sf):
    c = _comments(spark, sf)
    s = st.author_stance_onepass(c, "author_name", "self_text", "score",
                                 SIDE_A, SIDE_B, LABEL_A, LABEL_B)
    return st.stance_counts(s)


@query("enriched_comments", with_(COMMENTS, SIDES, STANCE, FEATURES) + """
SELECT comment_id, author_name, stance, topic, created_date FROM feats""")
def enriched_comments(spark, sf):
    c = _comments(spark, sf)
    s = st.author_stance_onepass(c, "author_name", "self_text", "score",
                                 SIDE_A, SIDE_B, LABEL_A, LABEL_B)
    e = st.enriched_comments(c, s, "author_name", "self_text",
                             "created_date", SIDE_A, SIDE_B, TOPIC_A, TOPIC_B)
    return e.select("comment_id", "author_name", "stance", "topic",
                    "created_date")


# ========================================================== scalars
@query("month_year", """
SELECT o_orderkey, strftime(o_orderdate, '%m-%Y') AS month_year FROM orders""")
def month_year_q(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", fd.month_year("o_orderdate")
                    .alias("month_year"))


@query("parse_date", with_(TEXTY_SQL) + """
SELECT id, CAST(try_strptime(left(ts, 10), '%Y-%m-%d') AS DATE) AS d FROM texty""")
def parse_date(spark, sf):
    t = _texty(spark, sf)
    return t.select("id", fd.parse_date(F.substring("ts", 1, 10),
                                        "yyyy-MM-dd").alias("d"))


@query("parse_timestamp", with_(TEXTY_SQL) + """
SELECT id, try_strptime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM texty""")
def parse_timestamp(spark, sf):
    t = _texty(spark, sf)
    return t.select("id", fd.parse_timestamp("ts", "yyyy-MM-dd HH:mm:ss",
                                             ntz=True).alias("ts"))


@query("ts_to_date", """
SELECT event_id, CAST(ts AS DATE) AS created_date FROM events""")
def ts_to_date(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", fd.ts_to_date("ts").alias("created_date"))


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def date_parts(spark, sf):
    o = _t(spark, sf, "orders")
    y, m = fd.date_parts("o_orderdate")
    return o.select("o_orderkey", y.alias("year"), m.alias("month"))


@query("concat_ws_null", """
SELECT o_orderkey,
       concat_ws('-', CASE WHEN o_orderkey % 5 = 0 THEN NULL
                           ELSE strftime(o_orderdate, '%m') END,
                 CAST(year(o_orderdate) AS VARCHAR)) AS month_year
FROM orders""")
def concat_ws_null(spark, sf):
    o = _t(spark, sf, "orders")
    mm = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")) \
        .otherwise(F.date_format("o_orderdate", "MM"))
    return o.select("o_orderkey", fd.concat_ws_null(
        "-", mm, F.year("o_orderdate")).alias("month_year"))


# ============================================================ quality
def _dq_selects(table: str, suite: str, checks) -> list[str]:
    """One SELECT per check (expectation, column, SQL condition under which
    a non-null value is unexpected)."""
    parts = []
    for exp, col, unexpected_sql in checks:
        if exp == "expect_column_values_to_not_be_null":
            u = f"CAST(count_if({col} IS NULL) AS BIGINT)"
            base = "count(*)"
        else:
            u = (f"CAST(count_if({col} IS NOT NULL AND ({unexpected_sql})) "
                 f"AS BIGINT)")
            base = f"count({col})"
        parts.append(
            f"SELECT '{suite}' AS suite, '{exp}' AS expectation, "
            f"'{col}' AS \"column\", count(*) AS element_count, "
            f"CAST(count_if({col} IS NULL) AS BIGINT) AS missing_count, "
            f"{u} AS unexpected_count, "
            f"CASE WHEN {base} > 0 THEN CAST({u} AS DOUBLE) * 100 / {base} END "
            f"AS unexpected_percent, {u} = 0 AS success FROM {table}")
    return parts


def _dq_sql(table_cte: str, table: str, suite: str, checks) -> str:
    return with_(table_cte) + "\nUNION ALL\n".join(
        _dq_selects(table, suite, checks))


NN = "expect_column_values_to_not_be_null"
OT = "expect_column_values_to_be_of_type"
TL = "expect_column_values_to_be_in_type_list"
IS = "expect_column_values_to_be_in_set"
DF = "expect_column_values_to_match_strftime_format"
BT = "expect_column_values_to_be_between"

DQ_EVENTS_SQL = """ev AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE value - 10 END AS value,
         user_id,
         CASE WHEN event_id % 5 = 0 THEN CAST(value AS VARCHAR) || 'x'
              WHEN event_id % 3 = 0 THEN NULL
              ELSE CAST(user_id AS VARCHAR) END AS user_text,
         CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              WHEN event_id % 4 = 1 THEN strftime(ts, '%d/%m/%Y')
              ELSE NULL END AS ts_text
  FROM events)"""


def _dq_events(spark, sf):
    e = _t(spark, sf, "events")
    i = F.col("event_id")
    return e.select(
        "event_id",
        F.when(i % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.col("event_type")).alias("event_type"),
        F.when(i % 9 == 0, F.lit(None).cast("double")).otherwise(
            F.col("value") - 10).alias("value"),
        "user_id",
        F.when(i % 5 == 0, F.concat(F.col("value").cast("string"),
                                    F.lit("x")))
         .when(i % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("user_id").cast("string")).alias("user_text"),
        F.when(i % 4 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
         .when(i % 4 == 1, F.date_format("ts", "dd/MM/yyyy"))
         .alias("ts_text"))


@query("dq_not_null", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (NN, "event_type", None), (NN, "value", None), (NN, "user_id", None)]))
def dq_not_null(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.not_null("event_type"), quality.not_null("value"),
        quality.not_null("user_id")])


@query("dq_of_type", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (OT, "user_text", "TRY_CAST(user_text AS BIGINT) IS NULL"),
    (OT, "user_id", "false"), (OT, "value", "true")]))
def dq_of_type(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.of_type("user_text", "int"), quality.of_type("user_id", "int"),
        quality.of_type("value", "int")])


@query("dq_type_list", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (TL, "user_text", "TRY_CAST(user_text AS DOUBLE) IS NULL "
                      "AND TRY_CAST(user_text AS BIGINT) IS NULL"),
    (TL, "value", "false")]))
def dq_type_list(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.type_in_list("user_text", ["float", "int"]),
        quality.type_in_list("value", ["float", "int"])])


@query("dq_in_set", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (IS, "event_type", "event_type NOT IN ('click', 'view', 'purchase')")]))
def dq_in_set(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.in_set("event_type", ["click", "view", "purchase"])])


@query("dq_datetime_format", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (DF, "ts_text", "try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NULL")]))
def dq_datetime_format(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.datetime_format("ts_text", "%Y-%m-%d %H:%M:%S")])


@query("dq_between", _dq_sql(DQ_EVENTS_SQL, "ev", "s", [
    (BT, "value", "value < 0"), (BT, "user_id", "user_id < 10 OR user_id > 100")]))
def dq_between(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "s", [
        quality.between("value", 0, None),
        quality.between("user_id", 10, 100)])


@query("dq_suite", _dq_sql(DQ_EVENTS_SQL, "ev", "events-suite", [
    (NN, "event_id", None), (NN, "event_type", None),
    (IS, "event_type", "event_type NOT IN ('click', 'view', 'purchase', 'signup')"),
    (OT, "user_text", "TRY_CAST(user_text AS BIGINT) IS NULL"),
    (DF, "ts_text", "try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NULL"),
    (BT, "value", "value < 0")]))
def dq_suite(spark, sf):
    return quality.run_suite(_dq_events(spark, sf), "events-suite", [
        quality.not_null("event_id"), quality.not_null("event_type"),
        quality.in_set("event_type", ["click", "view", "purchase", "signup"]),
        quality.of_type("user_text", "int"),
        quality.datetime_format("ts_text", "%Y-%m-%d %H:%M:%S"),
        quality.between("value", 0, None)])


# ======================================================= star schema
def _star(spark, sf, text_work: bool = False):
    """The five star tables.  Checking them does no text work (no check reads
    the score, so Catalyst drops the scoring join): the documents are spread
    only for queries that read it."""
    d = _docs(spark, sf) if text_work else _t(spark, sf, "documents")
    raw = proxies.raw_comments(d)
    ev = proxies.monthly_events(_t(spark, sf, "orders"),
                                _t(spark, sf, "customer"),
                                _t(spark, sf, "nation"))
    span = raw.select(F.to_date("created_time").alias("d"))
    return star.build_star_schema_span(spark, raw, ev, _lexicon(spark),
                                       span, "d", lexicon_rows=len(LEXICON))


FACT_SQL = """cleaned AS (
  SELECT *, strftime(created_time, '%m-%Y') AS month_year,
         strftime(post_created_time, '%m-%Y') AS month_year_post
  FROM raw_comments
  WHERE post_id IS NOT NULL AND score IS NOT NULL AND post_title IS NOT NULL
    AND comment_id IS NOT NULL AND self_text IS NOT NULL AND subreddit IS NOT NULL
    AND author_name IS NOT NULL AND created_time IS NOT NULL),
ctoks AS (SELECT comment_id, unnest(""" + scoring_tokens_sql("self_text") + """) AS term
          FROM cleaned),
csums AS (SELECT comment_id, sum(valence) AS s FROM ctoks JOIN lex USING (term)
          GROUP BY comment_id),
fact AS (
  SELECT c.comment_id, c.score, c.self_text, c.subreddit, c.created_time,
         c.controversiality, c.author_name, c.post_id, c.month_year,
         CAST(round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS FLOAT) AS sentiment_score
  FROM cleaned c LEFT JOIN csums USING (comment_id))"""

FACT_SELECT = """
SELECT comment_id, score, self_text, subreddit, created_time, controversiality,
       author_name, post_id, month_year, sentiment_score,
       CASE WHEN CAST(sentiment_score AS DOUBLE) > 0.05 THEN 'Positive'
            WHEN CAST(sentiment_score AS DOUBLE) < -0.05 THEN 'Negative'
            ELSE 'Neutral' END AS sentiment_label
FROM fact"""


@query("fact_comment", with_(RAW_COMMENTS, LEX_SQL, FACT_SQL) + FACT_SELECT)
def fact_comment(spark, sf):
    raw = proxies.raw_comments(_docs(spark, sf))
    return star.fact_comment(star.clean_comments(raw), _lexicon(spark),
                             lexicon_rows=len(LEXICON))


@query("fact_assault", with_(MONTHLY_EVENTS, EVENTS_CLEAN) + """
SELECT country, month_year, events, fatalities FROM events_clean""")
def fact_assault(spark, sf):
    ev = proxies.monthly_events(_t(spark, sf, "orders"),
                                _t(spark, sf, "customer"),
                                _t(spark, sf, "nation"))
    return star.clean_events(ev).select(*star.FACT_ASSAULT_COLUMNS)


STAR_DIMS_SQL = """dim_post AS (
  SELECT post_id, post_title, post_self_text, month_year_post AS month_year,
         max(post_score) AS post_score, max(post_upvote_ratio) AS post_upvote_ratio,
         max(post_thumbs_ups) AS post_thumbs_ups,
         max(post_total_awards_received) AS post_total_awards_received,
         min(post_created_time) AS post_created_time
  FROM cleaned GROUP BY 1, 2, 3, 4),
dim_user AS (
  SELECT author_name, max(coalesce(user_is_verified, false)) AS user_is_verified,
         min(user_account_created_time) AS user_account_created_time,
         max(user_awardee_karma) AS user_awardee_karma,
         max(user_awarder_karma) AS user_awarder_karma,
         max(user_link_karma) AS user_link_karma,
         max(user_comment_karma) AS user_comment_karma,
         max(user_total_karma) AS user_total_karma
  FROM cleaned GROUP BY author_name),
dim_date AS (
  SELECT d AS date, strftime(d, '%m') AS month, strftime(d, '%Y') AS year,
         strftime(d, '%m-%Y') AS month_year
  FROM (SELECT CAST(unnest(generate_series(min(CAST(created_time AS DATE)),
                                           max(CAST(created_time AS DATE)),
                                           INTERVAL 1 DAY)) AS DATE) AS d
        FROM raw_comments))"""

# Whole-number measures of each star table, whose sums are the same in any
# order: (table, CTE, [(measure, Spark expression, SQL expression)]).
def _days(c):
    return (f"datediff(to_date({c}), date'1970-01-01')",
            f"date_diff('day', DATE '1970-01-01', CAST({c} AS DATE))")


def _plain(*cols):
    return [(c, f"CAST({c} AS BIGINT)", f"CAST({c} AS BIGINT)") for c in cols]


def _hundredths(c, factor):
    e = f"CAST(round(CAST({c} AS DOUBLE) * {factor}) AS BIGINT)"
    return (c, e, e)


STAR_MEASURES = [
    ("fact_comment", "fact", [
        *_plain("score", "controversiality"), _hundredths("sentiment_score", 10000),
        ("self_text", "char_length(self_text)", "length(self_text)"),
        ("created_time", *_days("created_time"))]),
    ("fact_assault", "events_clean", _plain("events", "fatalities")),
    ("dim_user", "dim_user", [
        ("user_is_verified", *["CASE WHEN user_is_verified THEN 1 ELSE 0 END"] * 2),
        ("user_account_created_time", *_days("user_account_created_time")),
        *_plain(*star.USER_MAX[1:])]),
    ("dim_post", "dim_post", [
        *_plain("post_score", "post_thumbs_ups", "post_total_awards_received"),
        _hundredths("post_upvote_ratio", 100),
        ("post_created_time", *_days("post_created_time"))]),
    ("dim_date", "dim_date", [*_plain("month", "year"), ("date", *_days("date"))]),
]


@query("star_schema", with_(RAW_COMMENTS, MONTHLY_EVENTS, EVENTS_CLEAN, LEX_SQL, FACT_SQL,
                            STAR_DIMS_SQL) + "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, '{name}' AS measure, count(*) AS n_rows, "
    f"CAST(sum({sql}) AS BIGINT) AS total FROM {cte}"
    for table, cte, measures in STAR_MEASURES for name, _, sql in measures))
def star_schema(spark, sf):
    """Row count and sum of every measure of the five tables."""
    tables = _star(spark, sf, text_work=True)
    out = None
    for table, _, measures in STAR_MEASURES:
        sums = tables[table].agg(F.count(F.lit(1)).alias("n"), *[
            F.expr(f"sum({e})").cast("bigint").alias(f"s{i}")
            for i, (_, e, _) in enumerate(measures)])
        one = sums.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("measure"),
                     F.col("n").alias("n_rows"), F.col(f"s{i}").alias("total"))
            for i, (name, _, _) in enumerate(measures)])).alias("r")).select("r.*")
        out = one if out is None else out.unionByName(one)
    return out


def _star_sql(table: str) -> str:
    return with_(RAW_COMMENTS, LEX_SQL, FACT_SQL, STAR_DIMS_SQL) + f"\nSELECT * FROM {table}"


@query("star_dim_user", _star_sql("dim_user"))
def star_dim_user(spark, sf):
    return _star(spark, sf)["dim_user"]


@query("star_dim_post", _star_sql("dim_post"))
def star_dim_post(spark, sf):
    return _star(spark, sf)["dim_post"]


@query("star_dim_date", _star_sql("dim_date"))
def star_dim_date(spark, sf):
    return _star(spark, sf)["dim_date"]


@query("star_load_types", with_(RAW_COMMENTS, LEX_SQL, FACT_SQL, STAR_DIMS_SQL) + """
SELECT p.*, CAST(d.month AS INTEGER) AS month, CAST(d.year AS INTEGER) AS year
FROM dim_post p LEFT JOIN dim_date d ON d.date = CAST(p.post_created_time AS DATE)""")
def star_load_types(spark, sf):
    """Posts as they are loaded, beside the loaded date of their creation."""
    tables = _star(spark, sf)
    ready = star.conform_for_load({k: tables[k] for k in ("dim_post", "dim_date")})
    dates = ready["dim_date"].select("date", "month", "year")
    return ready["dim_post"].join(
        dates, F.to_date("post_created_time") == dates["date"], "left").drop("date")


DTF = "try_strptime(CAST({0} AS VARCHAR), '%Y-%m-%d %H:%M:%S') IS NULL"
GATE_SQL_CHECKS = {
    "expectation-dim-post": ("dim_post", [
        (NN, "post_id", None), (OT, "post_score", "false"),
        (NN, "post_title", None), (TL, "post_upvote_ratio", "false"),
        (OT, "post_thumbs_ups", "false"),
        (OT, "post_total_awards_received", "false"),
        (OT, "post_created_time", "false")]),
    "expectation-dim-user": ("dim_user", [
        (NN, "author_name", None),
        (IS, "user_is_verified", "user_is_verified NOT IN (true, false)"),
        (DF, "user_account_created_time",
         DTF.format("user_account_created_time")),
        (NN, "user_awardee_karma", None), (NN, "user_awarder_karma", None),
        (NN, "user_link_karma", None), (NN, "user_comment_karma", None),
        (NN, "user_total_karma", None)]),
    "expectation-fact-comment": ("fact", [
        (NN, "comment_id", None), (NN, "self_text", None),
        (NN, "subreddit", None), (NN, "created_time", None),
        (DF, "created_time", DTF.format("created_time")),
        (NN, "author_name", None), (NN, "post_id", None)]),
    "expectation-dim-date": ("dim_date", [
        (NN, "month_year", None), (NN, "month", None), (NN, "year", None),
        (NN, "date", None), (DF, "date", DTF.format("date"))]),
    "expectation-fact-assault": ("events_clean", [
        (NN, "country", None), (BT, "events", "events < 0"),
        (BT, "fatalities", "fatalities < 0")]),
}


@query("dq_gate", with_(RAW_COMMENTS, MONTHLY_EVENTS, EVENTS_CLEAN, LEX_SQL,
                        FACT_SQL, STAR_DIMS_SQL) + "\nUNION ALL\n".join(
    sel for suite, (table, checks) in GATE_SQL_CHECKS.items()
    for sel in _dq_selects(table, suite, checks)))
def dq_gate(spark, sf):
    return gate.quality_gate(_star(spark, sf))


@query("stream_fact_comment", with_(RAW_COMMENTS, LEX_SQL, FACT_SQL)
       + FACT_SELECT)
def stream_fact_comment(spark, sf):
    from chorus.streaming.incremental import read_facts, run_incremental_fact
    base = scratch_path(spark, "stream_fact_comment")
    docs_schema = _t(spark, sf, "documents").schema
    # A glob path streams the table whether it is one file or a folder of files.
    run_incremental_fact(spark, f"{sf.rstrip('/')}/{{documents.parquet}}", docs_schema,
                         _lexicon(spark), f"{base}/sink", f"{base}/checkpoint",
                         transform=proxies.raw_comments)
    return read_facts(spark, f"{base}/sink")


# Registered beside these, on the same parameters.
from chorus.plans import queries_daily  # noqa: E402, F401
