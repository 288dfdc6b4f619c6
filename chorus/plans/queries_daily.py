"""The registered queries of the published star schema, the one-read report,
the merged daily state and scoring by id and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from chorus.operators import filters
from chorus.operators.inference import infer_types as infer
from chorus.operators.lexicon import (LEXICON_MAX_ROWS, lexicon_score, lexicon_scores,
                                      phrase_scores)
from chorus.plans import publish, report, star
from chorus.plans.oracle import (COMMENTS, EVENTS_CLEAN, FEATURES, MONTHLY_EVENTS,
                                 RAW_COMMENTS, SIDES, STANCE, TOKENS, scoring_tokens_sql,
                                 values_cte, with_)
from chorus.plans.queries import (FACT_SQL, GATE_SQL_CHECKS, LABEL_A, LABEL_B, LEX_SQL,
                                  LEXICON, PVALUE_SQL, SIDE_A, SIDE_B, SQL, STAR_DIMS_SQL,
                                  TOP_K, TOPIC_A, TOPIC_B, _comments, _docs, _dq_selects,
                                  _lexicon, _stop_sql, _t, query)
from chorus.session import scratch_path
from chorus.sources import csv_split, files, proxies, versions
from chorus.streaming import merged

# ------------------------------------------------------------------ P5 + P2 + P3
# The published date dimension spans the cleaned comments.
PUBLISHED_DIMS_SQL = "FROM cleaned".join(STAR_DIMS_SQL.rsplit("FROM raw_comments", 1))


@query("dq_gate_staged", with_(RAW_COMMENTS, MONTHLY_EVENTS, EVENTS_CLEAN, LEX_SQL, FACT_SQL,
                               PUBLISHED_DIMS_SQL) + "\nUNION ALL\n".join(
    sel for suite, (table, checks) in GATE_SQL_CHECKS.items()
    for sel in _dq_selects(table, suite, checks)))
def dq_gate_staged(spark, sf):
    """The audit of a published star schema, as read from its files."""
    root = scratch_path(spark, "dq_gate_staged")
    events = proxies.monthly_events(_t(spark, sf, "orders"), _t(spark, sf, "customer"),
                                    _t(spark, sf, "nation"))
    publish.publish_star(spark, proxies.raw_comments(_docs(spark, sf)), events,
                         _lexicon(spark), root, dates_from="created_time",
                         lexicon_rows=len(LEXICON))
    return versions.open_table(spark, root, publish.AUDIT)


# ---------------------------------------------------------------------------- P4
PARAMS = report.ReportParams(
    cohort_keywords=["with", "this"], cohort_groups=[["with", "this"], ["was"]],
    side_a=SIDE_A, side_b=SIDE_B, label_a=LABEL_A, label_b=LABEL_B, topic_a=TOPIC_A,
    topic_b=TOPIC_B, periods=[(2023, 10), (2024, 11)], top_k=TOP_K)


def _out(output, keys, n="NULL", value="NULL"):
    keys = [f"CAST({k} AS VARCHAR)" for k in [*keys, *["NULL"] * (4 - len(keys))]]
    named = ", ".join(f"{k} AS key{i + 1}" for i, k in enumerate(keys))
    return (f"SELECT '{output}' AS output, {named}, CAST({n} AS BIGINT) AS n, "
            f"round(CAST({value} AS DOUBLE), 6) AS value")


def _period(col, lo, hi):
    return f"{col} >= DATE '{lo}' AND {col} < DATE '{hi}'"


OCT, NOV = ("2023-10-01", "2023-11-01"), ("2024-11-01", "2024-12-01")
STATISTICS = ["n_a", "mean_a", "var_a", "n_b", "mean_b", "var_b", "t", "df", "p"]

REPORT_SQL = with_(COMMENTS, SIDES, STANCE, FEATURES, TOKENS, "told AS (" + f"""
  SELECT sentiment_label AS label, 'label_counts' AS output FROM feats
  WHERE contains(lower(self_text), 'with') OR contains(lower(self_text), 'this')
  UNION ALL SELECT sentiment_label, 'group_label_counts' FROM feats
  WHERE (contains(lower(self_text), 'with') OR contains(lower(self_text), 'this'))
    AND contains(lower(self_text), 'was')),
told_n AS (SELECT output, label, count(*) AS n FROM told GROUP BY ALL),
test AS (
  SELECT * FROM (WITH RECURSIVE m AS (
    SELECT {", ".join(f"{f}(score) FILTER (WHERE {_period('created_date', *span)}) AS {c}_{s}"
                      for s, span in (("a", OCT), ("b", NOV))
                      for c, f in (("n", "count"), ("mean", "avg"), ("var", "var_samp")))}
    FROM comments WHERE self_text IS NOT NULL)""" + PVALUE_SQL + f""")),
cells AS (
  SELECT p.period, k.cohort, count(s.score) AS n, avg(s.score) AS mean
  FROM (VALUES ('2023-10', DATE '{OCT[0]}', DATE '{OCT[1]}'),
               ('2024-11', DATE '{NOV[0]}', DATE '{NOV[1]}')) p(period, lo, hi)
  CROSS JOIN (VALUES ('all'), ('A'), ('B')) k(cohort)
  LEFT JOIN sides s ON s.self_text IS NOT NULL
    AND s.created_date >= p.lo AND s.created_date < p.hi
    AND (k.cohort = 'all' OR (k.cohort = 'A' AND s.only_a) OR (k.cohort = 'B' AND s.only_b))
  GROUP BY ALL),
top AS (SELECT term, count(*) AS tf FROM toks WHERE term NOT IN {_stop_sql()}
        GROUP BY term ORDER BY tf DESC, term LIMIT {TOP_K}),
counted AS (SELECT * FROM feats WHERE self_text IS NOT NULL AND created_date IS NOT NULL
            AND sentiment_score IS NOT NULL)
""".rstrip()) + "\nUNION ALL\n".join([
    _out("", ["label"], "n", "sum(n) OVER (PARTITION BY output)")
    .replace("'' AS output", "output") + " FROM told_n",
    *[_out("period_test", [f"'{c}'"], value=c) + " FROM test" for c in STATISTICS],
    _out("period_means", ["period", "cohort"], "n", "mean") + " FROM cells",
    _out("stance", ["author_name", "stance", "'A'"], value="score_a") + " FROM stance",
    _out("stance", ["author_name", "stance", "'B'"], value="score_b") + " FROM stance",
    _out("stance_counts", ["stance"], "count(*)") + " FROM stance GROUP BY stance",
    _out("top_terms", ["term"], "tf") + " FROM top",
    _out("daily_stance", ["created_date", "stance"], "count(comment_id)")
    + " FROM counted GROUP BY created_date, stance",
    _out("topic_label", ["stance", "topic", "sentiment_label", "created_date"],
         "count(comment_id)")
    + " FROM counted GROUP BY stance, topic, sentiment_label, created_date",
    _out("topic_score", ["stance", "topic", "sentiment_label", "created_date"],
         "count(comment_id)", "sentiment_score")
    + " FROM counted GROUP BY stance, topic, sentiment_label, created_date, sentiment_score",
])


@query("report_summary", REPORT_SQL)
def report_summary(spark, sf):
    """The whole analysis report as one table."""
    return report.report_summary(_comments(spark, sf), PARAMS) \
        .withColumn("value", F.round("value", 6))


# ------------------------------------------------------------- merged daily state
#: The whole comment table in three loads, by date.
LOADS = [("2000-01-01", "2024-01-15"), ("2024-01-15", "2024-06-01"), ("2024-06-01", "2100-01-01")]


def _loads(df, day):
    return [df.filter((F.to_date(day) >= F.lit(a).cast("date"))
                      & (F.to_date(day) < F.lit(b).cast("date"))) for a, b in LOADS]


@query("daily_extract_merged", SQL["extract_topic_score"])
def daily_extract_merged(spark, sf):
    """Three daily loads, the second one replayed: as one batch."""
    root = scratch_path(spark, "daily_extract_merged")
    parts = _loads(_comments(spark, sf), "created_date")
    for batch in (1, 2, 2, 3):
        merged.merge_extract(spark, root, batch, parts[batch - 1], PARAMS)
    return merged.read_extracts(spark, root)["topic_score"]


def _merged_dimension(spark, sf, name, keys, maxima, minima):
    root = scratch_path(spark, name)
    cleaned = star.clean_comments(proxies.raw_comments(_t(spark, sf, "documents")))
    parts = _loads(cleaned, "created_time")
    for batch in (1, 2, 2, 3):
        merged.merge_dimension(spark, root, batch, parts[batch - 1], keys, maxima, minima)
    return merged.read_dimension(spark, root)


@query("merged_dim_user", SQL["star_dim_user"])
def merged_dim_user(spark, sf):
    out = _merged_dimension(spark, sf, "merged_dim_user", ["author_name"], star.USER_MAX,
                            ["user_account_created_time"])
    return out.select("author_name", "user_is_verified", "user_account_created_time",
                      *star.USER_MAX[1:])


@query("merged_dim_post", SQL["star_dim_post"])
def merged_dim_post(spark, sf):
    out = _merged_dimension(spark, sf, "merged_dim_post", star.POST_KEYS, star.POST_MAX,
                            ["post_created_time"])
    return out.withColumnRenamed("month_year_post", "month_year")


# -------------------------------------------------------- scoring by id and text
def _score_sql(new_id):
    return "WITH " + LEX_SQL + f""",
d AS (SELECT {new_id} AS k, doc_id, text FROM documents),
toks AS (SELECT doc_id, unnest({scoring_tokens_sql("text")}) AS term FROM d),
sums AS (SELECT doc_id, sum(valence) AS s FROM toks JOIN lex USING (term) GROUP BY doc_id)
SELECT k, doc_id, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS sentiment_score
FROM d LEFT JOIN sums USING (doc_id)"""


def _scored(spark, sf, key):
    d = _docs(spark, sf).select(key.alias("k"), "doc_id", "text")
    return lexicon_score(d, "k", "text", _lexicon(spark),
                         lexicon_rows=len(LEXICON)).drop("text")


@query("lexicon_score_shared_id", _score_sql("doc_id % 10"))
def lexicon_score_shared_id(spark, sf):
    """Many texts under one id: each row by its own text."""
    return _scored(spark, sf, F.col("doc_id") % 10)


@query("lexicon_score_null_id", _score_sql("CASE WHEN doc_id % 3 > 0 THEN doc_id END"))
def lexicon_score_null_id(spark, sf):
    """A third of the rows without an id: scored like the others."""
    return _scored(spark, sf, F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))


# ------------------------------------------------------------ a large lexicon
@query("lexicon_score_large", SQL["lexicon_score"])
def lexicon_score_large(spark, sf):
    """The lexicon taken as too large to broadcast: only hot terms are."""
    return lexicon_scores(_docs(spark, sf), "doc_id", "text", _lexicon(spark),
                          lexicon_rows=LEXICON_MAX_ROWS + 1)


# ------------------------------------------------------------------- phrases
#: Phrases beside the words of the lexicon; some begin with one of them.
PHRASES = [("of the", 1.5), ("the and", -2.0), ("and the", 0.75), ("with and the", 2.5),
           ("the the of", -0.5), ("de la", 1.25), ("is the with", -1.0), ("on the", 0.5)]
MAX_PHRASE = 3


@query("lexicon_score_phrases", "WITH " + values_cte("lex", ("term", "valence"),
                                                     LEXICON + PHRASES) + """,
arrs AS (SELECT doc_id, """ + scoring_tokens_sql("text") + f""" AS a FROM documents),
runs AS (
  SELECT doc_id, i, k, array_to_string(a[i:i + k - 1], ' ') AS term
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM arrs),
       range(1, {MAX_PHRASE + 1}) r(k)
  WHERE i + k - 1 <= len(a)),
hits AS (
  SELECT doc_id, list({{'next': i + 0, 'shorter': -k, 'sum': valence}} ORDER BY i, -k) AS h
  FROM runs JOIN lex USING (term) GROUP BY doc_id),
sums AS (
  SELECT doc_id, list_reduce(
    list_prepend({{'next': 1::BIGINT, 'shorter': 0::BIGINT, 'sum': 0.0::DOUBLE}}, h),
    lambda acc, x: CASE WHEN x."next" >= acc."next"
      THEN {{'next': x."next" - x.shorter, 'shorter': 0::BIGINT, 'sum': acc.sum + x.sum}}
      ELSE acc END).sum AS s
  FROM hits)
SELECT d.doc_id, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 4) AS sentiment_score
FROM documents d LEFT JOIN sums USING (doc_id)""")
def lexicon_score_phrases(spark, sf):
    """Words and phrases, the longest match from left to right."""
    lex = spark.createDataFrame(LEXICON + PHRASES, "term string, valence double")
    return phrase_scores(_docs(spark, sf), "doc_id", "text", lex,
                         lexicon_rows=len(LEXICON + PHRASES))


# ------------------------------------------------------------- many keywords
MANY_WORDS = [f"{a}{b}{c}" for a in ("ta", "ne", "ou", "the", "er")
              for b in ("rion", "nti", "ion", "reth", "an", "st", "ed", "with", "th", "re")
              for c in ("", "an", "in", "es", "ou", "le", "ti", "on", "ment", "en",
                        *[str(n) for n in range(30)])]


@query("keyword_any_many", f"""
SELECT doc_id FROM documents
WHERE len(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
                      lambda x: x IN ({", ".join(f"'{w}'" for w in MANY_WORDS)}))) > 0""")
def keyword_any_many(spark, sf):
    """Two thousand keywords."""
    return filters.keyword_any_many(_docs(spark, sf), "text", MANY_WORDS).select("doc_id")


# ------------------------------------------------------------ inferred types
#: Columns of orders as an untyped export holds them, one with a stray value.
EXPORT = {"o_orderkey": "CAST(o_orderkey AS {0})", "o_totalprice": "CAST(o_totalprice AS {0})",
          "o_orderstatus": "CAST(o_orderstatus AS {0})",
          "day": "substring(CAST(o_orderdate AS {0}), 1, 10)",
          "late": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' WHEN o_orderkey % 3 = 0 THEN 'FALSE' END",
          "big": "concat('9', lpad(CAST(o_orderkey AS {0}), 12, '0'))",
          "stray": "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_custkey AS {0}) END",
          "empty": "CAST(NULL AS {0})"}
TOLERANCE = 0.05
_FORMS_SQL = {
    "boolean": "regexp_matches({0}, '^(true|false)$', 'i')",
    "int": "regexp_matches({0}, '^[+-]?[0-9]{{1,10}}$') AND TRY_CAST({0} AS INTEGER) IS NOT NULL",
    "bigint": "regexp_matches({0}, '^[+-]?[0-9]{{1,18}}$')",
    "double": "regexp_matches({0}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')",
    "date": "regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
            "AND TRY_CAST({0} AS DATE) IS NOT NULL"}


def _infer_sql(column):
    spoilt = {k: f"count_if(v IS NOT NULL AND NOT ({f.format('v')}))" for k, f in _FORMS_SQL.items()}
    case = lambda then: " ".join(
        f"WHEN count(v) > 0 AND {n} <= {TOLERANCE} * count(v) THEN {then(k, n)}"
        for k, n in spoilt.items())
    kind, bad = case(lambda k, n: f"'{k}'"), case(lambda k, n: n)
    return (f"SELECT '{column}' AS \"column\", CASE {kind} ELSE 'string' END AS type, "
            f"count(*) AS n_rows, count(v) AS n_values, "
            f"CAST(CASE {bad} ELSE 0 END AS BIGINT) AS n_malformed "
            f"FROM (SELECT {EXPORT[column].format('VARCHAR')} AS v FROM orders)")


@query("infer_types", "\nUNION ALL\n".join(map(_infer_sql, EXPORT)))
def infer_types(spark, sf):
    o = _t(spark, sf, "orders")
    return infer(o.select(*[F.expr(e.format("STRING")).alias(c) for c, e in EXPORT.items()]),
                 tolerance=TOLERANCE)


# ------------------------------------------------------- multi-line CSV, split
@query("csv_split_scan", SQL["csv_roundtrip"])
def csv_split_scan(spark, sf):
    """The documents as multi-line CSV, one file a task of the scan, each file
    read by several tasks when it is larger than a split."""
    d = _t(spark, sf, "documents")
    path = scratch_path(spark, "csv_split_scan")
    files.write_extract(d, path)
    return csv_split.read_csv_split(spark, path, d.schema)
