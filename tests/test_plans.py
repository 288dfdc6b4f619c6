"""Plan checks: broadcast lexicon join, no Python in the ETL
hot path, pushdown of period filters, partial aggregation before shuffles."""

import contextlib
import io
import re

from chorus.plans.queries import QUERIES
from conftest import SF01


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_lexicon_join_is_broadcast(spark):
    p = plan(QUERIES["lexicon_score"](spark, SF01))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p          # no join back to the texts


def test_no_python_in_etl_plan(spark):
    for q in ("fact_comment", "extract_daily_stance", "top_terms",
              "lexicon_score_negated", "dq_suite"):
        p = plan(QUERIES[q](spark, SF01))
        assert "EvalPython" not in p and "PythonUDF" not in p, q


def test_period_filter_pushed_to_scan(spark):
    p = plan(QUERIES["period_filter"](spark, SF01))
    assert "PushedFilters: [IsNotNull(o_orderdate), " \
           "GreaterThanOrEqual(o_orderdate" in p
    assert "LessThan(o_orderdate" in p


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["dim_user"](spark, SF01))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_stance_aggregates_partially_before_shuffle(spark):
    p = plan(QUERIES["author_stance_onepass"](spark, SF01))
    assert "partial_sum" in p and "partial_count" in p
    # the one-pass form has no join at all
    assert "Join" not in p


def test_top_terms_is_bounded_top_k(spark):
    p = plan(QUERIES["top_terms"](spark, SF01))
    assert "TakeOrderedAndProject" in p
    assert "partial_count" in p


def test_dq_suite_is_one_scan(spark):
    p = plan(QUERIES["dq_suite"](spark, SF01))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_bucketed_stage_scores_without_shuffle(spark, tmp_dir):
    from chorus.plans import star
    from chorus.sources import files, proxies
    from chorus.plans.queries import LEXICON
    raw = proxies.raw_comments(proxies.table(spark, SF01, "documents"))
    files.write_bucketed(raw, "raw_comments_bucketed", f"{tmp_dir}/rc",
                         "comment_id", 8)
    staged = spark.table("raw_comments_bucketed")
    lex = spark.createDataFrame(LEXICON, "term string, valence double")
    fact = star.fact_comment(star.clean_comments(staged), lex)
    p = plan(fact)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" in p
    assert "Exchange hashpartitioning" not in p     # co-located by buckets
    assert fact.count() == raw.filter("author_name IS NOT NULL").count()


def test_month_partitioned_fact_prunes(spark, tmp_dir):
    from pyspark.sql import functions as F
    from chorus.plans import star
    from chorus.sources import proxies
    from chorus.plans.queries import LEXICON
    raw = proxies.raw_comments(proxies.table(spark, SF01, "documents"))
    lex = spark.createDataFrame(LEXICON, "term string, valence double")
    fact = star.fact_comment(star.clean_comments(raw), lex)
    paths = star.write_star({"fact_comment": fact}, tmp_dir,
                            partition_facts_by_month=True)
    back = spark.read.parquet(paths["fact_comment"]) \
        .filter(F.col("month_year") == "10-2023")
    p = plan(back)
    assert "PartitionFilters: [isnotnull(month_year" in p
    assert "(month_year" in p and "= 10-2023)" in p
    assert back.count() == fact.filter(F.col("month_year") == "10-2023").count()


def test_explode_never_carries_text(spark):
    """Carrying the text (or per-text expressions) through a token explode
    costs O(tokens x text); every Generate must see only narrow columns."""
    for q in ("lexicon_score", "lexicon_score_negated", "lexicon_score_rules",
              "top_terms", "doc_term_counts", "fact_comment"):
        p = plan(QUERIES[q](spark, SF01))
        # Arguments: <generator>, [carried child columns], outer, [output]
        # (the carried list is left out when nothing is carried)
        blocks = re.findall(r"^\(\d+\) Generate\nInput .*\nArguments: .*?"
                            r"(?:, \[([^\[\]]*)\])?, (?:true|false), "
                            r"\[[^\[\]]*\]$", p, re.M)
        assert blocks, q
        for cols in blocks:
            names = [c.strip().split("#")[0] for c in cols.split(",")]
            assert "text" not in names and "self_text" not in names, (q, cols)
