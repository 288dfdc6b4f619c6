"""Equivalences and properties on the sf0.01 test tables."""

from pyspark.sql import functions as F

from chorus.operators import aggregates as agg
from chorus.operators import stance as st
from chorus.plans import report
from chorus.plans.queries import (LABEL_A, LABEL_B, QUERIES, SIDE_A, SIDE_B,
                                  TOPIC_A, TOPIC_B)
from chorus.sources import proxies, sampling
from conftest import SF01


def _c(spark):
    return proxies.comments(proxies.table(spark, SF01, "documents"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_onepass_equals_join_form(spark):
    c = _c(spark)
    args = ("author_name", "self_text", "score", SIDE_A, SIDE_B, LABEL_A,
            LABEL_B)
    a = st.author_stance_onepass(c, *args).select(
        "author_name", F.round("score_a", 9), F.round("score_b", 9), "stance")
    b = st.author_stance(c, *args).select(
        "author_name", F.round("score_a", 9), F.round("score_b", 9), "stance")
    assert _rows(a) == _rows(b)
    counts = {r.stance: r["count"] for r in st.stance_counts(
        st.author_stance_onepass(c, *args)).collect()}
    assert counts == {"Pro A": 47, "Pro B": 50}   # FIXTURES 3


def test_extract_one_is_rollup_of_extract_two(spark):
    e1 = QUERIES["extract_daily_stance"](spark, SF01)
    e2 = QUERIES["extract_topic_label"](spark, SF01)
    roll = e2.groupBy("created_date", "stance").agg(
        F.sum("n_comments").alias("n_comments"))
    assert _rows(e1.select("created_date", "stance", "n_comments")) == \
        _rows(roll.select("created_date", "stance", "n_comments"))
    assert e1.count() == 757 and \
        e1.filter(F.col("stance") == "Neutral").count() == 277


def test_all_extracts_from_one_grain(spark):
    out = report.all_extracts(_c(spark), "author_name", "comment_id",
                              "self_text", "score", "created_date", SIDE_A,
                              SIDE_B, LABEL_A, LABEL_B, TOPIC_A, TOPIC_B)
    for name in ("daily_stance", "topic_label", "topic_score"):
        direct = report.extract(_c(spark), name, "author_name", "comment_id",
                                "self_text", "score", "created_date", SIDE_A,
                                SIDE_B, LABEL_A, LABEL_B, TOPIC_A, TOPIC_B)
        cols = report.EXTRACT_KEYS[name] + ["n_comments"]
        assert _rows(out[name].select(*cols)) == _rows(direct.select(*cols))


def test_value_counts_total_equals_rows(spark):
    c = _c(spark).withColumn("lab", F.when(F.col("score") > 0, "p")
                             .otherwise("n"))
    t = agg.value_counts_total(c, "lab").collect()
    assert all(r.total == c.count() for r in t)
    assert sum(r["count"] for r in t) == c.count()


def test_filter_then_count_le_count(spark):
    c = _c(spark)
    for q in ("keyword_any", "keyword_all_groups", "exclusive_cohort",
              "keyword_any_word"):
        assert QUERIES[q](spark, SF01).count() <= c.count()
    assert QUERIES["keyword_all_groups"](spark, SF01).count() <= \
        QUERIES["keyword_any"](spark, SF01).count()


def test_stance_partitions_commenting_authors(spark):
    c = _c(spark)
    e = QUERIES["enriched_comments"](spark, SF01)
    per_author = e.filter(F.col("author_name").isNotNull()).groupBy(
        "author_name").agg(F.countDistinct("stance").alias("k"))
    assert per_author.filter(F.col("k") != 1).count() == 0
    assert e.count() == c.count()


def test_hash_sample_independent_of_partitioning(spark):
    d = proxies.table(spark, SF01, "documents").select("doc_id")
    a = sampling.hash_sample(d.repartition(2), "doc_id", 0.1)
    b = sampling.hash_sample(d.repartition(7), "doc_id", 0.1)
    assert _rows(a) == _rows(b)
    assert 50 < a.count() < 150


def test_doc_term_counts_sum_to_top_terms(spark):
    tt = {r.term: r.tf for r in QUERIES["top_terms"](spark, SF01).collect()}
    dt = QUERIES["doc_term_counts"](spark, SF01).groupBy("term").agg(
        F.sum("tf").alias("tf"))
    assert {r.term: r.tf for r in dt.collect()} == tt
    assert len(tt) == 20


def test_analysis_report(spark, tmp_dir):
    from chorus.plans.report import ReportParams, analysis_report, \
        write_extracts
    p = ReportParams(cohort_keywords=["the"], cohort_groups=[["with", "this"],
                                                              ["was"]],
                     side_a=SIDE_A, side_b=SIDE_B, label_a=LABEL_A,
                     label_b=LABEL_B, topic_a=TOPIC_A, topic_b=TOPIC_B,
                     periods=[(2023, 10), (2024, 11)])
    rep = analysis_report(_c(spark), p)
    assert {r.stance: r["count"] for r in rep["stance_counts"].collect()} \
        == {"Pro A": 47, "Pro B": 50}
    lc = rep["label_counts"].collect()
    assert sum(r["count"] for r in lc) == lc[0].total
    t = rep["period_test"].first()
    assert t.n_a > 0 and t.n_b > 0 and 0 <= t.p <= 1
    assert rep["daily_stance"].count() == 757
    assert rep["top_terms"].count() == 20
    paths = write_extracts(rep, f"{tmp_dir}/extracts")
    back = spark.read.option("header", True).csv(paths["daily_stance"])
    assert back.count() == 757


def test_salted_enrichment_equals_plain(spark):
    from chorus.operators import joins
    c = _c(spark)
    s = st.author_stance_onepass(c, "author_name", "self_text", "score",
                                 SIDE_A, SIDE_B).select("author_name",
                                                        "stance")
    plain = joins.enrich_left(c.select("comment_id", "author_name"), s,
                              "author_name", {"stance": "Neutral"})
    salted = joins.enrich_left(c.select("comment_id", "author_name"), s,
                               "author_name", {"stance": "Neutral"},
                               salt_buckets=7, salt_col="comment_id")
    assert _rows(plain.select("comment_id", "author_name", "stance")) == \
        _rows(salted.select("comment_id", "author_name", "stance"))


def test_doc_term_vectors_equal_long_form(spark):
    from chorus.operators import terms
    from chorus.sources import proxies as px
    d = px.table(spark, SF01, "documents")
    vec = terms.doc_term_vectors(d, "doc_id", "text", 20)
    vocab = sorted(r.term for r in terms.top_terms(d, "text", 20).collect())
    got = sorted((r.doc_id, vocab[int(i)], int(v)) for r in vec.collect()
                 for i, v in zip(r.tf.indices, r.tf.values))
    want = sorted((r.doc_id, r.term, r.tf) for r in
                  terms.doc_term_counts(d, "doc_id", "text", 20).collect())
    assert got == want
    assert vec.count() == d.count()
