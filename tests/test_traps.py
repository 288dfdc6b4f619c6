"""Unit tests for the semantic traps on inline rows."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorus.functions.dates import month_name_to_num
from chorus.functions.labels import score_label, topic_tag
from chorus.functions.text import keyword_pattern, mentions, tokens
from chorus.operators import aggregates as agg
from chorus.operators import clean, stats
from chorus.operators import stance as st
from chorus.plans.star import clean_events


def test_concat_ws_skips_null_month(spark):
    # trap 3: unknown month name -> month_year is the year alone
    df = spark.createDataFrame(
        [("Northland", "Janvier", 2016, 1, 0), ("Northland", "March", 2016, 2, 1)],
        "Country string, Month string, Year int, Events int, Fatalities int")
    out = {r.Month: r.month_year for r in clean_events(df).collect()}
    assert out == {"Janvier": "2016", "March": "03-2016"}


def test_month_map_unknown_is_null(spark):
    df = spark.createDataFrame([("May",), ("Mai",), (None,)], "m string")
    got = [r.n for r in df.select(month_name_to_num("m").alias("n")).collect()]
    assert got == ["05", None, None]


def test_float_boundary_labels(spark):
    # trap 4: 0.05 as float32 is 0.0500000007 -> Positive; as double Neutral
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0501,), (None,)],
                               "s double")
    rows = df.select(score_label("s").alias("d"),
                     score_label("s", score_type="float").alias("f")).collect()
    assert [(r.d, r.f) for r in rows] == [
        ("Neutral", "Positive"), ("Neutral", "Negative"),
        ("Positive", "Positive"), ("Neutral", "Neutral")]


def test_labels_monotone_in_score(spark):
    df = spark.range(-200, 201).select((F.col("id") / 1000).alias("s"))
    rank = {"Negative": 0, "Neutral": 1, "Positive": 2}
    rows = df.select("s", score_label("s").alias("l")).orderBy("s").collect()
    ranks = [rank[r.l] for r in rows]
    assert ranks == sorted(ranks)


def test_ansi_bad_text_becomes_null(spark):
    # trap 2: try_* casts instead of CAST_INVALID_INPUT
    df = spark.createDataFrame([("garbage", "x", "1.5"),
                                ("2024-01-02 03:04:05", "7", "2.5")],
                               "ts string, i string, f string")
    out = clean.conform(df, {"ts": "timestamp_ntz", "i": "int", "f": "float"})
    rows = out.collect()
    assert rows[0].ts is None and rows[0].i is None
    assert rows[1].i == 7 and rows[1].ts.year == 2024
    lost = {r.column: r.lost for r in
            clean.conform_report(df, {"ts": "timestamp_ntz", "i": "int"})
            .collect()}
    assert lost == {"ts": 1, "i": 1}


def test_null_group_key_forms_no_group(spark):
    # trap 6
    df = spark.createDataFrame([(None, 2.0), ("a", 1.0), ("a", 3.0)],
                               "k string, v double")
    rows = agg.grouped_mean(df, "k", "v").collect()
    assert [(r.k, r["mean"]) for r in rows] == [("a", 2.0)]
    assert agg.grouped_mean(df, "k", "v", null_keys=True).count() == 2


def test_nan_is_not_averaged(spark):
    # trap 8
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    raw = df.agg(F.avg("v")).first()[0]
    assert math.isnan(raw)
    fixed = clean.nan_to_null(df).agg(F.avg("v")).first()[0]
    assert fixed == 1.0


def _comments(spark, rows):
    return spark.createDataFrame(
        rows, "comment_id long, author_name string, self_text string, "
              "score double, created_date date")


def test_missing_side_counts_as_zero_and_ties_go_to_a(spark):
    # trap 9: A=-0.5 only -> Pro B; A=B=0.2 -> Pro A; B=-0.1 only -> Pro A
    rows = [(1, "u1", "alpha", -0.5, None),
            (2, "u2", "alpha", 0.2, None), (3, "u2", "beta", 0.2, None),
            (4, "u3", "beta", -0.1, None),
            (5, "u4", "alpha beta", 0.9, None),   # both sides: not one-sided
            (6, None, "alpha", 0.7, None)]
    c = _comments(spark, rows)
    for fn in (st.author_stance_onepass, st.author_stance):
        got = {r.author_name: r.stance for r in fn(
            c, "author_name", "self_text", "score", ["alpha"], ["beta"],
            "Pro A", "Pro B").collect()}
        assert got == {"u1": "Pro B", "u2": "Pro A", "u3": "Pro A"}, fn


def test_unclassified_author_is_neutral_in_enrichment(spark):
    # trap 10
    rows = [(1, "u1", "alpha", 0.5, None), (2, "u4", "alpha beta", 0.9, None),
            (3, None, "gamma", 0.1, None)]
    c = _comments(spark, rows)
    s = st.author_stance_onepass(c, "author_name", "self_text", "score",
                                 ["alpha"], ["beta"])
    e = st.enriched_comments(c, s, "author_name", "self_text",
                             "created_date", ["alpha"], ["beta"], "A", "B")
    got = {r.comment_id: r.stance for r in e.collect()}
    assert got == {1: "Pro A", 2: "Neutral", 3: "Neutral"}


@pytest.mark.parametrize("text,substring,word", [
    ("Under the sun", True, False),
    ("the un met", True, True),
    ("U.N.", False, False),
])
def test_mention_modes(spark, text, substring, word):
    # trap 12
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(mentions("t", ["UN"], "substring").alias("s"),
                  mentions("t", ["UN"], "word").alias("w")).first()
    assert (r.s, r.w) == (substring, word)


def test_mentions_null_text_is_false(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(mentions("t", ["a"]).alias("m")).first().m is False


def test_case_sensitive_regex_mode(spark):
    df = spark.createDataFrame([("United Nations",), ("united nations",)],
                               "t string")
    got = [r.m for r in df.select(mentions(
        "t", ["United Nations|PBB"], "regex", case_sensitive=True)
        .alias("m")).collect()]
    assert got == [True, False]
    assert keyword_pattern(["a.b"], "substring") == r"(?iu)(?:a\.b)"


def test_case_folding_is_unicode_aware(spark):
    df = spark.createDataFrame([("C'ÉTÉ beau",), ("l'été",), ("ete",)],
                               "t string")
    rows = df.select(mentions("t", ["été"], "word").alias("w"),
                     mentions("t", ["été"], "regex").alias("r"),
                     mentions("t", ["été"], "substring").alias("s")).collect()
    assert [(r.w, r.r, r.s) for r in rows] == [
        (True, True, True), (True, True, True), (False, False, False)]


def test_topic_tag_exclusive_and_case_sensitive(spark):
    df = spark.createDataFrame([("Northside said",), ("Southside and Northside",),
                                ("southside",), ("Southside",)], "t string")
    got = [r.x for r in df.select(topic_tag(
        F.col("t"), ["Northside"], ["Southside"], "Northside", "Southside")
        .alias("x")).collect()]
    assert got == ["Northside", "Neutral", "Neutral", "Southside"]


def test_tokens(spark):
    df = spark.createDataFrame([("Don't stop été I a we're go go",)],
                               "t string")
    assert df.select(tokens("t").alias("x")).first().x == [
        "don", "stop", "été", "we", "re", "go", "go"]


def test_quartiles_and_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    r = agg.numeric_summary(df, "v").first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 4.75)
    assert r.std == pytest.approx(4.08248290463863, abs=1e-12)
    assert (r.n, r["min"], r["max"]) == (4, 1.0, 10.0)


def test_t_distribution_p_value():
    assert stats.t_two_sided_p(2.0, 10.0) == pytest.approx(0.0733880, abs=1e-7)
    assert stats.t_two_sided_p(0.0, 5.0) == pytest.approx(1.0)
    assert stats.t_two_sided_p(-1.527493, 3969.469) == pytest.approx(
        0.126718, abs=1e-6)


def test_welch_guards(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0)],
                               "g string, v double")
    r = stats.welch_ttest(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    assert r.t is None and r.df is None and r.p is None


def test_welch_known_values(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0]
    b = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b],
                               "g string, v double")
    r = stats.welch_ttest(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    va, vb = 2.5, 14.0
    se2 = va / 5 + vb / 6
    assert r.t == pytest.approx((3.0 - 7.0) / math.sqrt(se2))
    assert r.df == pytest.approx(se2 ** 2 / ((va / 5) ** 2 / 4
                                             + (vb / 6) ** 2 / 5))
    assert 0 < r.p < 0.05


def test_fill_boolean_on_string_column_casts(spark):
    # trap 18
    df = spark.createDataFrame([("true",), (None,), ("no",)], "v string")
    out = clean.fill_nulls(df, {"v": False})
    assert isinstance(out.schema["v"].dataType, T.BooleanType)
    assert [r.v for r in out.collect()] == [True, False, False]


def test_dedup_is_real_and_deterministic(spark):
    # trap 1: dedup actually removes rows; survivor = smallest order key
    df = spark.createDataFrame([(3, "x", "c"), (1, "x", "a"), (2, "y", "b"),
                                (2, "y", "b")], "id int, k string, v string")
    assert clean.dedup(df).count() == 3
    got = sorted((r.k, r.id, r.v) for r in
                 clean.dedup(df, ["k"], ["id"]).collect())
    assert got == [("x", 1, "a"), ("y", 2, "b")]


def test_null_text_scores_zero(spark):
    # trap 17
    from chorus.operators.lexicon import lexicon_score, lexicon_scores
    df = spark.createDataFrame([(1, None), (2, ""), (3, "good good"),
                                (4, "nothing here")], "id long, t string")
    lex = spark.createDataFrame([("good", 2.0)], "term string, valence double")
    s = {r.id: r.sentiment_score for r in
         lexicon_scores(df, "id", "t", lex).collect()}
    assert s[1] == 0.0 and s[2] == 0.0 and s[4] == 0.0
    assert s[3] == round(4 / math.sqrt(16 + 15), 4)
    wide = lexicon_score(df, "id", "t", lex)
    assert wide.columns == ["id", "t", "sentiment_score"]
    assert {r.id: r.sentiment_score for r in wide.collect()} == s


def test_extract_leaves_out_null_text(spark):
    from chorus.plans import report
    import datetime as dt
    d = dt.date(2024, 1, 1)
    c = _comments(spark, [(1, "u1", "alpha", 0.5, d), (2, "u1", None, 0.1, d),
                          (3, "u2", "beta", -0.2, d)])
    out = report.extract(c, "daily_stance", "author_name", "comment_id",
                         "self_text", "score", "created_date", ["alpha"],
                         ["beta"], "Pro A", "Pro B")
    got = sorted((r.stance, r.n_comments) for r in out.collect())
    # u2's only side is B at -0.2 < 0 (missing A counts as 0): Pro A.
    # Comment 2 has no text and is not counted (3 otherwise).
    assert got == [("Pro A", 2)]


def test_count_ignores_null_ids_but_keeps_zero_groups(spark):
    # trap 7
    import datetime as dt
    from chorus.plans import report
    d = dt.date(2024, 1, 1)
    c = _comments(spark, [(None, "u1", "alpha", 0.5, d),
                          (2, "u2", "gamma", 0.1, dt.date(2024, 1, 2)),
                          (None, "u2", "gamma", 0.1, dt.date(2024, 1, 2))])
    out = report.extract(c, "daily_stance", "author_name", "comment_id",
                         "self_text", "score", "created_date", ["alpha"],
                         ["beta"], "Pro A", "Pro B")
    got = sorted((r.created_date.day, r.stance, r.n_comments)
                 for r in out.collect())
    assert got == [(1, "Pro A", 0), (2, "Neutral", 1)]
    assert agg.group_count(c, "author_name", "comment_id").filter(
        "n = 0").count() == 1


def test_month_level_join_uses_distinct_months(spark):
    # trap 19: month_year repeats ~30 times in the daily dimension
    import datetime as dt
    from chorus.operators.calendar import date_dim, distinct_months
    dim = date_dim(spark, dt.date(2016, 1, 1), dt.date(2016, 3, 31))
    months = distinct_months(dim)
    assert dim.select("month_year").distinct().count() == months.count() == 3
    fact = spark.createDataFrame([("02-2016", 5)], "month_year string, n int")
    assert fact.join(dim, "month_year").count() == 29          # fans out
    assert fact.join(months, "month_year").count() == 1


def test_welch_zero_variance_gives_null_not_error(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0),
                                ("b", 2.0)], "g string, v double")
    r = stats.welch_ttest(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    assert (r.n_a, r.n_b, r.var_a, r.var_b) == (2, 2, 0.0, 0.0)
    assert r.t is None and r.df is None and r.p is None


def test_stance_tie_is_exact_under_any_partitioning(spark):
    # Same multiset of scores on both sides: an exact tie, which goes to A.
    # Float sums of 0.1, 0.2, 0.3 differ with order; exact sums do not.
    rows = [(1, "u", "alpha", 0.3, None), (2, "u", "alpha", 0.2, None),
            (3, "u", "alpha", 0.1, None), (4, "u", "beta", 0.1, None),
            (5, "u", "beta", 0.2, None), (6, "u", "beta", 0.3, None)]
    c = _comments(spark, rows)
    for n in (1, 3, 7):
        got = st.author_stance_onepass(c.repartition(n), "author_name",
                                       "self_text", "score", ["alpha"],
                                       ["beta"]).first()
        assert got.stance == "Pro A" and got.score_a == got.score_b
