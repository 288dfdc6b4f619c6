"""Repeated ids, NaN, dirty text, null keys and extreme numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chorus.functions.labels import score_label
from chorus.operators import quality, stance, stats
from chorus.operators.lexicon import Rules, lexicon_score, lexicon_scores
from chorus.sources import sampling


def _norm(s):
    return round(s / math.sqrt(s * s + 15), 4)


def test_every_row_is_scored_by_its_own_text(spark):
    lex = spark.createDataFrame([("good", 1.9), ("Bad", -2.0), ("bad", -2.0)],
                                "term string, valence double")
    rows = [(1, "good"), (1, "good"), (1, "good"), (2, "good"), (2, "bad"),
            (3, "nothing"), (3, None), (4, "good bad")]
    df = spark.createDataFrame(rows, "id long, text string")
    own = {"good": _norm(1.9), "bad": _norm(-2.0), "nothing": 0.0, None: 0.0,
           "good bad": _norm(-0.1)}
    wide = lexicon_score(df, "id", "text", lex)
    assert wide.columns == ["id", "text", "sentiment_score"]
    want = sorted((i, str(t), own[t]) for i, t in rows)
    assert sorted((r.id, str(r.text), r.sentiment_score) for r in wide.collect()) == want
    got = lexicon_scores(df, "id", "text", lex).collect()
    assert sorted(map(tuple, got)) == sorted((i, own[t]) for i, t in rows)


def test_rules_walk_back_one_token_at_a_time(spark):
    from chorus.operators.lexicon import B_INCR, Rules
    lex = spark.createDataFrame([("good", 1.9), ("no", -1.2)], "term string, valence double")
    rules = Rules(negators=["not", "no"], boosters={"very": B_INCR})
    texts = {"very not good": (1.9 * -0.74) - 0.293 * 0.95,
             "not very good": (1.9 + 0.293) * -0.74,
             "no good": -1.2 + 1.9}           # a lexicon word does not negate
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r.id: r.sentiment_score for r in lexicon_scores(df, "id", "text", lex, rules=rules).collect()}
    assert [got[i] for i in range(3)] == [_norm(v) for v in texts.values()]


def test_nan_label_is_neutral(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.2,), (-0.2,)], "s double")
    for kind in ("double", "float"):
        assert [r[0] for r in df.select(score_label("s", score_type=kind)).collect()] \
            == ["Neutral", "Neutral", "Positive", "Negative"]


def test_null_keys_are_sampled(spark):
    df = spark.createDataFrame([(None,)] * 100 + [(i,) for i in range(50)], "k long")
    assert sampling.hash_sample(df, "k", 1.0).count() == 150


def test_both_stance_forms_agree_on_ties_and_nan(spark):
    rows = [("x", "aa", 0.2), ("x", "bb", 0.1), ("x", "bb", 0.2), ("x", "bb", 0.3),
            ("y", "aa", float("nan")), ("y", "bb", 0.5), ("z", "bb", None)]
    df = spark.createDataFrame(rows, "author string, text string, score double")
    forms = [sorted(map(tuple, f(df, "author", "text", "score", ["aa"], ["bb"]).collect()))
             for f in (stance.author_stance, stance.author_stance_onepass)]
    assert forms[0] == forms[1]
    assert forms[0][0] == ("x", 0.2, 0.2, "Pro A")


def test_scores_beyond_the_exact_range_raise(spark):
    df = spark.createDataFrame([("x", "aa", 1e21)], "author string, text string, score double")
    with pytest.raises(Exception, match="out of range"):
        stance.author_stance_onepass(df, "author", "text", "score", ["aa"], ["bb"]).collect()


def test_dirty_text_counts_as_unexpected(spark):
    df = spark.createDataFrame([("5",), ("abc",), ("-1",), (None,)], "v string")
    suite = [quality.between("v", 0, 10), quality.in_set("v", [True, False]),
             quality.of_type("v", "bigint")]
    got = [r.unexpected_count for r in quality.run_suite(df, "s", suite).collect()]
    assert got == [2, 3, 1]
    with pytest.raises(ValueError, match="unknown type"):
        quality.run_suite(df, "s", [quality.of_type("v", "no such")]).collect()


def test_p_values_at_small_and_large_df():
    for df in (1e6, 1e8, 1e10, 1e12, 1e14):
        # Normal limit with the first correction term in 1 / df.
        z = 2.0
        density = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        want = math.erfc(z / math.sqrt(2)) + density * (z ** 3 + z) / (2 * df)
        assert stats.t_two_sided_p(z, df) == pytest.approx(want, abs=1e-9)
    assert stats.t_two_sided_p(1.0, 1.0) == pytest.approx(0.5, abs=1e-13)      # Cauchy
    for t in (0.1, 1.0, 3.0, 50.0):                                            # closed form
        assert stats.t_two_sided_p(t, 2.0) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
        assert stats.t_two_sided_p(t, 1.0) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-12)
    assert stats.t_two_sided_p(1e9, 5.0) < 1e-30 and stats.t_two_sided_p(60.0, 1e9) == 0.0


def test_author_join_keeps_nulls_and_text_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(1, "a", "x aa"), (2, None, "y"), (3, "b", "bb")]
        df = spark.createDataFrame(rows, "id long, author string, text string") \
            .withColumn("created", F.lit("2024-01-02"))
        st = spark.createDataFrame([("a", "Pro A")], "author string, stance string")
        out = stance.enriched_comments(df, st, "author", "text", "created",
                                       ["aa"], ["bb"], "A", "B")
        assert {r.id: (r.stance, r.topic) for r in out.collect()} == {
            1: ("Pro A", "A"), 2: ("Neutral", "Neutral"), 3: ("Neutral", "B")}
        plan = out.select("id", "stance", "topic")._jdf.queryExecution().executedPlan().toString()
        joined = plan.split("Join")[1].split("Exchange hashpartitioning(author")[1].splitlines()[:2]
        assert "text" not in joined[1].split("AS topic")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scoring_keeps_contractions_and_symbol_tokens(spark):
    from chorus.functions.text import scoring_tokens
    from test_bruteforce import _chunks
    lex = spark.createDataFrame([(":)", 2.0), ("Great", 3.0), ("good", 1.9), ("good", 1.9)],
                                "term string, valence double")
    df = spark.createDataFrame([(1, "nice :)"), (2, "Great!"), (3, "isn't good"), (4, "(good)")],
                               "id long, text string")
    got = {r.id: r.sentiment_score for r in lexicon_scores(
        df, "id", "text", lex, rules=Rules(negators=["isn't"])).collect()}
    assert got == {k: round(s / (s * s + 15) ** 0.5, 4)
                   for k, s in {1: 2.0, 2: 3.0, 3: 1.9 * -0.74, 4: 1.9}.items()}
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab'!?\"()é𝒳 \n\t_:-") for _ in range(rng.randint(0, 25)))
             for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", scoring_tokens("t").alias("x")).collect()
    assert all(r.x == _chunks(r.t.lower()) for r in rows)


def test_broadcast_needs_few_rows_and_few_bytes(spark, monkeypatch):
    from chorus.operators import joins
    df = spark.createDataFrame([("x" * 500,)] * 5, "term string")

    def hinted(d):
        return "broadcast" in d._jdf.queryExecution().logical().toString().lower()

    assert hinted(joins.small_side(df, 5)) and not hinted(joins.small_side(df, 4))
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 2000)
    assert not hinted(joins.small_side(df, 5))


def test_conform_finds_columns_in_any_case(spark):
    from chorus.operators.clean import conform, conform_report
    df = spark.createDataFrame([("1",), ("x",)], "Id string")
    assert [r[0] for r in conform(df, {"id": "int"}).collect()] == [1, None]
    assert [tuple(r) for r in conform_report(df, {"ID": "int"}).collect()] == [("ID", 1)]


@pytest.mark.parametrize("values", [[], [None], [2.5], [1.0, 2.0], [3.0] * 7 + [None, 9.0],
                                    [float(x * x % 97) / 7 for x in range(500)]])
def test_exact_quantiles_equal_numpy(spark, values):
    import numpy as np
    from chorus.operators import aggregates
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    r = aggregates.numeric_summary(df, "v").collect()
    have = [v for v in values if v is not None]
    assert len(r) == 1 and r[0].n == len(have)
    got = [r[0].q25, r[0].q50, r[0].q75, r[0].min, r[0].max]
    if have:
        assert got == pytest.approx([*np.quantile(have, [0.25, 0.5, 0.75]), min(have), max(have)])
    else:
        assert got == [None] * 5
