"""Property tests (hypothesis) on small generated inputs."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chorus.functions.labels import score_label
from chorus.functions.text import mentions
from chorus.operators import clean, stats

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_label(x):
    return "Positive" if x > 0.05 else "Negative" if x < -0.05 else "Neutral"


@SETTINGS
@given(st.lists(st.floats(-1, 1, allow_nan=False), min_size=1, max_size=40))
def test_label_rule(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)],
                               "i int, s double")
    got = {r.i: r.l for r in df.select("i", score_label("s").alias("l"))
           .collect()}
    assert got == {i: _py_label(x) for i, x in enumerate(xs)}


@SETTINGS
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_conform_never_raises(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    out = clean.conform(df.select(F.col("v").alias("a"), F.col("v").alias("b"),
                                  F.col("v").alias("c")),
                        {"a": "int", "b": "timestamp_ntz", "c": "double"})
    assert out.count() == len(texts)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("xyz")),
                min_size=1, max_size=40))
def test_dedup_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    once = clean.dedup(df, ["k"], ["v"])
    twice = clean.dedup(once, ["k"], ["v"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert a == sorted((k, min(v for kk, v in rows if kk == k))
                       for k in {k for k, _ in rows})


@SETTINGS
@given(st.lists(st.floats(-100, 100, allow_nan=False), min_size=2,
                max_size=30),
       st.lists(st.floats(-100, 100, allow_nan=False), min_size=2,
                max_size=30))
def test_welch_matches_formula(spark, a, b):
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b],
                               "g string, v double")
    r = stats.welch_ttest(df, "v", F.col("g") == "a", F.col("g") == "b",
                          with_p=False).first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    se2 = va / len(a) + vb / len(b)
    if se2 <= 0:
        assert r.t is None
        return
    t = (np.mean(a) - np.mean(b)) / math.sqrt(se2)
    assert math.isclose(r.t, t, rel_tol=1e-6, abs_tol=1e-6)


@SETTINGS
@given(st.lists(st.text(alphabet="abcAB é.", max_size=10), min_size=1,
                max_size=30),
       st.text(alphabet="abAB", min_size=1, max_size=3))
def test_substring_mentions(spark, texts, kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                               "i int, t string")
    got = {r.i: r.m for r in df.select("i", mentions("t", [kw]).alias("m"))
           .collect()}
    assert got == {i: kw.lower() in t.lower() for i, t in enumerate(texts)}


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["u1", "u2", "u3", None]),
    st.sampled_from(["alpha", "beta", "alpha beta", "gamma"]),
    st.one_of(st.none(), st.sampled_from([-0.5, -0.2, 0.0, 0.2, 0.5])),
    st.sampled_from([1, 2, None])), min_size=1, max_size=25))
def test_fused_counts_equal_two_step(spark, rows):
    import datetime as dt
    from chorus.plans import report
    from chorus.operators.stance import author_stance_onepass
    data = [(i, a, t, s, None if d is None else dt.date(2024, 1, d))
            for i, (a, t, s, d) in enumerate(rows)]
    c = spark.createDataFrame(data, "comment_id long, author_name string, "
                                    "self_text string, score double, "
                                    "created_date date")
    stance = author_stance_onepass(c, "author_name", "self_text", "score",
                                   ["alpha"], ["beta"], "Pro A", "Pro B")
    for name in report.EXTRACT_KEYS:
        args = (c, name, "author_name", "comment_id", "self_text", "score",
                "created_date", ["alpha"], ["beta"], "Pro A", "Pro B")
        fused = report.extract(*args, share="none")
        two = report.extract(*args, stance=stance)
        cols = report.EXTRACT_KEYS[name] + ["n_comments"]
        assert sorted(map(tuple, fused.select(*cols).collect()),
                      key=repr) == \
            sorted(map(tuple, two.select(*cols).collect()), key=repr), name
