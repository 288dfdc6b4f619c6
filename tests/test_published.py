"""Audited publishing, the one-read report, merged daily state and the
two-key scoring join."""

import collections
import os
import random

import pytest
from pyspark.sql import functions as F

from chorus.operators.lexicon import lexicon_score
from chorus.operators.quality import QualityGateError
from chorus.plans import publish, report, star
from chorus.plans.queries import LEXICON, QUERIES, _star
from chorus.sources import proxies, versions
from chorus.streaming import merged
from conftest import SF001
from test_plans import plan


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _raw(spark):
    raw = proxies.raw_comments(proxies.table(spark, SF001, "documents"))
    events = proxies.monthly_events(*[proxies.table(spark, SF001, t)
                                      for t in ("orders", "customer", "nation")])
    return raw, events, spark.createDataFrame(LEXICON, "term string, valence double")


# ------------------------------------------------------------ publish what was checked
def test_failing_audit_leaves_the_published_tables(spark, tmp_dir):
    raw, events, lex = _raw(spark)
    root = f"{tmp_dir}/star"
    v1 = publish.publish_star(spark, raw, events, lex, root)
    good = _rows(versions.open_table(spark, root, "fact_assault"))
    assert v1.number == 1 and v1.n_rows["fact_assault"] == len(good)

    def spoil(tables):
        bad = tables["fact_assault"].withColumn("events", F.lit(-1))
        return {**tables, "fact_assault": bad}
    with pytest.raises(QualityGateError, match="events"):
        publish.publish_star(spark, raw, events, lex, root, alter=spoil)
    assert versions.version_numbers(spark, root) == [1]
    assert _rows(versions.open_table(spark, root, "fact_assault")) == good
    # The failed run's files are there until the next clean-up.
    assert len(versions.child_names(spark, f"{root}/runs")) == 2
    v2 = publish.publish_star(spark, raw, events, lex, root, keep=1)
    assert v2.number == 2 and versions.version_numbers(spark, root) == [2]
    assert versions.child_names(spark, f"{root}/runs") == [v2.run]
    assert _rows(versions.open_table(spark, root, "fact_assault")) == good


def test_tables_are_built_from_the_stage_alone(spark, tmp_dir):
    raw, events, lex = _raw(spark)
    seen = {}

    def look(tables):
        seen.update({t: df.inputFiles() for t, df in tables.items()})
        return tables
    publish.publish_star(spark, raw, events, lex, f"{tmp_dir}/star", alter=look)
    for table in ("fact_comment", "dim_user", "dim_post"):
        assert seen[table] and all("_cleaned_comments" in f for f in seen[table]), table
    again = versions.open_table(spark, f"{tmp_dir}/star", "fact_comment")
    lazy = star.build_star_schema(spark, raw, events, lex)["fact_comment"]
    assert _rows(again) == _rows(lazy)


def test_a_version_is_published_once(spark, tmp_dir):
    from pyspark.errors import AnalysisException
    assert versions.read_version(spark, tmp_dir) is None
    with pytest.raises(FileNotFoundError):
        versions.open_table(spark, tmp_dir, "t")
    versions.publish(spark, tmp_dir, 1, "r1", {"t": "/x"}, {"t": 3})
    with pytest.raises(AnalysisException):
        versions.publish(spark, tmp_dir, 1, "r2", {"t": "/y"}, {})
    assert versions.read_version(spark, tmp_dir).paths == {"t": "/x"}
    # A manifest without its commit mark is not a version.
    os.makedirs(f"{tmp_dir}/manifest/version=2")
    assert versions.version_numbers(spark, tmp_dir) == [1]


# ---------------------------------------------------------------------- one-read report
def test_report_reads_the_text_once_besides_the_vocabulary(spark, monkeypatch):
    made = []
    cut = report.cut_lineage
    monkeypatch.setattr(report, "cut_lineage", lambda df: made.append(plan(df)) or cut(df))
    out = QUERIES["report_summary"](spark, SF001)

    def text_scans(p):
        return sum("text" in line for line in p.splitlines() if line.startswith("ReadSchema"))
    # The flag frame is the one staged plan that scans the table ...
    assert [text_scans(p) for p in made] == [1, 0, 0]
    # ... and the outputs scan it for the vocabulary only.
    assert text_scans(plan(out)) == 1


def test_report_without_cohorts_or_periods(spark):
    c = spark.createDataFrame([(1, "a", "x aa", 0.5, "2024-01-02"), (2, "a", None, 1.0, "2024-01-02"),
                               (3, None, "y bb", -0.5, "2024-01-03")],
                              "comment_id long, author_name string, self_text string, "
                              "score double, created_date string")
    p = report.ReportParams(side_a=["aa"], side_b=["bb"])
    rep = report.analysis_report(c, p)
    assert not {"label_counts", "period_test"} & set(rep)
    assert [(r.author_name, r.stance) for r in rep["stance"].collect()] == [("a", "Pro A")]
    got = {(r.created_date.isoformat(), r.stance): r.n_comments
           for r in rep["daily_stance"].collect()}
    assert got == {("2024-01-02", "Pro A"): 1, ("2024-01-03", "Neutral"): 1}


# -------------------------------------------------------------------- merged daily state
SCHEMA = ("comment_id long, author_name string, self_text string, score double, "
          "created_date string")
PARAMS = report.ReportParams(side_a=["aa"], side_b=["bb"], topic_a="A", topic_b="B")


def _comments(rng, day, n=60):
    words = ["aa", "bb", "cc"]
    return [(rng.choice([None, *range(10 ** 6)][:50]), rng.choice([None, "u", "v", "w", "x"]),
             rng.choice([None, *[" ".join(rng.sample(words, k)) for k in (1, 1, 2)]]),
             rng.choice([None, -1.0, -0.5, 0.0, 0.25, 1.0]), f"2024-01-{day:02d}")
            for _ in range(n)]


@pytest.mark.parametrize("parts", [32, 1])
def test_daily_loads_equal_one_batch(spark, tmp_dir, monkeypatch, parts):
    monkeypatch.setattr(merged, "MAX_PARTS", parts)
    rng = random.Random(parts)
    days = [_comments(rng, d) for d in (1, 2, 3)]
    for batch, rows in enumerate(days, 1):
        df = spark.createDataFrame(rows, SCHEMA)
        merged.merge_extract(spark, tmp_dir, batch, df, PARAMS)
        before = _rows(merged.read_extracts(spark, tmp_dir)["topic_score"])
        merged.merge_extract(spark, tmp_dir, batch, df, PARAMS)      # replayed
        assert _rows(merged.read_extracts(spark, tmp_dir)["topic_score"]) == before
        whole = spark.createDataFrame(sum(days[:batch], []), SCHEMA)
        want = report.all_extracts(whole, "author_name", "comment_id", "self_text", "score",
                                   "created_date", PARAMS.side_a, PARAMS.side_b,
                                   PARAMS.label_a, PARAMS.label_b, "A", "B")
        got = merged.read_extracts(spark, tmp_dir)
        for name in want:
            assert _rows(got[name]) == _rows(want[name]), (batch, name)
    with pytest.raises(ValueError, match="in order"):
        merged.merge_extract(spark, tmp_dir, 1, df, PARAMS)


def test_an_author_who_changes_sides_takes_old_counts_along(spark, tmp_dir):
    def day(batch, text, score):
        merged.merge_extract(spark, tmp_dir, batch, spark.createDataFrame(
            [(batch, "u", text, score, f"2024-01-0{batch}")], SCHEMA), PARAMS)
        return {(r.created_date.day, r.stance): r.n_comments
                for r in merged.read_extracts(spark, tmp_dir)["daily_stance"].collect()}
    assert day(1, "cc", 1.0) == {(1, "Neutral"): 1}
    assert day(2, "aa", 0.5) == {(1, "Pro A"): 1, (2, "Pro A"): 1}
    assert day(3, "bb", 0.75) == {(1, "Pro B"): 1, (2, "Pro B"): 1, (3, "Pro B"): 1}


def test_merged_dimension_is_the_whole_dimension(spark, tmp_dir):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, 5, 6])) for _ in range(40)]
    for batch in (1, 2, 2, 3):
        part = spark.createDataFrame(rows[batch - 1::3], "k string, hi int, lo int")
        merged.merge_dimension(spark, tmp_dir, batch, part, ["k"], ["hi"], ["lo"])
    want = collections.defaultdict(lambda: ([], []))
    for k, hi, lo in rows:
        want[k][0].append(hi)
        want[k][1].append(lo)
    best = lambda f, xs: f((x for x in xs if x is not None), default=None)
    assert _rows(merged.read_dimension(spark, tmp_dir)) == sorted(
        ((k, best(max, h), best(min, l)) for k, (h, l) in want.items()), key=repr)
    # The one before the newest stays for a replay, older runs go.
    assert versions.version_numbers(spark, tmp_dir) == [2, 3]
    assert len(versions.child_names(spark, f"{tmp_dir}/runs")) == 2


# ----------------------------------------------------------------- two-key scoring join
def test_unread_scores_are_not_computed(spark):
    fact = _star(spark, SF001)["fact_comment"]
    assert "_chunk" in plan(fact)                    # the cut text, when a score is read
    for df in (fact.agg(F.count(F.lit(1))), QUERIES["dq_gate"](spark, SF001)):
        assert "_chunk" not in plan(df)


def test_scores_by_id_and_text(spark):
    lex = spark.createDataFrame([("good", 2.0), ("bad", -1.0)], "term string, valence double")
    rows = [(1, "good"), (1, "bad"), (1, "good"), (None, "good good"), (None, None), (2, None),
            (2, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    value = {"good": 2.0, "bad": -1.0, "good good": 4.0}
    want = sorted(((i, t, round(value.get(t, 0) / (value.get(t, 0) ** 2 + 15) ** 0.5, 4))
                   for i, t in rows), key=repr)
    assert _rows(lexicon_score(df, "id", "t", lex)) == want
    plain = df.filter("id IS NOT NULL")
    assert _rows(lexicon_score(plain, "id", "t", lex, null_ids=False)) == [
        w for w in want if w[0] is not None]
    # One id with many texts is no pairwise join.
    many = spark.range(3000).select(F.lit(7).alias("id"), F.concat(
        F.lit("good "), F.col("id").cast("string")).alias("t"))
    joined = plan(lexicon_score(many, "id", "t", lex))
    keys = [line for line in joined.splitlines() if line.startswith("Left keys [")]
    assert keys and all("_d#" in k or "term" in k for k in keys)
    assert lexicon_score(many, "id", "t", lex).filter("sentiment_score > 0").count() == 3000
