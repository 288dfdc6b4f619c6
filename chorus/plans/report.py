"""Dashboard extracts: comment counts by stance, topic, label, date, score.

Comments are first aggregated per (author, date[, topic, label, score]) --
a partial aggregate that shrinks the rows before any shuffle and removes
author skew.  That one pass also carries each side's score sums, so the
author stance is re-aggregated from it and joined back without a second
read of the text (:func:`fused_counts`).  The three extracts share nested
keys, so :func:`all_extracts` computes the finest grain once and rolls up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.functions.labels import NEUTRAL, score_label, topic_tag
from chorus.functions.text import mentions, nan_to_null
from chorus.operators.stance import (exact_mean, exact_score, side_conditions,
                                     stance_counts, stance_of_flags)
from chorus.session import cut_lineage

EXTRACT_KEYS = {
    "daily_stance": ["created_date", "stance"],
    "topic_label": ["stance", "topic", "sentiment_label", "created_date"],
    "topic_score": ["stance", "topic", "sentiment_label", "created_date",
                    "sentiment_score"],
}


def stance_counts_by(comments: DataFrame, stance: DataFrame, author: str,
                     id_col: str, keys: Sequence[str],
                     neutral: str = NEUTRAL, count_name: str = "n_comments"
                     ) -> DataFrame:
    """Non-null ``id_col`` counts by ``keys``, where ``keys`` may include
    'stance' (the author's stance, ``neutral`` when unclassified).

    Rows with a null key other than stance form no group.
    """
    row_keys = [k for k in keys if k != "stance"]
    pre = (comments.filter(_not_null(row_keys))
           .groupBy(author, *row_keys)
           .agg(F.count(id_col).alias("_n")))
    st = stance.select(author, "stance")
    joined = (pre.join(st, author, "left")
              .withColumn("stance", F.coalesce("stance", F.lit(neutral))))
    return joined.groupBy(*keys).agg(F.sum("_n").alias(count_name))


def _not_null(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def comment_features(comments: DataFrame, text: str, score: str,
                     created: str, kw_a, kw_b, topic_a: str, topic_b: str,
                     neutral: str = NEUTRAL, score_places: int = 4
                     ) -> DataFrame:
    """Per-comment row keys of the extracts (topic, label, date, score)."""
    return comments.withColumns({
        "topic": topic_tag(F.col(text), kw_a, kw_b, topic_a, topic_b,
                           neutral=neutral),
        "sentiment_label": score_label(F.col(score)),
        "created_date": F.to_date(F.col(created)),
        "sentiment_score": F.round(F.col(score), score_places),
    })


def author_counts(flags: DataFrame, author: str, id_col: str,
                  row_keys: Sequence[str]) -> DataFrame:
    """Per (author, row keys): the comments (``_rows``), those with an id
    (``_n``), and of each side the exact score sum and count, from rows with ``_x``, ``_a``, ``_b``.
    Sums and counts of parts add up to those of the whole."""
    x = F.col("_x")
    return (flags.groupBy(author, *row_keys)
            .agg(F.count(F.lit(1)).alias("_rows"), F.count(id_col).alias("_n"),
                 F.sum(F.when(F.col("_a"), x)).alias("_sa"),
                 F.count(F.when(F.col("_a"), x)).alias("_ca"),
                 F.sum(F.when(F.col("_b"), x)).alias("_sb"),
                 F.count(F.when(F.col("_b"), x)).alias("_cb"),
                 F.max(F.col("_a") | F.col("_b")).alias("_sided")))


def fused_counts(feats: DataFrame, author: str, id_col: str, text: str,
                 score: str, keys: Sequence[str], kw_a, kw_b, label_a: str,
                 label_b: str, mode: str = "substring",
                 case_sensitive: bool = False, neutral: str = NEUTRAL,
                 count_name: str = "n_comments",
                 share: str = "checkpoint") -> DataFrame:
    """Counts by ``keys`` with the author stance derived in the same pass.

    One aggregate per (author, row keys) -- partial per task, so a hot
    author is pre-combined before the shuffle -- carries the comment count
    and, per side, the sum and count of one-sided scores.  The stance comes
    from re-aggregating that small table by author, and the counts join it
    back.  ``share='checkpoint'`` materialises the pre-aggregate once (one
    action) so the text is read and tested once; ``share='none'`` keeps the
    plan lazy and lets each consumer recompute it.
    """
    only_a, only_b = side_conditions(F.col(text), kw_a, kw_b, mode,
                                     case_sensitive)
    row_keys = [k for k in keys if k != "stance"]
    pre = author_counts(
        feats.select(author, *row_keys, id_col, exact_score(F.col(score)).alias("_x"),
                     only_a.alias("_a"), only_b.alias("_b")), author, id_col, row_keys)
    if share == "checkpoint":
        # Spark does not share a subplan between two consumers once column
        # pruning has shaped each copy differently; materialising the small
        # pre-aggregate (reliably, in the shared folder) makes the text scan
        # happen exactly once.
        pre = cut_lineage(pre)
    # Exact (decimal) side sums: re-aggregating partial groups cannot
    # change the comparison of two means (see stance.exact_mean).
    stance = (pre.filter(F.col(author).isNotNull()).groupBy(author)
              .agg(exact_mean(F.sum("_sa"), F.sum("_ca")).alias("score_a"),
                   exact_mean(F.sum("_sb"), F.sum("_cb")).alias("score_b"),
                   F.max("_sided").alias("_sided"))
              .filter(F.col("_sided"))
              .select(author, F.when(F.col("score_b") > F.col("score_a"),
                                     label_b).otherwise(label_a)
                      .alias("stance")))
    counted = (pre.filter(_not_null(row_keys)).select(author, *row_keys, "_n")
               .join(stance, author, "left")
               .withColumn("stance", F.coalesce("stance", F.lit(neutral))))
    return counted.groupBy(*keys).agg(F.sum("_n").alias(count_name))


def extract(comments: DataFrame, name: str, author: str, id_col: str,
            text: str, score: str, created: str, kw_a, kw_b,
            label_a: str, label_b: str, topic_a: str | None = None,
            topic_b: str | None = None, stance: DataFrame | None = None,
            mode: str = "substring", case_sensitive: bool = False,
            drop_null_text: bool = True, share: str = "checkpoint"
            ) -> DataFrame:
    """One of the three dashboard extracts (see ``EXTRACT_KEYS``).

    Comments without text are left out first (``drop_null_text``), as the
    analysis does before it scores and groups.  Without a given ``stance``
    table the stance is derived in the same pass (:func:`fused_counts`).
    """
    if drop_null_text:
        comments = comments.filter(F.col(text).isNotNull())
    feats = comment_features(comments, text, score, created, kw_a, kw_b,
                             topic_a or "A", topic_b or "B")
    if stance is not None:
        return stance_counts_by(feats, stance, author, id_col,
                                EXTRACT_KEYS[name])
    return fused_counts(feats, author, id_col, text, score,
                        EXTRACT_KEYS[name], kw_a, kw_b, label_a, label_b,
                        mode, case_sensitive, share=share)


def all_extracts(comments: DataFrame, author: str, id_col: str, text: str,
                 score: str, created: str, kw_a, kw_b, label_a: str,
                 label_b: str, topic_a: str, topic_b: str,
                 stance: DataFrame | None = None
                 ) -> dict[str, DataFrame]:
    """All three extracts from one finest grain: the 5-key counts are
    checkpointed once (one action; lineage cut in the shared folder) and
    the coarser extracts are rolled up from them."""
    comments = comments.filter(F.col(text).isNotNull())
    feats = comment_features(comments, text, score, created, kw_a, kw_b,
                             topic_a, topic_b)
    keys = EXTRACT_KEYS["topic_score"]
    finest = (stance_counts_by(feats, stance, author, id_col, keys)
              if stance is not None else
              fused_counts(feats, author, id_col, text, score, keys, kw_a,
                           kw_b, label_a, label_b))
    return roll_up(cut_lineage(finest))


def roll_up(finest: DataFrame) -> dict[str, DataFrame]:
    """The three extracts from the finest one."""
    out = {"topic_score": finest}
    for name in ("topic_label", "daily_stance"):
        out[name] = (finest.groupBy(*EXTRACT_KEYS[name])
                     .agg(F.sum("n_comments").alias("n_comments")))
    return out


# ---------------------------------------------------------------- P4
@dataclass(frozen=True)
class ReportParams:
    """Column names and keyword parameters of the analysis report."""
    id_col: str = "comment_id"
    author: str = "author_name"
    text: str = "self_text"
    score: str = "score"
    created: str = "created_date"
    cohort_keywords: Sequence[str] = ()          # label counts for a topic
    cohort_groups: Sequence[Sequence[str]] = ()  # all groups must match
    side_a: Sequence[str] = ()
    side_b: Sequence[str] = ()
    label_a: str = "Pro A"
    label_b: str = "Pro B"
    topic_a: str = "A"
    topic_b: str = "B"
    periods: Sequence[tuple[int, int]] = ()      # two (year, month) pairs
    top_k: int = 20
    stop_words: Sequence[str] | None = None
    mode: str = "substring"


def report_flags(comments: DataFrame, p: ReportParams) -> DataFrame:
    """All that the report needs of a comment, without its text: one narrow
    row per comment with text, staged.  The only read of the text besides the
    vocabulary's: every keyword test is made here."""
    from chorus.operators.filters import period_condition

    c = comments.filter(F.col(p.text).isNotNull())
    t, no = F.col(p.text), F.lit(False)
    only_a, only_b = side_conditions(t, p.side_a, p.side_b, p.mode)
    every = F.lit(bool(p.cohort_groups))
    for group in p.cohort_groups:
        every = every & mentions(t, group, p.mode)
    period = F.lit(None).cast("string")
    for y, m in p.periods:
        period = F.when(period_condition(c, p.created, y, m),
                        f"{y}-{m:02d}").otherwise(period)
    flags = c.withColumns({
        "_x": exact_score(F.col(p.score)), "_v": nan_to_null(F.col(p.score).cast("double")),
        "_a": only_a, "_b": only_b, "_period": period, "_groups": every,
        "_cohort": mentions(t, p.cohort_keywords, p.mode) if p.cohort_keywords else no})
    flags = comment_features(flags, p.text, p.score, p.created, p.side_a, p.side_b,
                             p.topic_a, p.topic_b)
    return cut_lineage(flags.select(
        p.author, p.id_col, "topic", "sentiment_label", "created_date", "sentiment_score",
        "_x", "_v", "_a", "_b", "_period", "_groups", "_cohort"))


def tagged_moments(flags: DataFrame) -> DataFrame:
    """(output, key1, key2, rows, n, mean, var): each flag row is tagged with
    the outputs it counts in (none to six), and one aggregation over the tags
    feeds them all."""
    label, period = F.col("sentiment_label"), F.col("_period")

    def tag(cond, output, key1, key2=None):
        return F.when(cond, F.struct(F.lit(output).alias("output"), key1.alias("key1"),
                                     F.lit(key2).cast("string").alias("key2")))
    named = label.isNotNull()
    inside = period.isNotNull()
    tags = F.array_compact(F.array(
        tag(F.col("_cohort") & named, "label_counts", label),
        tag(F.col("_groups") & named, "group_label_counts", label),
        tag(inside, "period", period, "all"),
        tag(inside & F.col("_a"), "period", period, "A"),
        tag(inside & F.col("_b"), "period", period, "B")))
    return (flags.select("_v", F.explode(tags).alias("_tag")).select("_v", "_tag.*")
            .groupBy("output", "key1", "key2")
            .agg(F.count(F.lit(1)).alias("rows"), F.count("_v").alias("n"),
                 F.avg("_v").alias("mean"), F.var_samp("_v").alias("var")))


def _label_table(moments: DataFrame, output: str) -> DataFrame:
    counts = (moments.filter(F.col("output") == output)
              .select(F.col("key1").alias("sentiment_label"), F.col("rows").alias("count")))
    total = counts.select(F.sum("count")).scalar()
    return counts.withColumn("total", total).orderBy(F.desc("count"), "sentiment_label")


def _period_tables(moments: DataFrame, p: ReportParams) -> tuple[DataFrame, DataFrame]:
    """Welch test and side x period means from the tagged moments."""
    from chorus.operators import stats

    names = [f"{y}-{m:02d}" for y, m in p.periods]
    cells = moments.sparkSession.createDataFrame(
        [(n, c) for n in names for c in ("all", "A", "B")], "period string, cohort string")
    found = moments.filter("output = 'period'").select(
        F.col("key1").alias("period"), F.col("key2").alias("cohort"), "mean", "n", "var")
    means = (cells.join(found, ["period", "cohort"], "left")
             .select("period", "cohort", "mean", F.coalesce("n", F.lit(0)).alias("n"), "var"))

    def of(side, col):
        return F.max(F.when((F.col("period") == names[side]) & (F.col("cohort") == "all"),
                            F.col(col)))
    both = means.agg(*[of(i, c).alias(f"{c}_{s}") for i, s in ((0, "a"), (1, "b"))
                       for c in ("n", "mean", "var")])
    test = stats.welch_from_moments(both).withColumn("p", stats.t_pvalue("t", "df"))
    return test, means.drop("var")


def analysis_report(comments: DataFrame, p: ReportParams
                    ) -> dict[str, DataFrame]:
    """The analysis notebook as Spark outputs, from one read of the comments.

    label_counts / group_label_counts: label distribution of a keyword
    cohort and of a keyword-group cohort, with totals; period_test: Welch
    test between the two periods; period_means: side x period means;
    stance / stance_counts: author stance; top_terms: vocabulary (a read of
    its own); daily_stance, topic_label, topic_score: the dashboard extracts.
    Null texts are left out first, as the notebook does.

    Actions while the plan is built: the staged flag frame
    (:func:`report_flags`), and from it the tagged moments and the finest
    extract; the outputs are lazy plans over these three.
    """
    from chorus.operators import terms

    flags = report_flags(comments, p)
    moments = cut_lineage(tagged_moments(flags))
    out: dict[str, DataFrame] = {}
    if p.cohort_keywords:
        out["label_counts"] = _label_table(moments, "label_counts")
    if p.cohort_groups:
        out["group_label_counts"] = _label_table(moments, "group_label_counts")
    if len(p.periods) == 2:
        out["period_test"], out["period_means"] = _period_tables(moments, p)
    stance = stance_of_flags(flags, p.author, p.label_a, p.label_b)
    out["stance"] = stance
    out["stance_counts"] = stance_counts(stance)
    out["top_terms"] = terms.top_terms(comments, p.text, p.top_k, p.stop_words)
    out.update(roll_up(cut_lineage(stance_counts_by(
        flags, stance, p.author, p.id_col, EXTRACT_KEYS["topic_score"]))))
    return out


def report_summary(comments: DataFrame, p: ReportParams) -> DataFrame:
    """The whole report as one table: output, up to four keys, n, value.

    label tables: label, count, total; period_test: statistic, value;
    period_means: period, cohort, n, mean; stance: author, stance, side, the
    side's mean; stance_counts; top_terms; the extracts with their keys (the
    score of topic_score is its value)."""
    rep = analysis_report(comments, p)

    def rows(name, keys, n=None, value=None, src=None):
        text = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string")
                for k in keys] + [F.lit(None).cast("string")] * (4 - len(keys))
        return (rep[name] if src is None else src).select(
            F.lit(name).alias("output"), *[c.alias(f"key{i + 1}") for i, c in enumerate(text)],
            (F.lit(None) if n is None else F.col(n)).cast("bigint").alias("n"),
            (F.lit(None) if value is None else F.col(value)).cast("double").alias("value"))
    parts = [rows(k, ["sentiment_label"], "count", "total")
             for k in ("label_counts", "group_label_counts") if k in rep]
    if "period_test" in rep:
        t = rep["period_test"]
        long = t.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))
            for c in t.columns])).alias("s")).select("s.*")
        parts += [rows("period_test", ["k"], None, "v", long),
                  rows("period_means", ["period", "cohort"], "n", "mean")]
    sides = rep["stance"].select(p.author, "stance", F.explode(F.array(
        F.struct(F.lit("A").alias("side"), F.col("score_a").alias("mean")),
        F.struct(F.lit("B").alias("side"), F.col("score_b").alias("mean")))).alias("s")) \
        .select(p.author, "stance", "s.*")
    parts += [rows("stance", [p.author, "stance", "side"], None, "mean", sides),
              rows("stance_counts", ["stance"], "count"),
              rows("top_terms", ["term"], "tf"),
              rows("daily_stance", EXTRACT_KEYS["daily_stance"], "n_comments"),
              rows("topic_label", EXTRACT_KEYS["topic_label"], "n_comments"),
              rows("topic_score", EXTRACT_KEYS["topic_score"][:4], "n_comments",
                   "sentiment_score")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_extracts(report: dict[str, DataFrame], out_dir: str,
                   mode: str = "overwrite") -> dict[str, str]:
    """Write the three dashboard extracts as CSV folders with headers,
    rows in key order as a grouped table lists them (the sort is a range
    shuffle of the grouped rows only, done here and not in the extracts)."""
    from chorus.sources.files import write_extract
    paths = {}
    for name, keys in EXTRACT_KEYS.items():
        paths[name] = f"{out_dir}/{name}"
        write_extract(report[name].orderBy(*keys), paths[name], mode)
    return paths
