"""Author stance from two exclusive keyword cohorts.

An author's side score is the mean score of their comments that mention
that side's keywords and not the other side's.  Authors with at least one
one-sided comment are classified: 'B' when score_b > score_a, else 'A' (a
tie goes to A, a missing side counts as 0).  Authors with no one-sided
comment are not in the stance table and read as neutral downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.functions.labels import NEUTRAL, topic_tag
from chorus.functions.text import mentions
from chorus.operators.clean import drop_all_null
from chorus.operators.joins import enrich_left, outer_means, spine_left


def side_conditions(text, kw_a, kw_b, mode: str = "substring",
                    case_sensitive: bool = False) -> tuple[Column, Column]:
    a = mentions(text, kw_a, mode, case_sensitive)
    b = mentions(text, kw_b, mode, case_sensitive)
    return a & ~b, b & ~a


# Side sums are accumulated as exact decimals: the stance compares two
# means, and with floating-point sums an exact tie could flip with the order
# in which partial sums meet (a different partitioning, or a re-aggregation
# of partial groups).  Decimal sums are exact in any order; scores and means
# are taken to 18 decimal places.
EXACT = "decimal(38,18)"


def exact_score(score) -> Column:
    """The score as an exact decimal; null and NaN give null.  A score of
    1e20 or more does not fit and raises: it is never dropped."""
    s = F.col(score) if isinstance(score, str) else score
    x = s.try_cast(EXACT)
    value = s.isNotNull() & ~F.isnan(s.cast("double"))
    return F.when(value & x.isNull(), F.raise_error(F.concat(
        F.lit("score out of range for exact sums: "), s.cast("string"))).cast(EXACT)) \
        .otherwise(x)


def exact_mean(total, count) -> Column:
    """Mean from an exact sum and a count; 0 when there is no value."""
    return F.coalesce(F.try_divide(total, count), F.lit(0).cast(EXACT))


def _classify(df: DataFrame, label_a: str, label_b: str) -> DataFrame:
    return df.withColumn(
        "stance",
        F.when(F.col("score_b") > F.col("score_a"), label_b).otherwise(label_a))


def author_stance_onepass(comments: DataFrame, author: str, text: str,
                          score: str, kw_a, kw_b, label_a: str = "Pro A",
                          label_b: str = "Pro B", mode: str = "substring",
                          case_sensitive: bool = False) -> DataFrame:
    """(author, score_a, score_b, stance) in one scan and one aggregation.

    The aggregation is partial per task, so what is shuffled is one buffer
    per (task, author): an author holding a third of all rows costs one
    buffer per task, not one task.
    """
    only_a, only_b = side_conditions(F.col(text), kw_a, kw_b, mode,
                                     case_sensitive)
    s = F.col(score)
    # No filter before the aggregate: Catalyst would push it below the
    # projection and evaluate the text tests twice; here each is computed
    # once per row and rows of neither side only touch the partial buffer.
    flags = comments.select(author, exact_score(s).alias("_x"),
                            only_a.alias("_a"), only_b.alias("_b"))
    return stance_of_flags(flags, author, label_a, label_b)


def stance_of_flags(flags: DataFrame, author: str, label_a: str = "Pro A",
                    label_b: str = "Pro B") -> DataFrame:
    """(author, score_a, score_b, stance) from per-comment rows with the exact
    score ``_x`` and the side flags ``_a`` and ``_b``."""
    x = F.col("_x")
    agg = (flags.filter(F.col(author).isNotNull())
           .groupBy(author)
           .agg(F.sum(F.when(F.col("_a"), x)).alias("_xa"),
                F.count(F.when(F.col("_a"), x)).alias("_na"),
                F.sum(F.when(F.col("_b"), x)).alias("_xb"),
                F.count(F.when(F.col("_b"), x)).alias("_nb"),
                F.max(F.col("_a") | F.col("_b")).alias("_sided")))
    agg = agg.filter(F.col("_sided")).select(
        author, exact_mean("_xa", "_na").alias("_ma"),
        exact_mean("_xb", "_nb").alias("_mb"))
    return agg.select(author, F.col("_ma").cast("double").alias("score_a"),
                      F.col("_mb").cast("double").alias("score_b"),
                      F.when(F.col("_mb") > F.col("_ma"), label_b)
                      .otherwise(label_a).alias("stance"))


def author_stance(comments: DataFrame, author: str, text: str, score: str,
                  kw_a, kw_b, label_a: str = "Pro A", label_b: str = "Pro B",
                  mode: str = "substring",
                  case_sensitive: bool = False) -> DataFrame:
    """The join form: two cohort means, full outer join, fill 0, left join
    from all authors, drop authors with neither side.  Same result as
    :func:`author_stance_onepass`, with two more shuffles; kept because it
    is the composition of the separate operators."""
    only_a, only_b = side_conditions(F.col(text), kw_a, kw_b, mode,
                                     case_sensitive)
    keyed = comments.filter(F.col(author).isNotNull())

    def cohort_mean(cond):
        x = exact_score(score)
        return (keyed.filter(cond).groupBy(author)
                .agg(exact_mean(F.sum(x), F.count(x)).alias("m"),
                     F.count(F.lit(1)).alias("n")))

    both = outer_means(cohort_mean(only_a), cohort_mean(only_b), author,
                       "m", "m", "score_a", "score_b")
    both = both.withColumns({c: F.coalesce(c, F.lit(0).cast(EXACT))
                             for c in ("score_a", "score_b")})
    spine = spine_left(comments, author, both)
    spine = drop_all_null(spine, ["score_a", "score_b"])
    return _classify(spine, label_a, label_b).withColumns(
        {c: F.col(c).cast("double") for c in ("score_a", "score_b")})


def stance_counts(stance: DataFrame) -> DataFrame:
    """Authors per stance, most frequent first."""
    from chorus.operators.aggregates import value_counts
    return value_counts(stance, "stance")


def enriched_comments(comments: DataFrame, stance: DataFrame, author: str,
                      text: str, created: str, kw_a, kw_b, topic_a: str,
                      topic_b: str, stance_col: str = "stance",
                      neutral: str = NEUTRAL,
                      topic_case_sensitive: bool = True,
                      salt_buckets: int | None = None,
                      salt_col: str | None = None) -> DataFrame:
    """Every comment with its author's stance ('Neutral' when none), an
    exclusive topic tag and the comment date.  ``salt_buckets`` /
    ``salt_col`` salt the author join (see :func:`enrich_left`)."""
    st = stance.select(author, F.col("stance").alias(stance_col))
    # Topic and date come before the join: when the caller does not select
    # the text, it is not shuffled by author.
    tagged = comments.withColumns({
        "topic": topic_tag(F.col(text), kw_a, kw_b, topic_a, topic_b,
                           neutral=neutral,
                           case_sensitive=topic_case_sensitive),
        "created_date": F.to_date(F.col(created)),
    })
    # Rows without an author match nothing: they pass beside the join, so
    # they are not one hot key.
    named = enrich_left(tagged.filter(F.col(author).isNotNull()), st, author,
                        {stance_col: neutral}, salt_buckets, salt_col)
    rest = tagged.filter(F.col(author).isNull()) \
        .withColumn(stance_col, F.lit(neutral))
    return named.unionByName(rest)
