"""Quality gate (P5): five suites over the star tables, run between the
build and the load; each suite is one aggregation over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.operators.quality import (assert_passed, between,
                                      datetime_format, in_set, not_null,
                                      of_type, run_suites, type_in_list)

# The datetime text format the suites expect, and the five
# suites (name -> table, checks) with their thirty checks in their order.
DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"

SUITES = {
    "expectation-dim-post": ("dim_post", [
        not_null("post_id"), of_type("post_score", "int"),
        not_null("post_title"),
        type_in_list("post_upvote_ratio", ["float", "int"]),
        of_type("post_thumbs_ups", "int"),
        of_type("post_total_awards_received", "int"),
        of_type("post_created_time", "datetime")]),
    "expectation-dim-user": ("dim_user", [
        not_null("author_name"), in_set("user_is_verified", [True, False]),
        datetime_format("user_account_created_time", DATETIME_FORMAT),
        not_null("user_awardee_karma"), not_null("user_awarder_karma"),
        not_null("user_link_karma"), not_null("user_comment_karma"),
        not_null("user_total_karma")]),
    "expectation-fact-comment": ("fact_comment", [
        not_null("comment_id"), not_null("self_text"), not_null("subreddit"),
        not_null("created_time"),
        datetime_format("created_time", DATETIME_FORMAT),
        not_null("author_name"), not_null("post_id")]),
    "expectation-dim-date": ("dim_date", [
        not_null("month_year"), not_null("month"), not_null("year"),
        not_null("date"), datetime_format("date", DATETIME_FORMAT)]),
    "expectation-fact-assault": ("fact_assault", [
        not_null("country"), between("events", 0, None),
        between("fatalities", 0, None)]),
}


FORMAT_CHECK = datetime_format("date", DATETIME_FORMAT).name

# Checks that report but do not stop a run: a typed date has no text format
# to match, so this one fails on every correct table.
ADVISORY = frozenset({("expectation-dim-date", "date")})


def spared(advisory=ADVISORY):
    """Condition: a format check whose (suite, column) is in ``advisory``."""
    out = F.lit(False)
    for suite, column in sorted(advisory):
        out = out | ((F.col("suite") == suite) & (F.col("column") == column)
                     & (F.col("expectation") == FORMAT_CHECK))
    return out


def quality_gate(tables: dict[str, DataFrame], fail_fast: bool = False,
                 advisory=ADVISORY) -> DataFrame:
    """All results; with ``fail_fast`` a failing check raises, unless its
    (suite, column) is in ``advisory`` and it is a format check."""
    results = run_suites(tables, SUITES)
    if fail_fast:
        assert_passed(results.filter(~spared(advisory)))
    return results
