"""Shared pieces of the DuckDB SQL twins (see :mod:`chorus.plans.queries`).

Each snippet repeats, in SQL, a proxy projection or operator of the Spark
side, so that the twins are written independently of the Spark code path.
"""

from __future__ import annotations

# Proxy projections, repeated from chorus.sources.proxies.
COMMENTS = """comments AS (
  SELECT doc_id AS comment_id,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE source || '-' || CAST(doc_id % 7 AS VARCHAR) END AS author_name,
         text AS self_text,
         CAST(DATE '2023-10-01' + CAST(doc_id % 400 AS INTEGER) AS DATE) AS created_date,
         CAST(n_chars % 201 - 100 AS DOUBLE) / 100 AS score
  FROM documents)"""

# Side flags: A only / B only, case-insensitive substrings "with" / "was".
SIDES = """sides AS (
  SELECT *,
         contains(lower(self_text), 'with') AND NOT contains(lower(self_text), 'was') AS only_a,
         contains(lower(self_text), 'was') AND NOT contains(lower(self_text), 'with') AS only_b
  FROM comments)"""

STANCE = """stance AS (
  SELECT author_name,
         coalesce(avg(CASE WHEN only_a THEN score END), 0.0) AS score_a,
         coalesce(avg(CASE WHEN only_b THEN score END), 0.0) AS score_b,
         CASE WHEN coalesce(avg(CASE WHEN only_b THEN score END), 0.0)
                 > coalesce(avg(CASE WHEN only_a THEN score END), 0.0)
              THEN 'Pro B' ELSE 'Pro A' END AS stance
  FROM sides
  WHERE author_name IS NOT NULL AND (only_a OR only_b)
  GROUP BY author_name)"""

FEATURES = """feats AS (
  SELECT c.*, coalesce(s.stance, 'Neutral') AS stance,
         CASE WHEN contains(self_text, 'was') AND NOT contains(self_text, 'with') THEN 'was'
              WHEN contains(self_text, 'with') AND NOT contains(self_text, 'was') THEN 'with'
              ELSE 'Neutral' END AS topic,
         CASE WHEN score > 0.05 THEN 'Positive' WHEN score < -0.05 THEN 'Negative'
              ELSE 'Neutral' END AS sentiment_label,
         round(score, 4) AS sentiment_score
  FROM comments c LEFT JOIN stance s ON c.author_name = s.author_name)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"




RAW_COMMENTS = """raw_comments AS (
  SELECT doc_id AS comment_id,
         CAST(n_chars % 201 - 100 AS INTEGER) AS score,
         text AS self_text,
         lang AS subreddit,
         CAST(DATE '2023-10-01' + CAST(doc_id % 400 AS INTEGER) AS TIMESTAMP)
           + to_seconds((doc_id * 7919) % 86400) AS created_time,
         CAST(doc_id % 3 = 0 AS FLOAT) AS controversiality,
         CASE WHEN doc_id % 11 = 0 THEN NULL
              ELSE source || '-' || CAST(doc_id % 7 AS VARCHAR) END AS author_name,
         'p' || CAST(doc_id % 53 AS VARCHAR) AS post_id,
         'Post ' || CAST(doc_id % 53 AS VARCHAR) AS post_title,
         CASE WHEN doc_id % 53 % 5 = 0 THEN NULL
              ELSE 'body ' || CAST(doc_id % 53 AS VARCHAR) END AS post_self_text,
         CAST((doc_id % 53) * 3 + doc_id % 4 AS INTEGER) AS post_score,
         CAST(CAST(doc_id % 100 AS DOUBLE) / 100 AS FLOAT) AS post_upvote_ratio,
         CAST((doc_id % 53) * 2 + doc_id % 5 AS INTEGER) AS post_thumbs_ups,
         CAST(doc_id % 6 AS INTEGER) AS post_total_awards_received,
         CAST(DATE '2023-09-01' + CAST(doc_id % 53 AS INTEGER) AS TIMESTAMP)
           + to_hours(doc_id % 24) AS post_created_time,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id % 2 = 0 END AS user_is_verified,
         TIMESTAMP '2015-01-01 00:00:00' + to_days(CAST(doc_id % 1000 AS INTEGER))
           AS user_account_created_time,
         CAST(doc_id % 50 AS INTEGER) AS user_awardee_karma,
         CAST(doc_id % 30 AS INTEGER) AS user_awarder_karma,
         CAST(n_chars % 1000 AS INTEGER) AS user_link_karma,
         CAST(n_chars % 777 AS INTEGER) AS user_comment_karma,
         CAST(n_chars % 1777 AS INTEGER) AS user_total_karma
  FROM documents)"""

MONTHLY_EVENTS = """monthly_events AS (
  SELECT n.n_name AS Country, strftime(o.o_orderdate, '%B') AS Month,
         CAST(year(o.o_orderdate) AS INTEGER) AS Year,
         CAST(count(o.o_orderkey) AS INTEGER) AS Events,
         CAST(sum(CAST(o.o_orderkey % 3 AS INTEGER)) AS INTEGER) AS Fatalities
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3)"""

MONTH_NUM = """CASE {0} WHEN 'January' THEN '01' WHEN 'February' THEN '02'
  WHEN 'March' THEN '03' WHEN 'April' THEN '04' WHEN 'May' THEN '05'
  WHEN 'June' THEN '06' WHEN 'July' THEN '07' WHEN 'August' THEN '08'
  WHEN 'September' THEN '09' WHEN 'October' THEN '10'
  WHEN 'November' THEN '11' WHEN 'December' THEN '12' END"""

EVENTS_CLEAN = """events_clean AS (
  SELECT Country AS country, Month, Year,
         coalesce(Events, 0) AS events, coalesce(Fatalities, 0) AS fatalities,
         concat_ws('-', """ + MONTH_NUM.format("Month") + """, CAST(Year AS VARCHAR)) AS month_year
  FROM monthly_events
  WHERE Country IS NOT NULL)"""

# Tokens: lower-cased runs of letters, digits, underscore, length >= 2.
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"
TOKENS = ("toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '"
          + TOKEN_RE + "')) AS term FROM documents)")


_EDGE = r"[!-/:-@\[-`{-~]+"


def scoring_tokens_sql(text: str) -> str:
    """Lower-cased chunks between white space; the punctuation around a chunk
    goes when more than two characters remain."""
    bare = f"regexp_replace(x, '^{_EDGE}|{_EDGE}$', '', 'g')"
    return (f"[CASE WHEN length({bare}) > 2 THEN {bare} ELSE x END FOR x IN "
            rf"regexp_split_to_array(lower({text}), '[\x09-\x0D ]+') IF x <> '']")


def values_cte(name: str, cols: tuple[str, ...], rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return repr(v)
    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(cols)}) AS (VALUES\n  {body})"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'"
                           for v in values) + ")"
