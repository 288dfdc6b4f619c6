"""Keyword mentions and tokenisation as native Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters, digits or underscore, at least two long,
# taken from the lower-cased text (the classic vectoriser token rule).
WORD_CHARS = r"\p{L}\p{N}_"
MIN_TOKEN_LEN = 2
TOKEN_RE = rf"[{WORD_CHARS}]{{{MIN_TOKEN_LEN},}}"

# Sentiment scoring keeps what that rule cuts: a chunk between white space
# loses the punctuation around it when more than two characters remain
# ("isn't", "good"), else it stays whole (":)", "ok!"), as published.
# Cutting at one blank and trimming are byte searches, no regex.
_BREAKS = "\t\n\x0b\x0c\r"
_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

MODES = ("substring", "word", "regex")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_list(keywords) -> list[str]:
    if isinstance(keywords, str):
        return [keywords]
    return [k for k in keywords]


def keyword_pattern(keywords: Iterable[str] | str, mode: str = "substring",
                    case_sensitive: bool = False) -> str:
    """One regex for a keyword list.

    ``substring`` escapes each keyword, ``word`` additionally requires a
    non-word character (or the text edge) on both sides, ``regex`` takes the
    keywords as patterns.  The alternation is built once on the driver.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    kws = _as_list(keywords)
    if not kws:
        raise ValueError("at least one keyword is required")
    parts = kws if mode == "regex" else [re.escape(k) for k in kws]
    alt = "|".join(parts)
    if mode == "word":
        alt = rf"(^|[^{WORD_CHARS}])({alt})([^{WORD_CHARS}]|$)"
    # (?iu): Unicode-aware case folding, as a Python/pandas case-insensitive
    # match does (plain (?i) in Java folds ASCII letters only).
    return alt if case_sensitive else f"(?iu)(?:{alt})"


def mentions(text, keywords: Iterable[str] | str, mode: str = "substring",
             case_sensitive: bool = False) -> Column:
    """True when ``text`` mentions any keyword; null text counts as False.

    Plain substrings avoid the regex engine: a case-folded ``contains`` per
    keyword is a codegen'd byte search.
    """
    t = _c(text)
    kws = _as_list(keywords)
    if mode == "substring":
        hay = t if case_sensitive else F.lower(t)
        cond = None
        for k in kws:
            one = hay.contains(k if case_sensitive else k.lower())
            cond = one if cond is None else (cond | one)
    else:
        cond = t.rlike(keyword_pattern(kws, mode, case_sensitive))
    return F.coalesce(cond, F.lit(False))


def mentions_word(text, words: Iterable[str], case_sensitive: bool = False) -> Column:
    """True when a token of ``text`` is one of ``words``, each a single run of
    word characters; null text counts as False.

    For thousands of words: one pass cuts the tokens, and each is looked up in
    a hash set, so the cost does not grow with their number.
    """
    t = _c(text)
    words = {w if case_sensitive else w.lower() for w in _as_list(words)}
    bad = sorted(w for w in words if not re.fullmatch(r"\w+", w))
    if not words or bad:
        raise ValueError(f"words must be single runs of word characters: {bad[:5]}")
    runs = F.regexp_extract_all(t if case_sensitive else F.lower(t),
                                F.lit(f"[{WORD_CHARS}]+"), 0)
    return F.coalesce(F.exists(runs, lambda x: x.isin(sorted(words))), F.lit(False))


def tokens(text) -> Column:
    """Array of lower-cased tokens (maximal runs of word characters, length
    >= 2), extracted in one regex pass."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_RE), 0)


def one_line(text) -> Column:
    """The text with a blank for every other white-space character."""
    return F.translate(_c(text), _BREAKS, " " * len(_BREAKS))


def scoring_chunks(line) -> Column:
    """Array of the chunks between the blanks of a :func:`one_line` text,
    empty ones included."""
    return F.split(_c(line), " ")


def scoring_term(chunk: Column) -> Column:
    """A chunk without the punctuation around it when more than two
    characters remain, else the chunk."""
    bare = F.btrim(chunk, F.lit(_PUNCT))
    return F.when(F.length(bare) > 2, bare).otherwise(chunk)


def scoring_tokens(text, lower: bool = True) -> Column:
    """Array of the tokens of sentiment scoring: contractions and symbol
    tokens such as ":)" are kept."""
    t = _c(text)
    chunks = F.filter(scoring_chunks(one_line(F.lower(t) if lower else t)), lambda x: x != "")
    return F.transform(chunks, scoring_term)


def nan_to_null(c) -> Column:
    """NaN is not null in Spark aggregates; turn it into null on entry."""
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def english_stop_words() -> list[str]:
    """Spark's default English stop list (181 words).

    Loaded through ``StopWordsRemover`` when a Spark context is active,
    otherwise read from the same resource in the installed Spark jars, so
    that SQL oracles built without a JVM use the identical list.
    """
    from pyspark import SparkContext
    if SparkContext._active_spark_context is not None:
        from pyspark.ml.feature import StopWordsRemover
        return list(StopWordsRemover.loadDefaultStopWords("english"))
    import glob
    import os
    import zipfile
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars",
                                  "spark-mllib_*.jar"))
    with zipfile.ZipFile(jars[0]) as z:
        raw = z.read("org/apache/spark/ml/feature/stopwords/english.txt")
    return [w for w in raw.decode("utf-8").split("\n") if w]
