"""Score labels and exclusive topic tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chorus.functions.text import mentions

# Label texts and the default strict thresholds.
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"
POS_THRESHOLD, NEG_THRESHOLD = 0.05, -0.05


def score_label(score, pos: float = POS_THRESHOLD, neg: float = NEG_THRESHOLD,
                score_type: str = "double") -> Column:
    """'Positive' above ``pos``, 'Negative' below ``neg``, else 'Neutral'.

    ``score_type='float'`` reproduces a 32-bit score: 0.05 stored as float is
    0.0500000007 and is therefore 'Positive'.  Null and NaN scores are 'Neutral'.
    """
    s = F.col(score) if isinstance(score, str) else score
    if score_type == "float":
        s = s.cast("float")
    elif score_type != "double":
        raise ValueError("score_type must be 'double' or 'float'")
    # Spark orders NaN above every number.
    return (F.when(F.isnan(s.cast("double")), NEUTRAL)
            .when(s > F.lit(pos), POSITIVE)
            .when(s < F.lit(neg), NEGATIVE)
            .otherwise(NEUTRAL))


def topic_tag(text, a_keywords, b_keywords, a_label: str, b_label: str,
              neutral: str = NEUTRAL, mode: str = "substring",
              case_sensitive: bool = True) -> Column:
    """Exclusive tag: B only -> ``b_label``, A only -> ``a_label``, else
    ``neutral`` (both, neither or null text).  Defaults to case-sensitive
    plain substrings."""
    a = mentions(text, a_keywords, mode, case_sensitive)
    b = mentions(text, b_keywords, mode, case_sensitive)
    return (F.when(b & ~a, b_label)
            .when(a & ~b, a_label)
            .otherwise(neutral))
