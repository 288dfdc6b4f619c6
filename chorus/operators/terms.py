"""Corpus vocabulary: top terms and document-term counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.functions.text import english_stop_words, tokens
from chorus.operators.aggregates import top_k


def term_rows(df: DataFrame, text: str, id_col: str | None = None,
              stop_words: Sequence[str] | None = None) -> DataFrame:
    """One row per token occurrence, stop words removed.

    The stop list is a literal set (``InSet``, a hash lookup inside
    codegen), not a join.
    """
    stop = english_stop_words() if stop_words is None else list(stop_words)
    cols = [id_col] if id_col else []
    rows = df.select(*cols, F.explode(tokens(F.col(text))).alias("term"))
    return rows.filter(~F.col("term").isin(stop)) if stop else rows


def top_terms(df: DataFrame, text: str, k: int = 20,
              stop_words: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` most frequent terms of the corpus (ties by term), listed
    alphabetically: (term, tf).  Counting aggregates per task before the
    shuffle, so a term that is a third of all tokens is no hot spot."""
    counts = (term_rows(df, text, None, stop_words).groupBy("term")
              .agg(F.count(F.lit(1)).alias("tf")))
    return top_k(counts, k, "tf", "term").orderBy("term")


def doc_term_counts(df: DataFrame, id_col: str, text: str, k: int = 20,
                    stop_words: Sequence[str] | None = None) -> DataFrame:
    """(id, term, tf) over the ``k``-term vocabulary of :func:`top_terms`.

    Two passes over the text: the first finds the vocabulary, the second
    keeps only vocabulary tokens before the shuffle.  The vocabulary is
    broadcast; its size is bounded by ``k``.
    """
    vocab = F.broadcast(top_terms(df, text, k, stop_words).select("term"))
    rows = term_rows(df, text, id_col, stop_words).join(vocab, "term")
    return rows.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_term_vectors(df: DataFrame, id_col: str, text: str, k: int = 20,
                     stop_words: Sequence[str] | None = None,
                     out: str = "tf") -> DataFrame:
    """(id, tf vector): the document-term matrix as sparse vectors over the
    ``k``-term vocabulary of :func:`top_terms` (index = alphabetical rank,
    as a vectoriser lists its features).

    The vocabulary -- ``k`` terms, bounded by the caller -- is the only
    thing that reaches the driver; vectors are built on the executors by a
    ``CountVectorizerModel``.
    """
    from pyspark.ml.feature import CountVectorizerModel
    vocab = [r.term for r in top_terms(df, text, k, stop_words).collect()]
    model = CountVectorizerModel.from_vocabulary(
        vocab, inputCol="_tokens", outputCol=out)
    toks = df.select(id_col, tokens(F.col(text)).alias("_tokens"))
    return model.transform(toks).select(id_col, out)
