"""Spark operators against plain Python computed from the written rules
"""

import math
import random
import string
from collections import Counter
from fractions import Fraction

import pandas as pd
import pytest
import regex

from chorus.functions.text import english_stop_words
from chorus.operators.lexicon import (B_INCR, DISTANCE_DECAY, N_SCALAR, Rules,
                                      lexicon_scores)
from chorus.operators import stance as st
from chorus.plans.queries import (BOOSTERS, LEXICON, NEGATORS, QUERIES,
                                  SIDE_A, SIDE_B, TOPIC_A, TOPIC_B)
from chorus.sources import proxies
from conftest import SF001, SF01

TOKEN = regex.compile(r"[\p{L}\p{N}_]{2,}")


def _docs_pd(sf):
    return pd.read_parquet(f"{sf}/documents.parquet")


def _comments_pd(sf):
    d = _docs_pd(sf)
    out = pd.DataFrame({
        "comment_id": d.doc_id,
        "author_name": [None if i % 11 == 0 else f"{s}-{i % 7}"
                        for i, s in zip(d.doc_id, d.source)],
        "self_text": d.text,
        "created_date": pd.to_datetime("2023-10-01")
        + pd.to_timedelta(d.doc_id % 400, unit="D"),
        "score": (d.n_chars % 201 - 100) / 100,
    })
    return out


def _sided_authors(rows):
    """author -> (mean A, mean B, stance), from one pass over plain rows: per
    author and side a [sum, count] of the scores of one-sided comments."""
    sides = {}
    for r in rows:
        text = (r.self_text or "").lower()
        on = [any(k.lower() in text for k in kws) for kws in (SIDE_A, SIDE_B)]
        if r.author_name is None or on[0] == on[1]:
            continue
        cell = sides.setdefault(r.author_name, [[Fraction(0), 0], [Fraction(0), 0]])[on[1]]
        cell[0] += Fraction(str(r.score))
        cell[1] += 1
    out = {}
    for author, cells in sides.items():
        a, b = (total / n if n else Fraction(0) for total, n in cells)
        out[author] = (round(float(a), 9), round(float(b), 9),
                       "Pro B" if b > a else "Pro A")
    return out


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("form", [st.author_stance_onepass, st.author_stance])
def test_stance_equals_side_sums(spark, sf, form):
    c = proxies.comments(proxies.table(spark, sf, "documents"))
    got = {r.author_name: (round(r.score_a, 9), round(r.score_b, 9), r.stance)
           for r in form(c, "author_name", "self_text", "score", SIDE_A,
                         SIDE_B, "Pro A", "Pro B").collect()}
    assert got == _sided_authors(_comments_pd(sf).itertuples())


def test_extract_equals_a_counter(spark):
    rows = list(_comments_pd(SF01).itertuples())
    stance = _sided_authors(rows)
    want = Counter()
    for r in rows:
        has_a, has_b = TOPIC_A in r.self_text, TOPIC_B in r.self_text
        topic = "Neutral" if has_a == has_b else TOPIC_A if has_a else TOPIC_B
        label = ("Positive" if r.score > 0.05 else
                 "Negative" if r.score < -0.05 else "Neutral")
        side = stance.get(r.author_name, (0, 0, "Neutral"))[2]
        want[side, topic, label, r.created_date.date()] += 1
    got = {(r.stance, r.topic, r.sentiment_label, r.created_date): r.n_comments
           for r in QUERIES["extract_topic_label"](spark, SF01).collect()}
    assert got == dict(want)


def _chunks(text):
    """Chunks between white space, bare of punctuation if over two characters are left."""
    bare = [(x, x.strip(string.punctuation)) for x in regex.split("[\t-\r ]+", text) if x]
    return [b if len(b) > 2 else x for x, b in bare]


def _score_py(text, lex, negators=(), boosters=None, contrast=None,
              punctuation=False, caps=False):
    if caps:
        orig = _chunks(text) if text else []
        toks = [t.lower() for t in orig]
        up = [t.isupper() for t in orig]
        capdiff = 0 < sum(up) < len(orig)
    else:
        toks = _chunks(text.lower()) if text else []
        up, capdiff = [False] * len(toks), False
    ci = toks.index(contrast) if contrast in toks else None
    s = 0.0
    hit = False
    for i, t in enumerate(toks):
        if t not in lex:
            continue
        hit = True
        v = lex[t]
        if capdiff and up[i]:
            v = v + 0.733 if v > 0 else v - 0.733
        for k in range(1, min(4, i + 1)):       # walking back, value carried along
            p = toks[i - k]
            if p in lex:
                continue
            b = (boosters or {}).get(p, 0.0)
            if b and capdiff and up[i - k]:
                b += 0.733
            v += math.copysign(b * DISTANCE_DECAY[k - 1], b * v) if v else 0.0
            if p in negators:
                v *= N_SCALAR
        f = 1.0 if ci is None or i == ci else (0.5 if i < ci else 1.5)
        s += v * f
    if punctuation and text:
        q = text.count("?")
        amp = min(text.count("!"), 4) * 0.292 + (
            0.0 if q <= 1 else q * 0.18 if q <= 3 else 0.96)
        s = s + amp if s > 0 else s - amp if s < 0 else s
    return round(s / math.sqrt(s * s + 15.0), 4) if hit else 0.0


@pytest.mark.parametrize("with_rules", [False, True])
def test_lexicon_scores_match_python(spark, with_rules):
    lex = dict(LEXICON)
    rules = Rules(negators=NEGATORS, boosters=BOOSTERS) if with_rules else None
    d = _docs_pd(SF001)
    want = {i: _score_py(t, lex, NEGATORS if with_rules else (),
                         BOOSTERS if with_rules else None)
            for i, t in zip(d.doc_id, d.text)}
    sdf = lexicon_scores(proxies.table(spark, SF001, "documents"), "doc_id",
                         "text", spark.createDataFrame(
                             LEXICON, "term string, valence double"),
                         rules=rules)
    got = {r.doc_id: r.sentiment_score for r in sdf.collect()}
    assert got.keys() == want.keys()
    bad = [k for k in want if abs(got[k] - want[k]) > 1e-4]
    assert not bad, [(k, got[k], want[k]) for k in bad[:5]]
    assert B_INCR == 0.293


def test_lexicon_full_rules_match_python(spark):
    lex = dict(LEXICON)
    d = _docs_pd(SF01)
    want = {i: _score_py(t, lex, NEGATORS, BOOSTERS, "is", True)
            for i, t in zip(d.doc_id, d.text)}
    got = {r.doc_id: r.sentiment_score for r in
           QUERIES["lexicon_score_rules"](spark, SF01).collect()}
    bad = [k for k in want if abs(got[k] - want[k]) > 1e-4]
    assert not bad, [(k, got[k], want[k]) for k in bad[:5]]


def test_question_marks_amplify(spark):
    texts = [(1, "the good?"), (2, "the good??"), (3, "the good????"),
             (4, "the good!!!!!!"), (5, "bad the"), (6, "no hit!!")]
    df = spark.createDataFrame(texts, "id long, t string")
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0)],
                                "term string, valence double")
    got = {r.id: r.sentiment_score for r in lexicon_scores(
        df, "id", "t", lex, rules=Rules(contrast="the",
                                        punctuation=True)).collect()}
    want = {i: _score_py(t, {"good": 2.0, "bad": -2.0}, (), None, "the",
                         True) for i, t in texts}
    assert got == want
    assert got[6] == 0.0 and got[2] > got[1] and got[3] > got[2]


def test_top_terms_match_counter(spark):
    d = _docs_pd(SF01)
    stop = set(english_stop_words())
    cnt = Counter(t for txt in d.text for t in TOKEN.findall(txt.lower())
                  if t not in stop)
    top = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:20]
    got = sorted((r.term, r.tf) for r in
                 QUERIES["top_terms"](spark, SF01).collect())
    assert got == sorted(top)


def test_tokens_and_word_mentions_on_random_text(spark):
    from chorus.functions.text import mentions, tokens
    rnd = random.Random(7)
    alphabet = list("abc éßİ_9 .,'\n-") + ["un", "UN", "Un"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))
             for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                               "id int, t string")
    rows = df.select("id", tokens("t").alias("tok"),
                     mentions("t", ["un"], "word").alias("w"),
                     mentions("t", ["un"], "substring").alias("s")).collect()
    word = regex.compile(r"(?<![\p{L}\p{N}_])un(?![\p{L}\p{N}_])",
                         regex.IGNORECASE)
    for r in rows:
        t = texts[r.id]
        assert r.tok == TOKEN.findall(t.lower()), t
        assert r.s == ("un" in t.lower()), t
        assert r.w == bool(word.search(t)), t


def test_hot_author_third_of_rows(spark):
    """One author holds a third of all comments: results stay exact."""
    from chorus.plans import report
    df = _comments_pd(SF01)
    hot = df.comment_id % 3 == 0
    df.loc[hot, "author_name"] = "hot"
    rows = list(df.itertuples())
    want = {k: v[2] for k, v in _sided_authors(rows).items()}
    want_ex = sorted((*k, n) for k, n in Counter(
        (r.created_date.date(), want.get(r.author_name, "Neutral"))
        for r in rows).items())

    from pyspark.sql import functions as F
    c = proxies.comments(proxies.table(spark, SF01, "documents")).withColumn(
        "author_name", F.when(F.col("comment_id") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("author_name")))
    got = {r.author_name: r.stance for r in st.author_stance_onepass(
        c, "author_name", "self_text", "score", SIDE_A, SIDE_B).collect()}
    assert got == want and "hot" in got
    ex = report.extract(c, "daily_stance", "author_name", "comment_id",
                        "self_text", "score", "created_date", SIDE_A, SIDE_B,
                        "Pro A", "Pro B")
    assert sorted((r.created_date, r.stance, r.n_comments)
                  for r in ex.collect()) == want_ex


def test_caps_emphasis_matches_python(spark):
    texts = [(1, "this is GOOD"), (2, "THIS IS GOOD"), (3, "very GOOD stuff"),
             (4, "VERY good stuff"), (5, "not BAD at all"), (6, "GOOD"),
             (7, "Good good GOOD!"), (8, None)]
    lexd = {"good": 1.9, "bad": -2.5}
    boosters = {"very": B_INCR}
    df = spark.createDataFrame(texts, "id long, t string")
    lex = spark.createDataFrame(list(lexd.items()),
                                "term string, valence double")
    rules = Rules(negators=["not"], boosters=boosters, caps=True,
                  punctuation=True)
    got = {r.id: r.sentiment_score for r in
           lexicon_scores(df, "id", "t", lex, rules=rules).collect()}
    want = {i: _score_py(t, lexd, ["not"], boosters, None, True, True)
            for i, t in texts}
    assert got == want
    # all-caps text has no caps differential; mixed case does
    assert got[1] > got[2]
    assert got[3] > _score_py("very good stuff", lexd, ["not"], boosters)


def test_caps_rules_on_documents_match_python(spark):
    lex = dict(LEXICON)
    d = _docs_pd(SF001)
    rules = Rules(negators=NEGATORS, boosters=BOOSTERS, contrast="is",
                  punctuation=True, caps=True)
    want = {i: _score_py(t, lex, NEGATORS, BOOSTERS, "is", True, True)
            for i, t in zip(d.doc_id, d.text)}
    sdf = lexicon_scores(proxies.table(spark, SF001, "documents"), "doc_id",
                         "text", spark.createDataFrame(
                             LEXICON, "term string, valence double"),
                         rules=rules)
    got = {r.doc_id: r.sentiment_score for r in sdf.collect()}
    bad = [k for k in want if abs(got[k] - want[k]) > 1e-4]
    assert not bad, [(k, got[k], want[k]) for k in bad[:5]]
