"""Lexicon sentiment scoring as a distributed job.

Each text is tokenised on the executors (contractions and symbol tokens
are kept, see ``functions.text.scoring_tokens``), its tokens are joined to a
caller-supplied ``(term, valence)`` table, valences are summed per text and
normalised to [-1, 1] as ``s / sqrt(s^2 + alpha)``.  Texts without a
lexicon hit (or without text) score 0.0.

Plan shape: scan -> explode tokens -> broadcast hash join (the lexicon is
broadcast only after its size is proven bounded; only hits pass) ->
partial sum per text -> one shuffle of (id, partial sum) rows [-> join back
on id for the wide form; none on a table bucketed by id].  No Python runs
per row.

The optional rules of the published rule-based method (Hutto & Gilbert,
ICWSM 2014): walking back over the three preceding tokens, a booster word
shifts a hit's valence away from zero with a distance decay and a negator
multiplies it by a negative scalar; hits before the first contrast word
("but") count half and hits after it one and a half times; all-caps hits
and boosters in mixed-case text gain emphasis; and '!' / '?' marks push
the text's sum away from zero.  Rule lookups run only on
lexicon hits (after the join), never on every token.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.functions.text import one_line, scoring_chunks, scoring_term, scoring_tokens
from chorus.operators.joins import small_side
from chorus.session import cut_lineage

# Fixed values of the published method.
ALPHA = 15.0                      # normalisation constant
B_INCR, B_DECR = 0.293, -0.293    # booster increments
N_SCALAR = -0.74                  # negation multiplier
DISTANCE_DECAY = (1.0, 0.95, 0.9)  # weight of tokens 1, 2, 3 positions back
CONTRAST_BEFORE, CONTRAST_AFTER = 0.5, 1.5   # around the first contrast word
EXCLAIM_STEP, EXCLAIM_MAX = 0.292, 4         # per '!', at most 4 counted
QUESTION_STEP, QUESTION_MAX, QUESTION_CAP = 0.18, 3, 0.96  # 2-3 '?' / more
C_INCR = 0.733                               # emphasis of an all-caps word
LEXICON_MAX_ROWS = 2_000_000
# Share of all tokens from which a term is hot.
HOT_SHARE = 0.001


@dataclass(frozen=True)
class Rules:
    """Optional scoring rules; the defaults apply none of them.

    ``caps``: when a text mixes all-caps and other tokens, an all-caps hit
    moves ``C_INCR`` further from zero, and so does an all-caps booster.
    With it, tokens are cut from the original text and lower-cased one by
    one (so their case is known).

    Not applied: the method's special idioms.
    """
    negators: Sequence[str] = ()
    boosters: Mapping[str, float] = None  # term -> B_INCR or B_DECR
    n_scalar: float = N_SCALAR
    decay: Sequence[float] = DISTANCE_DECAY
    contrast: str | None = None   # e.g. "but": earlier hits x0.5, later x1.5
    punctuation: bool = False     # '!' and '?' push the sum away from zero
    caps: bool = False            # ALL-CAPS hits/boosters in mixed-case text


def _count_char(text, ch: str):
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def punctuation_amplifier(text):
    """Emphasis of a text from its '!' and '?' marks (0 for null text)."""
    ex = F.least(_count_char(text, "!"), F.lit(EXCLAIM_MAX)) * EXCLAIM_STEP
    q = _count_char(text, "?")
    qm = (F.when(q <= 1, F.lit(0.0))
          .when(q <= QUESTION_MAX, q * QUESTION_STEP)
          .otherwise(F.lit(QUESTION_CAP)))
    return F.coalesce(ex + qm, F.lit(0.0))


def _normalise(s, alpha: float, places: int):
    return F.round(F.coalesce(s / F.sqrt(s * s + F.lit(alpha)), F.lit(0.0)),
                   places)


def hot_terms(words: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """The terms that make up at least ``share`` of all rows of ``words``: at
    most 1 / share of them.  Counted per task before the shuffle."""
    counts = cut_lineage(words.groupBy("term").agg(F.count(F.lit(1)).alias("_c")))
    total = counts.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    return counts.filter(F.col("_c") >= max(1.0, share * total)).select("term")


def _with_valence(words: DataFrame, lex: DataFrame, small: bool) -> DataFrame:
    """``words`` joined to the lexicon.  A lexicon too large to broadcast is
    joined by shuffle, but for the hot terms: a term that is a third of all
    tokens would be one task's work.  Their part of the lexicon, at most
    1 / ``HOT_SHARE`` rows, is broadcast, and only the other tokens shuffle."""
    if small:
        return words.join(lex, "term")
    hot = F.broadcast(cut_lineage(hot_terms(words)))
    met = words.join(F.broadcast(lex.join(hot, "term", "left_semi")), "term")
    rest = words.join(hot, "term", "left_anti").join(lex, "term")
    return met.unionByName(rest)


def lexicon_sums(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                 rules: Rules | None = None,
                 lexicon_rows: int | None = None) -> DataFrame:
    """(id, _d, _n, _s): per id and text (``_d`` is the text's digest) the
    number of rows that hold it and the summed valence of one of them.

    Only lexicon hits survive the (inner, broadcast) join, so the aggregate
    sees hits rather than every token.  One row per input row is added by a
    union: it lists every text (``_s`` is null without a hit) and counts
    repeated rows, whose hits are summed together and divided again.
    A term that the lexicon repeats counts once, with its smallest valence;
    terms match in lower case.
    """
    terms = (lexicon.select(F.lower("term").alias("term"),
                            F.col("valence").cast("double").alias("valence"))
             .groupBy("term").agg(F.min("valence").alias("valence")))
    lex = small_side(terms, LEXICON_MAX_ROWS, lexicon_rows)
    small = lex is not terms
    df = df.withColumn("_d", text_digest(F.col(text)))
    key = [id_col, "_d"]

    def with_every_row(hits: DataFrame, cols: list[str]) -> DataFrame:
        rows = df.select(*key, *[F.lit(None).cast("double").alias(c)
                                 for c in cols], F.lit(1).alias("_row"))
        return hits.withColumn("_row", F.lit(None).cast("int")).unionByName(rows)

    n, total = F.count("_row"), F.sum("_v")

    if rules is None:
        chunk = F.col("_chunk")
        words = (df.select(*key, one_line(F.lower(F.col(text))).alias("_line"))
                 .select(*key, F.explode(scoring_chunks("_line")).alias("_chunk"))
                 .filter(chunk != "").select(*key, scoring_term(chunk).alias("term")))
        hits = _with_valence(words, lex, small).select(*key, F.col("valence").alias("_v"))
        return (with_every_row(hits, ["_v"]).groupBy(*key)
                .agg(n.alias("_n"), F.try_divide(total, n).alias("_s")))
    win = len(rules.decay)
    # Each token with its 1-based position and the tokens 1..win before it
    # (null at the start), built by one higher-order pass over the
    # materialised array; per-text values ride along as plain columns.
    extra, carried = [], []
    if rules.contrast:
        extra.append(F.array_position(F.col("_toks"), rules.contrast)
                     .alias("_ci"))
        carried.append("_ci")
    if rules.punctuation:
        extra.append(punctuation_amplifier(F.col(text)).alias("_amp"))
        carried.append("_amp")
    if rules.caps:
        orig = scoring_tokens(F.col(text), lower=False)
        arr = df.select(*key, orig.alias("_orig"),
                        *([F.col(text)] if rules.punctuation else []))
        up = F.transform(F.col("_orig"), lambda t: (t == F.upper(t))
                         & (t != F.lower(t)))
        arr = arr.select(
            *key, F.transform(F.col("_orig"), F.lower).alias("_toks"),
            up.alias("_up"),
            *([F.col(text)] if rules.punctuation else []))
        n_up = F.size(F.filter(F.col("_up"), lambda u: u))
        extra.append(((n_up > 0) & (n_up < F.size(F.col("_up"))))
                     .alias("_capdiff"))
        carried.append("_capdiff")
    else:
        arr = df.select(*key, scoring_tokens(F.col(text)).alias("_toks"),
                        *([F.col(text)] if rules.punctuation else []))
    # Per-text values are computed once per text, in a projection below
    # the explode (inside the generator's select they would be evaluated
    # once per token).
    arr = arr.select(*key, "_toks", *(["_up"] if rules.caps else []),
                     *extra)
    toks = F.col("_toks")
    ups = F.col("_up")

    def item(t, i):
        fields = [t.alias("term"), (i + 1).alias("pos"),
                  *[F.get(toks, i - k).alias(f"p{k}")
                    for k in range(1, win + 1)]]
        if rules.caps:
            fields += [F.get(ups, i).alias("u0"),
                       *[F.get(ups, i - k).alias(f"u{k}")
                         for k in range(1, win + 1)]]
        return F.struct(*fields)

    items = F.transform(toks, item)
    rows = _with_valence(arr.select(*key, *carried, F.explode(items).alias("it"))
                         .select(*key, *carried, "it.*"), lex, small)
    v = F.col("valence")
    if rules.caps:
        caps_on = F.col("_capdiff") & F.coalesce(F.col("u0"), F.lit(False))
        v = F.when(caps_on, F.when(v > 0, v + C_INCR).otherwise(v - C_INCR)
                   ).otherwise(v)
    # The method walks back one token at a time and carries the changed
    # valence along: a booster beyond a negator works on the negated sign.
    # Words that the lexicon itself holds act as neither.
    boosters = {k: float(x) for k, x in (rules.boosters or {}).items()}
    named = sorted({*boosters, *rules.negators})
    own = {r["term"] for r in lex.filter(F.col("term").isin(named))
           .collect()} if named else set()          # at most the rules' words
    boosters = {k: x for k, x in boosters.items() if k not in own}
    negators = [w for w in rules.negators if w not in own]
    bmap = (F.create_map(*[x for k, b in sorted(boosters.items())
                           for x in (F.lit(k), F.lit(b))])
            if boosters else None)
    adj = v
    for k in range(1, win + 1):
        p = F.col(f"p{k}")
        if bmap is not None:
            b = F.coalesce(F.try_element_at(bmap, p), F.lit(0.0))
            if rules.caps:
                b = b + F.when((b != 0) & F.col("_capdiff")
                               & F.coalesce(F.col(f"u{k}"), F.lit(False)),
                               F.lit(C_INCR)).otherwise(F.lit(0.0))
            adj = adj + F.signum(adj) * b * F.lit(rules.decay[k - 1])
        if negators:
            adj = adj * F.when(p.isin(negators), F.lit(rules.n_scalar)) \
                .otherwise(F.lit(1.0))
        # One column per step, so that each step's value is computed once.
        rows = rows.withColumn(f"_a{k}", adj)
        adj = F.col(f"_a{k}")
    if rules.contrast:
        ci, pos = F.col("_ci"), F.col("pos")
        adj = adj * (F.when((ci > 0) & (pos < ci), F.lit(CONTRAST_BEFORE))
                     .when((ci > 0) & (pos > ci), F.lit(CONTRAST_AFTER))
                     .otherwise(F.lit(1.0)))
    if not rules.punctuation:
        hits = rows.select(*key, adj.alias("_v"))
        return (with_every_row(hits, ["_v"]).groupBy(*key)
                .agg(n.alias("_n"), F.try_divide(total, n).alias("_s")))
    hits = rows.select(*key, adj.alias("_v"), F.col("_amp"))
    sums = (with_every_row(hits, ["_v", "_amp"]).groupBy(*key)
            .agg(n.alias("_n"), F.try_divide(total, n).alias("_s0"),
                 F.max("_amp").alias("_amp")))
    s0, amp = F.col("_s0"), F.col("_amp")
    return sums.select(*key, "_n", F.when(s0 > 0, s0 + amp)
                       .when(s0 < 0, s0 - amp).otherwise(s0).alias("_s"))


def text_digest(text):
    """Tells texts under one id apart; null and the empty text differ."""
    return F.xxhash64(text, text.isNull())


def lexicon_score(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                  out: str = "sentiment_score", rules: Rules | None = None,
                  alpha: float = ALPHA, places: int = 4,
                  score_type: str = "double",
                  lexicon_rows: int | None = None,
                  null_ids: bool = True) -> DataFrame:
    """``df`` with a sentiment score column; every row is scored by its own
    text, however often its id occurs, null ids too.
    ``lexicon_rows``: the lexicon's size when the caller knows it.

    The join back has two equality keys, id and text digest, so one id with
    many texts is not paired with all of them, and Catalyst drops the scoring
    when nothing reads the score.  ``null_ids=False`` says that no id is null:
    the keys are then plain columns, and a table bucketed by id joins without
    a shuffle under ``spark.sql.requireAllClusterKeysForCoPartition=false``
    (set by ``chorus.session``).
    """
    sums = lexicon_sums(df, id_col, text, lexicon, rules,
                        lexicon_rows=lexicon_rows) \
        .withColumnsRenamed({id_col: "_id", "_d": "_sd"}).drop("_n")
    s = _normalise(F.col("_s"), alpha, places)
    if score_type == "float":
        s = s.cast("float")
    left = df.withColumn("_d", text_digest(F.col(text)))
    ids = (left[id_col].eqNullSafe(sums["_id"]) if null_ids
           else left[id_col] == sums["_id"])
    same = ids & (left["_d"] == sums["_sd"])
    return left.join(sums, same, "left").withColumn(out, s) \
        .drop("_s", "_d", "_sd", "_id")


def lexicon_scores(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                   out: str = "sentiment_score", rules: Rules | None = None,
                   alpha: float = ALPHA, places: int = 4,
                   lexicon_rows: int | None = None) -> DataFrame:
    """(id, score) for every row of ``df``, each by its own text.

    One shuffle of one partial sum per text: the hits are unioned with one
    row per input row, so no join back to ``df`` is needed.
    """
    sums = lexicon_sums(df, id_col, text, lexicon, rules,
                        lexicon_rows=lexicon_rows)
    return (sums.select(id_col, "_s", F.explode(F.sequence(
        F.lit(1), F.col("_n").cast("int"))).alias("_copy"))
            .select(id_col, _normalise(F.col("_s"), alpha, places).alias(out)))


def phrase_scores(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                  out: str = "sentiment_score", alpha: float = ALPHA, places: int = 4,
                  lexicon_rows: int | None = None) -> DataFrame:
    """(id, score) for every row of ``df`` under a lexicon whose terms may be
    phrases ("kiss of death": its words one blank apart).

    Terms are matched from left to right; where several begin at one token the
    longest counts, and the next match begins after it, so the words of a
    phrase do not count on their own.

    Runs of tokens, as many as the longest phrase has, are joined to the
    lexicon; only hits are gathered per text (no more than it has tokens), and
    one array expression walks over them.
    """
    terms = (lexicon.select(F.array_join(F.filter(F.split(F.lower("term"), " +"),
                                                  lambda w: w != ""), " ").alias("term"),
                            F.col("valence").cast("double").alias("valence"))
             .filter("term <> ''").groupBy("term").agg(F.min("valence").alias("valence")))
    # Lengths that the lexicon holds; a text is cut into runs of these only.
    n_words = F.size(F.split("term", " "))
    lengths = sorted(r[0] for r in terms.select(n_words).distinct().collect()) or [1]
    lex = small_side(terms, LEXICON_MAX_ROWS, lexicon_rows)
    small = lex is not terms
    rows = df.select(F.col(id_col), text_digest(F.col(text)).alias("_d"), F.col(text))
    toks = F.col("_toks")

    def runs(k: int):
        run = F.transform(F.sequence(F.lit(1), F.size(toks) - F.lit(k - 1)), lambda i: F.struct(
            i.alias("pos"), F.lit(k).alias("len"),
            F.array_join(F.slice(toks, i, F.lit(k)), " ").alias("term")))
        none = F.array().cast("array<struct<pos:int,len:int,term:string>>")
        return F.when(F.size(toks) >= k, run).otherwise(none)

    words = (rows.select(id_col, "_d", scoring_tokens(F.col(text)).alias("_toks"))
             .select(id_col, "_d", F.explode(F.concat(*map(runs, lengths))).alias("it"))
             .select(id_col, "_d", "it.*"))
    hits = _with_valence(words, lex, small).groupBy(id_col, "_d").agg(F.array_sort(
        F.collect_set(F.struct("pos", (-F.col("len")).alias("shorter"), "valence")))
        .alias("_hits"))
    start = F.struct(F.lit(1).alias("next"), F.lit(0.0).alias("sum"))
    walked = F.aggregate("_hits", start, lambda a, h: F.when(
        h["pos"] >= a["next"], F.struct((h["pos"] - h["shorter"]).alias("next"),
                                        (a["sum"] + h["valence"]).alias("sum"))).otherwise(a))
    sums = hits.select(F.col(id_col).alias("_id"), F.col("_d").alias("_sd"),
                       walked["sum"].alias("_s"))
    same = rows[id_col].eqNullSafe(sums["_id"]) & (rows["_d"] == sums["_sd"])
    return (rows.drop(text).join(sums, same, "left")
            .select(id_col, _normalise(F.col("_s"), alpha, places).alias(out)))
