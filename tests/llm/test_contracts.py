"""Clashing column names, window budgets, vector lengths and the language
stage's decision."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorus.llm import (ann, chat_format, exact_dedup, language_id, mixing, sharding, simhash,
                        substring_dedup)

SF001 = "/root/testdata/sf0.001"
#: Names that the operators set on their way.
INTERNAL = ["_row", "_id", "_sha", "_gsha", "_keep", "_h", "_kid", "_kh", "_size", "_source",
            "_copies", "_copy", "_rate", "_src", "_draw", "_u", "_p", "_ss", "_sh", "_sb", "_rn",
            "_frac", "_cell", "_in", "_n", "_before", "_rows", "_pos", "_text", "_key", "_spans",
            "doc_key", "copies", "root", "node", "score", "lang_pred"]


@pytest.fixture(scope="module")
def crowded(spark):
    """Documents with every internal name as a column of its own."""
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    return d.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n)
                           for n in INTERNAL])


@pytest.mark.parametrize("stage", ["first", "one", "take", "identified", "shards", "cut"])
def test_clashing_names_come_back_unchanged(crowded, stage):
    out = {"first": lambda: exact_dedup.keep_first(crowded),
           "one": lambda: simhash.keep_one(crowded),
           "take": lambda: mixing.take(crowded),
           "identified": lambda: language_id.keep_identified(crowded),
           "shards": lambda: sharding.interleave(crowded, ["doc_id"], "source", 4),
           "cut": lambda: substring_dedup.cut_spans(
               crowded, substring_dedup.repeated_spans(crowded))}[stage]()
    assert out.columns[:len(crowded.columns)] == crowded.columns
    rows = out.collect()
    assert len(rows) > 100
    assert all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in INTERNAL)


def test_every_window_keeps_its_budget(spark):
    """Random turn lengths: a window passes the budget only when its one fresh
    turn, beside the system turn, is larger alone."""
    rng = random.Random(6)
    rows, budget, history = [], 100, 40
    for conv in range(60):
        sizes = [rng.choice([1, 5, 20, 60, 97, 98, 99, 150]) for _ in range(rng.randrange(1, 14))]
        first = "system" if conv % 2 else "user"
        rows += [(conv, t, first if t == 0 else ("user", "assistant")[t % 2], "w " * n)
                 for t, n in enumerate(sizes)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = collections.Counter()
    for w in chat_format.format_windows(d, budget=budget, history=history).collect():
        turns = chat_format.parse(w.formatted)
        assert len(turns) == w.n_turns
        fresh = turns[w.n_repeated:]
        seen[w.conv_id] += len(fresh)
        if w.n_tokens > budget:
            assert len(fresh) == 1 and w.n_repeated <= 1
            assert w.n_repeated == 0 or turns[0][0] == "system"
    assert seen == collections.Counter(r[0] for r in rows)


def test_vectors_of_every_length_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=2).tolist()) for i in range(2, 40)]
    rows += [(100 + i, rng.normal(size=3).tolist()) for i in range(30)]
    rows += [(200, [1.0])]
    rows += [(5, [9.0, 9.0]), (5, [9.0, 9.0]), (7, rows[0][1]), (None, [1.0, 1.0]),
             (300, [0.0, 0.0]), (301, [None, 1.0]), (302, [float("nan"), 1.0]), (303, None)]
    d = spark.createDataFrame([(*r, 1, "x") for r in rows],
                              "vec_id long, embedding array<double>, score int, entry string")
    got = collections.defaultdict(list)
    for r in ann.nearest(d, F.col("vec_id") % 2 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v
              and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    for q in sorted({i for i, _ in usable if i % 2 == 0}):
        v = min(x for i, x in usable if i == q)
        want = sorted(((-float(np.dot(v, w)), i) for i, w in usable
                       if i != q and len(w) == len(v)))[:5]
        assert [i for i, _ in got[q]] == [i for _, i in want], q
        assert [s for _, s in got[q]] == pytest.approx([-s for s, _ in want])
    assert got[2] and got[100] and not got[200] and not got[300]


def test_the_machines_decide_the_language_stage(spark):
    """What stays is what the prediction says; texts with letters, but of no
    learned language, go, which a letter test would keep."""
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    strange = [(-i, t * 20, None, "x", 1) for i, t in enumerate(
        ["жщю ыъэ фцч ", "λμν ξωψ ", "漢字 仮名 ", "12 34 "], 1)]
    both = d.unionByName(spark.createDataFrame(strange, d.schema))
    ids = {r.doc_id for r in language_id.keep_identified(both).select("doc_id").collect()}
    assert ids == {r.doc_id for r in language_id.identify(both).collect()
                   if r.lang_pred != "und" and r.score >= language_id.MIN_SCORE}
    assert len(ids & {-1, -2, -3}) < 3 and -4 not in ids
    assert len(ids) >= 0.97 * d.count()


def test_windows_of_ties_repeated_rows_and_long_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "c"),
            (2, 0, "user", "word " * 50_000), (2, 1, "assistant", "ok")]
    d = spark.createDataFrame([(*r, "x", 5) for r in rows],
                              "conv_id long, turn long, role string, text string, "
                              "formatted string, tokens int").repartition(3)
    w = chat_format.format_windows(d, budget=60, history=20).orderBy("conv_id", "window").collect()
    one = [t for r in w if r.conv_id == 1 for t in chat_format.parse(r.formatted)[r.n_repeated:]]
    assert one == [("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "c")]
    two = [r for r in w if r.conv_id == 2]
    assert [(r.n_turns, r.n_repeated) for r in two] == [(1, 0), (1, 0)]
    back = {r.conv_id: r for r in chat_format.read_back(
        chat_format.format_windows(d, budget=60, history=20)).collect()}
    assert (back[2].n_turns, back[2].loss_chars) == (2, 2)
