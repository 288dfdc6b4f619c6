"""Periodic runs, min-max hashing and hard negatives against brute force, on
odd rows and on empty tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from chorus.llm import common, hard_negatives, minmax_hash, periodic_runs
from chorus.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, runs string, n int, node long, digest string"
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows
    and extra columns with names that the operators use."""
    rows = [(1, "Spam spam spam spam spam spam end", "en", "x", 1, 5, "d"),
            (2, "a b a b a b a b", "en", "x", 1, 5, "d"), (2, "a b a b a b a b", "en", "x", 1, 5, "d"),
            (3, "", None, None, None, None, None), (4, None, None, None, None, None, None),
            (None, "a  b\ta b a b a b", "fr", "y", 2, 6, None), (None, None, "fr", "y", 2, 6, None),
            (5, LONG, "en", "z", 3, 7, "e"), (6, LONG + "x", "en", "z", 3, 7, "e"),
            (7, " \n\t ", "en", "z", 3, 7, "e"), (8, "one two", "en", "z", 3, 7, "e"),
            (9, "ONE  two", "en", "z", 3, 7, "e"), (10, "one two three four", "en", "z", 3, 7, "e")]
    return spark.createDataFrame(rows, ODD)


# -------------------------------------------------------------- periodic runs
def all_runs(w):
    """(start, length, period) of every run, by trying every period."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                seg = w[i:j + q]
                if all(any(seg[k] != seg[k + p] for k in range(len(seg) - p)) for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    keep = [True] * len(w)
    for s, n, q in runs:
        keep[s + q:s + n] = [False] * (n - q)
    return [x for x, k in zip(w, keep) if k]


@st.composite
def repetitive(draw):
    letter = st.sampled_from([b"a", b"b", b"c", b"d"][:draw(st.integers(1, 4))])
    words = draw(st.lists(letter, max_size=30))
    for _ in range(draw(st.integers(0, 3))):
        part = draw(st.lists(letter, min_size=1, max_size=20))
        at = draw(st.integers(0, len(words)))
        many = part * draw(st.integers(2, 9))
        words[at:at] = many[:len(many) - draw(st.integers(0, len(part) - 1))]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=6))
def test_runs_equal_those_found_by_trying_every_period(texts):
    for w, (start, length, period, rest, n) in zip(texts, periodic_runs._group_result(texts)):
        want = all_runs(w)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want
        assert rest == b" ".join(collapsed(w, want)) and n == len(w)


def test_no_pair_of_the_grammar_repeats_and_rules_stand_where_derived():
    rng = random.Random(3)
    words = [rng.randrange(3) for _ in range(400)] + [7, 8, 9, 10] * 30
    ids = np.array(words)
    g = periodic_runs.Grammar(ids, np.zeros(len(ids), np.int64), 2)
    for r, (first, split, size) in enumerate(zip(g.first, g.split, g.length)):
        where = g.at[g.edges[r]:g.edges[r + 1]]
        assert len(where) >= 2 and 0 < split < size
        assert all((ids[a:a + size] == ids[first:first + size]).all() for a in where)
    # Final symbols, named by their words: no pair is there twice but overlapping.
    cuts = [0, *g.cuts.tolist(), len(ids)]
    parts = [tuple(words[a:b]) for a, b in zip(cuts, cuts[1:])]
    last = {}
    for i, pair in enumerate(zip(parts, parts[1:])):
        assert last.setdefault(pair, i) >= i - 1


@pytest.mark.parametrize("words", [
    [b"a"] * 50_000, [b"a", b"b", b"c"] * 20_000,
    [b"p%d" % i for i in range(2000)] * 30, [b"x"] * 5 + [b"y"] * 6])
def test_long_runs_are_one(words):
    (start, length, period, rest, _), = periodic_runs._group_result([words])
    if len(words) == 11:
        assert (start.tolist(), length.tolist(), period.tolist()) == ([5], [6], [1])
    else:
        q = len(set(words))
        assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [len(words)], [q])
        assert rest == b" ".join(words[:q])


def test_runs_on_odd_rows(spark, odd):
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed)
           for r in periodic_runs.periodic_runs(odd).collect()}
    assert got[1, 7] == ([], "Spam spam spam spam spam spam end")     # five equal words
    assert got[2, 8] == ([(0, 8, 2)], "a b") == got[None, 8]
    assert got[5, 60_000] == ([(0, 60_000, 3)], "lorem ipsum dolor")
    assert got[6, 60_001] == ([(0, 60_000, 3)], "lorem ipsum dolor x")
    assert all(got[k] == ([], "") for k in [(3, 0), (4, 0), (None, 0), (7, 0)])
    assert periodic_runs.periodic_runs(odd).count() == odd.count()
    cut = periodic_runs.collapse(odd)
    assert cut.columns == odd.columns
    assert cut.drop("text").exceptAll(odd.drop("text")).count() == 0
    texts = {r.doc_id: r.text for r in cut.filter("doc_id IS NOT NULL").collect()}
    assert texts[4] is None and texts[2] == "a b" and texts[8] == "one two"
    assert periodic_runs.periodic_runs(odd.limit(0)).count() == 0


def test_op11_against_the_contract(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SF001).collect()
    assert len(rows) == len(docs) and any(r.n_runs for r in rows)
    for r in rows:
        w = docs[r.doc_id].encode().split()
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if n > 1200:                       # trying every period takes squared time
            continue
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = all_runs(w)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert tuple(r) == (
            r.doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(collapsed(w, runs))))


# ---------------------------------------------------------- min-max hashing
def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k \
        else {b" ".join(w)} - {b""}


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in low[find(i)] if x is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return out


def near_copies(rng, n, words, edits):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        yield " ".join(copy)


def test_components_equal_those_of_all_pairs(spark, monkeypatch):
    """Groups whose members are linked to some but not to all others, cut into
    chunks."""
    monkeypatch.setattr(minmax_hash, "TASK_NODES", 16)
    rng = random.Random(8)
    texts = [t for k in range(12) for t in near_copies(rng, 25, 60 + 20 * k, 2 + k)]
    texts += texts[::7] + ["", None, "one", "One", "one two", "x " * 50, "x " * 60]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((r.doc_id, r.n_shingles, r.component_id)
                 for r in minmax_hash.minmax_components(df, 4, 80).collect())
    want = brute_components(rows, 4, 80)
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) / 2
    # Contracted over the cluster: the same components.
    monkeypatch.setattr(minmax_hash, "LOCAL_LINKS", 0)
    again = sorted((r.doc_id, r.n_shingles, r.component_id)
                   for r in minmax_hash.minmax_components(df, 4, 80).collect())
    assert again == want


def test_minimum_and_maximum_estimate_the_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(200):
        x = rng.integers(0, 2 ** 64, 1000, dtype=np.uint64)
        a, b = np.unique(x[:900]), np.unique(x[100:])
        v = minmax_hash.signatures([a, b])
        errors.append((v[0] == v[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.005
    # No more spread than as many independent minima.
    assert np.std(errors) < math.sqrt(0.8 * 0.2 / v.shape[1]) * 1.1
    long = rng.integers(0, 2 ** 64, 3 * minmax_hash.BLOCK, dtype=np.uint64)
    both = minmax_hash.signatures([long, long[:5]])
    x = (long ^ minmax_hash._XOR[3]) * minmax_hash._MUL[3]
    assert both[0, 6] == x.min() and both[0, 7] == x.max()


def test_minhash_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = minmax_hash.minmax_components(odd, 4, 80).collect()
    want = brute_components(rows, 4, 80)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    # Rows of no word are linked with nothing; two null ids are two rows.
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) \
        == sorted(want, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert {r.component_id for r in got if r.doc_id == 9} == {8}
    assert minmax_hash.minmax_components(odd.limit(0), 4, 80).count() == 0


# ------------------------------------------------------------- hard negatives
def brute_negatives(rows, anchor, n_pos=5, n_neg=10, low=30, high=90):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) and abs(x) * 256 < 2 ** 24 for x in v)
    rows = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
            if i is not None and lab is not None and usable(v)}
    out = []
    for i, lab, v in rows:
        if not anchor(i):
            continue
        def ranked(keep):
            hits = [(-sum(x * y for x, y in zip(v, w)), j) for j, m, w in rows
                    if len(w) == len(v) and keep(j, m)]
            return sorted(hits)
        negatives = ranked(lambda j, m: m != lab)
        for p, j in ranked(lambda j, m: m == lab and j != i)[:n_pos]:
            inside = [(s, k) for s, k in negatives if -30 * p <= -100 * s <= -90 * p][:n_neg]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(inside, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, score long, row string, place int"


@pytest.mark.parametrize("block", [1 << 18, 64])
def test_negatives_equal_those_of_all_rows(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", block)
    rng = random.Random(block)
    vec = lambda: [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 1)]) for _ in range(4)]
    rows = [(i, vec(), rng.choice([0, 0, 1, 2, None])) for i in range(300)]
    rows += [(i + 300, rows[i][1], rows[i][2]) for i in range(0, 60, 2)]        # ties
    rows += [rows[0], rows[20], (None, vec(), 1), (601, None, 1), (602, [], 0),
             (603, [float("nan")] * 4, 0), (610, [None, 1.0, 1.0, 1.0], 0),
             (604, [float("inf"), 0.0, 0.0, 0.0], 1), (620, [1.0, 2.0], 1), (621, [1.0, 1.5], 1),
             (622, [0.9, 0.8], 2), (630, [0.0] * 4, 1)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS).repartition(5)
    got = sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("id") % 10 == 0).collect()))
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert got == want and len(want) > 300
    assert hard_negatives.hard_negatives(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_threshold_stops_before_the_end():
    """Vectors of few strong dimensions: most of the block is never scored."""
    rng = np.random.default_rng(1)
    v = rng.integers(-5, 6, (4000, 8))
    v[:40, 0] = 900 + np.arange(40)
    lists = hard_negatives.Lists(np.arange(4000), np.zeros(4000, int), v)
    scored = []

    class Seen:
        def __init__(self, x):
            self.x = x

        def __getitem__(self, rows):
            scored.append(len(rows))
            return self.x[rows]
    lists.vectors = Seen(v)
    anchor = np.array([100, 1, -1, 0, 2, 0, 0, 1])
    best, = lists.best(anchor, np.ones(4000, bool), [(None, None)], 5)
    assert best == sorted(((int(s), i) for i, s in enumerate(v @ anchor)),
                          key=lambda x: (-x[0], x[1]))[:5]
    assert sum(scored) < 1000


def test_sorted_groups_join_batches():
    import pyarrow as pa
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 4]
    table = pa.table({"k": keys, "v": range(9)})
    for size in (1, 2, 3, 9):
        groups = list(common.sorted_groups(iter(table.to_batches(max_chunksize=size)), ["k"]))
        assert [g["v"].to_pylist() for g in groups] == [[0, 1, 2], [3], [4, 5, 6, 7], [8]]
