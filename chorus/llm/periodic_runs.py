"""Periodic runs of words, found on a Re-Pair grammar of the word ids.

A run is a longest stretch of words with smallest period q that repeats its
first q words at least ``MIN_REPEATS`` times and has at least ``MIN_LENGTH``
words ("spam spam spam", a list item pasted over and over).

Per text, inside one Spark task:

1. Re-Pair: word pairs that occur most often become nonterminals, in rounds,
   until no pair occurs twice.  A round replaces, all over the text, every pair
   that is more frequent than both pairs it overlaps with; ties fall by hash,
   so a constant share of the repeated pairs goes in every round.
2. Every nonterminal X -> Y Z is looked at once: runs inside its expansion that
   cross the border of Y and Z.  The borders of the final sequence are looked
   at within the whole text.  Every run of the text lies whole in some lowest
   node of the derivation, and crosses that node's border.
3. Runs of a nonterminal are translated to all positions where it was derived.
4. Intervals of one period that share at least a period are parts of one run
   and are merged into the maximal interval.

A run that crosses a border has two whole periods on one side of it.  So its
period is a distance from the words beside the border to an earlier (or later)
equal stretch: short periods are compared directly, longer ones are looked up
among equal grams of 8, 64, 512 ... words, each of which serves the periods up
to eight times its length.  Every candidate is then verified word by word.

Texts of one Arrow batch are worked on together (numpy arrays over a group of
texts, ids private to each text); a longer text is a group of its own, and
memory is proportional to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import prepare

MIN_REPEATS = 4
MIN_LENGTH = 6
#: Words worked on together; a longer text is a group of its own.
GROUP_WORDS = 1 << 18
#: Periods below this are compared directly; gram lengths are its powers.
BASE = 8

RESULT = ("struct<n_words:bigint,"
          "runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number (multiply and shift, wrapping)."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# ------------------------------------------------------------------- Re-Pair
class Grammar:
    """Re-Pair of a group of texts whose ids are private to each text.

    ``cuts``: borders of the final sequence, as positions.  ``rules``: per kept
    nonterminal (first position, length of the left part, length); ``at``: per
    rule all positions where it was derived.  Nonterminals shorter than
    ``shortest`` are not kept, as no run fits them.  ``pairs``: how often the
    word pair at each position occurs.
    """

    def __init__(self, ids: np.ndarray, text: np.ndarray, shortest: int):
        n = len(ids)
        sym, pos, end = ids.astype(np.int64), np.arange(n), np.arange(1, n + 1)
        ok = np.zeros(n, bool)                   # a pair with the next symbol
        ok[:-1] = text[1:] == text[:-1]
        starts = np.ones(n + 1, bool)
        starts[-1] = False
        first_of_text = np.ones(n, bool)
        first_of_text[1:] = text[1:] != text[:-1]
        starts[:-1] &= ~first_of_text
        self.pairs = np.zeros(n, np.int64)
        symbols = int(sym.max()) + 1 if n else 0
        first, split, length, where, rule_of = [], [], [], [], []
        rules, fresh = 0, True
        while True:
            i = np.flatnonzero(ok)
            if not len(i):
                break
            key = sym[i] * symbols + sym[i + 1]
            uniq, inv = np.unique(key, return_inverse=True)
            if fresh:
                self.pairs[i] = np.bincount(inv, minlength=len(uniq))[inv]
                fresh = False
            # Of overlapping equal pairs (a a a) every other one counts.
            same = np.zeros(len(i), bool)
            same[1:] = (inv[1:] == inv[:-1]) & (i[1:] == i[:-1] + 1)
            k = np.arange(len(i))
            valid = ((k - np.maximum.accumulate(np.where(same, 0, k))) & 1) == 0
            count = np.bincount(inv[valid], minlength=len(uniq))
            often = count >= 2
            if not often.any():
                break
            rank = np.zeros(len(uniq), np.int64)
            many = np.flatnonzero(often)
            rank[many[np.lexsort((_mixed(uniq[many]), count[many]))]] = \
                np.arange(1, len(many) + 1)
            pri = np.zeros(len(sym) + 2, np.int64)
            pri[i + 1] = np.where(valid, rank[inv], 0)
            here = pri[1:-1]
            top = ((here > 0) & (here > pri[:-2]) & (here > pri[2:]))[i]
            used = np.bincount(inv[top], minlength=len(uniq))
            top &= (used >= 2)[inv]
            i_top, which = i[top], inv[top]
            # Pairs that occur once never change again: no pair, and symbols
            # between two such pairs are done.
            ok[i[~often[inv]]] = False
            chosen, at_first, new = np.unique(which, return_index=True, return_inverse=True)
            left = pos[i_top]
            starts[pos[i_top + 1]] = False
            parts = pos[i_top + 1] - left
            end[i_top] = end[i_top + 1]
            size = end[i_top] - left
            sym[i_top] = symbols + new
            ok[i_top] = ok[i_top + 1]
            symbols += len(chosen)
            keep = size[at_first] >= shortest
            if keep.any():
                number = np.full(len(chosen), -1)
                number[keep] = rules + np.arange(int(keep.sum()))
                rules += int(keep.sum())
                first.append(left[at_first][keep])
                split.append(parts[at_first][keep])
                length.append(size[at_first][keep])
                held = number[new] >= 0
                where.append(left[held])
                rule_of.append(number[new][held])
            stay = np.ones(len(sym), bool)
            stay[i_top + 1] = False
            sym, pos, end, ok = sym[stay], pos[stay], end[stay], ok[stay]
            stay = ok.copy()
            stay[1:] |= ok[:-1]
            sym, pos, end, ok = sym[stay], pos[stay], end[stay], ok[stay]
        self.cuts = np.flatnonzero(starts)
        cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.first, self.split, self.length = cat(first), cat(split), cat(length)
        where, rule_of = cat(where), cat(rule_of)
        order = np.argsort(rule_of, kind="stable")
        self.at = where[order]
        self.edges = np.searchsorted(rule_of[order], np.arange(rules + 1))


# ------------------------------------------------------- runs across a border
def _matches(x: np.ndarray, i: int, j: int, step: int, most: int) -> int:
    """How many of x[i], x[i+step], ... equal x[j], x[j+step], ...: at most ``most``."""
    done, block = 0, 16
    while done < most:
        m = min(block, most - done)
        if step > 0:
            a, b = x[i + done:i + done + m], x[j + done:j + done + m]
        else:
            a, b = x[i - done - m + 1:i - done + 1][::-1], x[j - done - m + 1:j - done + 1][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done += m
        block *= 2
    return done


class _Grams:
    """Equal grams of ``g`` words: where else the gram at a position occurs."""

    def __init__(self, ids: np.ndarray, g: int):
        n = len(ids)
        h, have = _mixed(ids + 1), 1
        while have < g:                          # g is a power of two
            m = len(h) - have
            if m <= 0:
                h = h[:0]
                break
            h = _mixed(h[:m] * np.uint64(0xD6E8FEB86659FD93) + h[have:have + m])
            have *= 2
        self.h = h
        self.order = np.argsort(h, kind="stable")
        self.sorted = h[self.order]

    def near(self, at: int, low: int, high: int) -> np.ndarray:
        """Positions from ``low`` to ``high`` whose gram equals that at ``at``."""
        if not 0 <= at < len(self.h):
            return np.zeros(0, np.int64)
        same = self.order[np.searchsorted(self.sorted, self.h[at]):
                          np.searchsorted(self.sorted, self.h[at], "right")]
        return same[np.searchsorted(same, low):np.searchsorted(same, high, "right")]

    def often(self, at: np.ndarray) -> np.ndarray:
        """Whether the gram at each position occurs three times at least."""
        out = np.zeros(len(at), bool)
        ok = (at >= 0) & (at < len(self.h))
        h = self.h[at[ok]]
        out[ok] = (np.searchsorted(self.sorted, h, "right")
                   - np.searchsorted(self.sorted, h)) >= 3
        return out


def _candidates(ids: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(border, period, side) arrays that hold every period of a run that
    crosses border ``b[i]`` within [lo[i], hi[i]); side 0 has two whole periods
    before the border, side 1 after it."""
    who, period, side = [], [], []

    def add(i, q, s):
        who.append(i)
        period.append(np.broadcast_to(q, i.shape).astype(np.int64))
        side.append(np.full(len(i), s))
    every = np.arange(len(b))
    for q in range(1, BASE):
        i = every[b - 2 * q >= lo]
        for k in range(1, q + 1):
            i = i[ids[b[i] - k] == ids[b[i] - k - q]]
        add(i, q, 0)
        i = every[b + 2 * q <= hi]
        for k in range(q):
            i = i[ids[b[i] + k] == ids[b[i] + k + q]]
        add(i, q, 1)
    g, left, right = BASE, every, every
    while True:
        room = hi - lo >= MIN_REPEATS * g
        left = left[room[left] & (b[left] - 2 * g >= lo[left])]
        right = right[room[right] & (b[right] + 2 * g <= hi[right])]
        if not len(left) and not len(right):
            break
        grams = _Grams(ids, g)
        left, right = left[grams.often(b[left] - g)], right[grams.often(b[right])]
        for i in left.tolist():
            at = int(b[i]) - g
            most = min((int(b[i]) - int(lo[i])) // 2, BASE * g - 1)
            found = at - grams.near(at, at - most, at - g)
            add(np.full(len(found), i), found, 0)
        for i in right.tolist():
            at = int(b[i])
            most = min((int(hi[i]) - at) // 2, BASE * g - 1)
            found = grams.near(at, at + g, at + most) - at
            add(np.full(len(found), i), found, 1)
        g *= BASE
    if not who:
        return (np.zeros(0, np.int64),) * 3
    who, period, side = map(np.concatenate, (who, period, side))
    order = np.lexsort((side, period, who))
    return who[order], period[order], side[order]


def crossing_runs(ids: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(border, start, end, period) lists: for each i the runs of
    ids[lo[i]:hi[i]] that hold the words on both sides of border ``b[i]``."""
    out = []
    who, period, side = _candidates(ids, b, lo, hi)
    edges = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else []
    for at, to in zip(edges, np.append(edges[1:], len(who)) if len(edges) else []):
        i = int(who[at])
        c, low, high = int(b[i]), int(lo[i]), int(hi[i])
        found, qs, sides, k = [], period[at:to], side[at:to], 0
        while k < len(qs):
            q, s, k = int(qs[k]), int(sides[k]), k + 1
            if s == 0:
                back = _matches(ids, c - q - 1, c - 1, -1, c - q - low)
                if back < q:
                    continue
                start, end = c - q - back, c + _matches(ids, c - q, c, 1, high - c)
            else:
                ahead = _matches(ids, c, c + q, 1, high - c - q)
                if ahead < q:
                    continue
                end = c + q + ahead
                start = c - _matches(ids, c - 1, c - 1 + q, -1, c - low)
            if not start < c < end or end - start < max(MIN_LENGTH, MIN_REPEATS * q):
                continue
            if any(q % p == 0 and x <= start and end <= y for p, x, y in found):
                continue
            found.append((q, start, end))
            # Two periods before (after) the border that lie in a run of a
            # smaller period have that period too: no run of their own.
            rest = qs[k:] > np.array([(c - start) // 2, (end - c) // 2])[sides[k:]]
            qs, sides, k = qs[k:][rest], sides[k:][rest], 0
        out += [(i, x, y, q) for q, x, y in found]
    return out


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Maximal intervals: those of one period that share a period are one run."""
    if not len(start):
        return start, end, period
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    shift = (np.cumsum(np.append(0, period[1:] != period[:-1]))) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, start[1:] + shift[1:] > reach[:-1] - period[1:])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(new)) - 1
    return start[at], reach[last] - shift[at], period[at]


def group_runs(ids: np.ndarray, text: np.ndarray, bounds: np.ndarray):
    """(start, end, period) arrays of all runs of a group of texts, by position.

    ``ids`` are word ids private to each text, ``text`` the text's number at
    each position, ``bounds`` the first position of each text and the end."""
    none = np.zeros(0, np.int64)
    if len(ids) < MIN_LENGTH:
        return none, none, none
    g = Grammar(ids, text, MIN_LENGTH)
    # A run holds each of its pairs three times, the one at the border too.
    cuts = g.cuts[g.pairs[g.cuts - 1] >= MIN_REPEATS - 1]
    border = g.first + g.split
    rule = np.flatnonzero(g.pairs[border - 1] >= MIN_REPEATS - 1)
    b = np.concatenate((border[rule], cuts))
    if not len(b):
        return none, none, none
    lo = np.concatenate((g.first[rule], bounds[text[cuts]]))
    hi = np.concatenate((g.first[rule] + g.length[rule], bounds[text[cuts] + 1]))
    start, end, period = [none], [none], [none]
    for i, x, y, q in crossing_runs(ids, b, lo, hi):
        if i < len(rule):
            r = rule[i]
            shift = g.at[g.edges[r]:g.edges[r + 1]] - g.first[r]
        else:
            shift = np.zeros(1, np.int64)
        start.append(x + shift)
        end.append(y + shift)
        period.append(np.full(len(shift), q))
    start, end, period = _merged(*map(np.concatenate, (start, end, period)))
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


# ------------------------------------------------------------------- operator
def _groups(raw: list) -> Iterator[list[list[bytes]]]:
    """Word lists of the texts, in groups of about GROUP_WORDS words."""
    held, size = [], 0
    for text in raw:
        words = (text or b"").split()            # bytes: ASCII white space only
        if held and size + len(words) > GROUP_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _group_result(texts: list[list[bytes]]):
    """Per text of the group: its runs and its collapsed text."""
    sizes = np.array([len(w) for w in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.empty(bounds[-1], np.int64)
    base = 0
    for words, at in zip(texts, bounds.tolist()):
        own: dict[bytes, int] = {}
        ids[at:at + len(words)] = np.fromiter(
            (own.setdefault(w, len(own)) for w in words), np.int64, len(words)) + base
        base += len(own)
    text = np.repeat(np.arange(len(texts)), sizes)
    start, end, period = group_runs(ids, text, bounds)
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.cumsum(gone[:-1]) == 0
    of = text[start] if len(start) else start
    edges = np.searchsorted(of, np.arange(len(texts) + 1))
    for i, words in enumerate(texts):
        a, z = edges[i], edges[i + 1]
        if a < z:
            words = [words[k] for k in np.flatnonzero(kept[bounds[i]:bounds[i + 1]])]
        yield (start[a:z] - bounds[i], end[a:z] - start[a:z], period[a:z],
               b" ".join(words), int(sizes[i]))


def runs_udf(text: Column) -> Column:
    """Column ``RESULT`` of a text column: word count, the runs by start and
    period (word numbers from 0), and the text with every word dropped that a
    run contains after its first period, the rest joined by one space."""
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [r for group in _groups(texts.cast(pa.binary()).to_pylist())
                    for r in _group_result(group)]
            cat = lambda k: np.concatenate([r[k] for r in rows] or [np.zeros(0, np.int64)])
            runs = pa.StructArray.from_arrays(
                [pa.array(cat(k), pa.int64()) for k in range(3)], ["start", "length", "period"])
            offsets = np.concatenate(([0], np.cumsum([len(r[0]) for r in rows], dtype=np.int64)))
            yield pa.StructArray.from_arrays(
                [pa.array([r[4] for r in rows], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                 pa.array([r[3] for r in rows], pa.binary()).cast(pa.string())],
                ["n_words", "runs", "collapsed"])
    return run.asNondeterministic()(text)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed
    (the text without the repeats) for every row.

    A null, empty or blank text has no words, no runs and an empty collapsed
    text.  Ids play no part: null and repeated ids and repeated rows each give
    their own row.  Runs that overlap (of different periods, or of one period
    sharing less than it) are all reported.  A very long text is worked on by
    one task, in memory proportional to its words.  Other columns are not read,
    whatever their names.  An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        runs_udf(F.col(f"`{text_col}`")).alias("found"))
            .select("doc_id", "found.n_words", "found.runs", "found.collapsed"))


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, each non-null text without the repeats
    of its runs.  Null texts stay null; other columns pass as they are."""
    prepare(docs.sparkSession)
    c = F.col(f"`{text_col}`")
    cut = F.when(c.isNotNull(), runs_udf(c)["collapsed"]).alias(text_col)
    return docs.select(*[cut if x == text_col else F.col(f"`{x}`") for x in docs.columns])
