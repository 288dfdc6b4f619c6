"""SimHash near-duplicates, linked by a binary-trie self-join.

Fingerprints: XXH64 of every word shingle; a bit is set when it is set in
over half of them.  Equal fingerprints are one node.  Distinct fingerprints
are linked within ``max_bits`` differing bits.

Distribution: two fingerprints that differ in at most d bits agree wholly in
at least one of d + 1 bit blocks.  For each block the fingerprint is rotated
so that the block leads; the fingerprints that share its value form one
subtrie, which one task joins with itself.  In the task, pairs of trie nodes
are traversed together from the root, differing bits add up along the way,
and a pair is dropped as soon as its sum exceeds the budget.  A subtrie with
more fingerprints than ``TASK_KEYS`` is split into chunks, and every pair of
chunks is a task of its own, so no task is unbounded.

Components, not pairs, are the result: a task keeps a union-find, skips node
pairs that already lie in one component, and emits only the links that joined
two components.  No connection is lost, and a group of n near copies yields
n - 1 links instead of n * n / 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import broadcast_if_small, field, packed, prepare, stage, unpacked
from chorus.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints of one subtrie that a single task joins.
TASK_KEYS = 200_000
#: Node pairs expanded at a time.
FRONTIER = 1 << 18
#: Shingle hashes whose bits are counted at a time.
COUNT_BLOCK = 1 << 16


# ------------------------------------------------------------- fingerprints
def fingerprint(text: str | bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text.  ASCII letters are lower-cased;
    words are runs without ASCII white space; a text of fewer than
    ``shingle`` words is one shingle; a text without words gives 0."""
    data = (text or b"") if not isinstance(text, str) else text.encode("utf-8")
    words = data.lower().split()           # bytes: ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(joined[a:b], SEED) for a, b in
                  zip(starts[:len(words) - shingle + 1].tolist(),
                      ends[shingle - 1:].tolist())]
    h = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), COUNT_BLOCK):
        block = h[at:at + COUNT_BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprint_udf(shingle: int):
    """Column function text -> fingerprint as a signed long."""
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw = texts.cast(pa.binary())
            values = np.array([fingerprint(t.as_py(), shingle) for t in raw], np.uint64)
            yield pa.array(values.view(np.int64), pa.int64())
    return run.asNondeterministic()


# ------------------------------------------------------- the trie self-join
class _Sets:
    """Union-find over positions 0..n-1, for many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            self.root[x] = self.root[up]
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Unite the pairs; returns those that joined two sets."""
        ra, rb = self.find(a), self.find(b)
        apart = ra != rb
        used = []
        for i, j, x, y in zip(a[apart].tolist(), b[apart].tolist(),
                              ra[apart].tolist(), rb[apart].tolist()):
            x, y = self._one(x), self._one(y)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                used.append((i, j))
        return used

    def _one(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = int(self.root[x])
        return x

    def flat(self) -> np.ndarray:
        self.root = self.find(np.arange(len(self.root)))
        return self.root


class _Bits:
    """For each depth, running counts of keys whose bit at it is set."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.sums = keys, {}

    def split(self, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """Where the two children of the nodes [lo, hi) part.  Keys of a node
        are sorted and agree above ``depth``: first the zeros, then the ones."""
        if depth not in self.sums:
            bit = (self.keys >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self.sums[depth] = np.concatenate(
                ([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32)
        c = self.sums[depth]
        return hi - (c[hi] - c[lo])


def trie_links(keys: np.ndarray, roots: np.ndarray, max_bits: int,
               skip_bits: int = 0) -> list[tuple[int, int]]:
    """Links (positions in ``keys``) that connect exactly the keys of one
    subtrie within ``max_bits`` differing bits.

    ``roots`` are the first positions of the subtries; the keys of each are
    sorted, distinct and equal in their first ``skip_bits`` bits.  A trie node
    at depth d is a range of keys that agree in d bits.  The traversal goes by
    growing budget: links of few bits first, so that most of a dense group is
    one component before the wide budgets are tried.
    """
    n = len(keys)
    sets, bits, links = _Sets(n), _Bits(keys), []
    if n:
        ends = np.append(roots[1:], n)
        for budget in range(1, max_bits + 1):
            _traverse(keys, bits, roots, ends, budget, skip_bits, sets, links)
    return links


def _traverse(keys, bits, lo, hi, budget, skip_bits, sets, links) -> None:
    # A block: depth, nodes a and b (ranges) and their differing bits so far.
    none = np.zeros(len(lo), np.int8)
    stack = [(skip_bits, lo[s], hi[s], lo[s], hi[s], none[s])
             for s in (slice(at, at + FRONTIER) for at in range(0, len(lo), FRONTIER))]
    known = -1
    while stack:
        depth, alo, ahi, blo, bhi, e = stack.pop()
        if known != len(links):
            known = len(links)
            root = sets.flat()
            change = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
        # Two nodes whose keys all lie in one component need no visit.
        pure = ((change[ahi - 1] == change[alo]) & (change[bhi - 1] == change[blo])
                & (root[alo] == root[blo]))
        # Both nodes are one key each: compare the rest of the bits at once.
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        hit = leaf & ~pure
        if hit.any():
            a, b = alo[hit], blo[hit]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            links += sets.join(a[near], b[near])
        go = ~leaf & ~pure
        if depth >= BITS or not go.any():
            continue
        alo, ahi, blo, bhi, e = alo[go], ahi[go], blo[go], bhi[go], e[go]
        am, bm = bits.split(alo, ahi, depth), bits.split(blo, bhi, depth)
        two = (alo != blo) | (ahi != bhi)       # a node with itself: one mixed pair
        pairs = [(alo, am, blo, bm, e, None), (am, ahi, bm, bhi, e, None),
                 (alo, am, bm, bhi, e + 1, None), (am, ahi, blo, bm, e + 1, two)]
        cols: list[list] = [[], [], [], [], []]
        for al, ah, bl, bh, err, only in pairs:
            ok = (ah > al) & (bh > bl) & (err <= budget)
            if only is not None:
                ok &= only
            for c, v in zip(cols, (al, ah, bl, bh, err)):
                c.append(v[ok])
        al, ah, bl, bh, err = (np.concatenate(c) for c in cols)
        for at in range(0, len(al), FRONTIER):
            s = slice(at, at + FRONTIER)
            stack.append((depth + 1, al[s], ah[s], bl[s], bh[s], err[s]))


def _rotated(keys: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rotate each key by its own number of bits."""
    left = left.astype(np.uint64)
    right = (np.uint64(BITS) - left) % np.uint64(BITS)
    return np.where(left == 0, keys, (keys << left) | (keys >> right))


def _join_subtries(max_bits: int):
    """Joins the subtries of a partition, whose rows come sorted by subtrie
    (block, value, cell); up to about ``TASK_KEYS`` keys at a time."""
    width = BITS // (max_bits + 1)

    def join(block, value, cell, keys):
        if not len(keys):
            return None
        key = _rotated(keys.view(np.uint64), block * width)
        order = np.lexsort((key, cell, value, block))
        block, value, cell, key = block[order], value[order], cell[order], key[order]
        new = np.concatenate(([True], (block[1:] != block[:-1]) | (value[1:] != value[:-1])
                              | (cell[1:] != cell[:-1])))
        found = np.array(trie_links(key, np.flatnonzero(new), max_bits, width),
                         dtype=np.int64).reshape(-1, 2)
        back = _rotated(key, (BITS - block * width) % BITS).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(back[found[:, 0]]), pa.array(back[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(4)]
        for batch in batches:
            held = [np.concatenate((h, batch[c].to_numpy().astype(np.int64)))
                    for h, c in zip(held, ("block", "value", "cell", "key"))]
            if len(held[0]) >= TASK_KEYS:       # all but the last, open subtrie
                last = ((held[0] == held[0][-1]) & (held[1] == held[1][-1])
                        & (held[2] == held[2][-1]))
                if (out := join(*[h[~last] for h in held])) is not None:
                    yield out
                held = [h[last] for h in held]
        if (out := join(*held)) is not None:
            yield out
    return run


def near_links(keys: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (column ``key``,
    distinct longs, staged) within ``max_bits`` differing bits."""
    prepare(keys.sparkSession)
    blocks = max_bits + 1
    width = BITS // blocks
    value = [F.shiftrightunsigned("key", BITS - width * (i + 1))
             .bitwiseAND(F.lit((1 << width) - 1).cast("long")) for i in range(blocks)]
    rows = keys.select("key", F.posexplode(F.array(*value)).alias("block", "value"))
    hot = stage(rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > TASK_KEYS)
                .select(F.col("block").alias("_b"), F.col("value").alias("_v"),
                        F.ceil(2 * F.col("n") / TASK_KEYS).cast("int").alias("chunks")))
    n_hot = hot.count()
    if not n_hot:
        cells = rows.withColumn("cell", F.lit(0))
    else:
        # A hot subtrie is cut into chunks by hash; a cell is a pair of chunks,
        # so that every two keys meet in one cell and no cell is unbounded.
        k = F.col("chunks")
        own = F.pmod(F.xxhash64("key"), k).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), k - 1), lambda o: F.when(
            o == own, F.least(own, F.pmod(own + 1, k)) * k + F.greatest(own, F.pmod(own + 1, k)))
            .otherwise(F.least(o, own) * k + F.greatest(o, own)))
        cells = (rows.join(broadcast_if_small(hot, n_hot, 24),
                           (F.col("block") == F.col("_b")) & (F.col("value") == F.col("_v")),
                           "left")
                 .withColumn("cell", F.explode(F.when(k.isNull(), F.array(F.lit(0)))
                                               .otherwise(F.array_distinct(pairs)))))
    return (cells.select("block", "value", "cell", "key")
            .repartition("block", "value", "cell")
            .sortWithinPartitions("block", "value", "cell")
            .mapInArrow(_join_subtries(max_bits), "a long, b long"))


# ---------------------------------------------------------------- operators
def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id
    that links reach, the row's own included) for every row.

    A null or blank text has fingerprint 0 and links like any other.  Null
    ids count only when a component has no other id: component_id is then
    null.  Repeated rows are linked with each other.  An empty table gives an
    empty table.
    """
    prepare(docs.sparkSession)
    rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                             fingerprint_udf(shingle)(F.col(text_col)).alias("key")))
    return _label(rows, ["doc_id"], max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("key"), 16, "0")).alias("fingerprint"),
        F.col("low")["doc_id"].alias("component_id"))


def _label(rows: DataFrame, order: list[str], max_bits: int) -> DataFrame:
    """``rows`` (staged; a column ``key``) with ``low``: of the row's whole
    component, the smallest (is null, value) by ``order``."""
    first = F.min(F.struct(F.col(order[0]).isNull().alias("_null"), *order))
    nodes = stage(rows.groupBy("key").agg(first.alias("low")))
    roots = components(near_links(nodes.select("key"), max_bits))
    rooted = nodes.join(roots, F.col("key") == F.col("node"), "left") \
        .select("key", "low", F.coalesce("root", "key").alias("root"))
    linked = rooted.join(roots.select(F.col("root").alias("_r")).distinct(),
                         F.col("root") == F.col("_r"), "left_semi")
    lows = linked.groupBy(F.col("root").alias("_r")).agg(F.min("low").alias("_low"))
    labels = stage(rooted.join(lows, F.col("root") == F.col("_r"), "left")
                   .select("key", F.coalesce("_low", "low").alias("low")))
    return rows.join(labels, "key")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one document left of each component: the
    one with the smallest id (then the smallest text digest).  Rows that share
    id and text are one document and stay together."""
    prepare(docs.sparkSession)
    cols = docs.columns
    digest = F.coalesce(F.md5(F.coalesce(F.col(text_col), F.lit(""))), F.lit(""))
    rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("h"),
                             fingerprint_udf(shingle)(F.col(text_col)).alias("key")))
    keep = (_label(rows, ["doc_id", "h"], max_bits)
            .filter(F.col("doc_id").eqNullSafe(F.col("low")["doc_id"])
                    & (F.col("h") == F.col("low")["h"]))
            .select(F.col("doc_id").alias("_kid"), F.col("h").alias("_kh")).distinct())
    own = F.coalesce(F.md5(F.coalesce(field(text_col), F.lit(""))), F.lit(""))
    return (packed(docs).withColumn("_h", own).withColumn("_id", field(id_col).cast("long"))
            .join(keep, (F.col("_h") == F.col("_kh"))
                  & F.col("_id").eqNullSafe(F.col("_kid")), "left_semi")
            .select(*unpacked(cols)))
