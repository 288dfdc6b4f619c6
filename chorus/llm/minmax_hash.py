"""Near-duplicates by min-max hashing, every link confirmed on full sets.

A document's set holds the distinct hashes of its word shingles.  Each of
``PERMUTATIONS`` hash permutations is evaluated once per shingle, and both its
minimum and its maximum are kept: two signature values for one evaluation.
Each agrees between two sets with probability equal to their Jaccard
similarity, and as the two extremes of one permutation come from different
shingles, the estimate varies less than with as many independent minima.

``BANDS`` bands of ``ROWS`` values (never both values of one permutation) make
the buckets.  Two sets of similarity 0.8 miss all buckets with probability
(1 - 0.8 ** ROWS) ** BANDS, about 2e-6.

Equal sets are one node from the start.  Links between nodes are looked for in
rounds, each confirmed on the full sets, until the buckets hold no more:

- first, every node with the smallest node of its buckets (a bucket costs as
  many pairs as it has nodes; its smallest node comes from an aggregation, so
  a bucket may be of any size);
- then, only in buckets whose nodes still lie in several components, each node
  with its ``PARTNERS`` closest nodes of other components, by the share of
  equal signature bytes;
- last, in buckets whose nodes lie in several components even then, every
  similar pair of two components, in the tasks that hold the bucket's sets;
  they give only links that join two components.  Nodes of one component need
  no link between them, so a dense group yields few pairs, and no link between
  components is lost.

A bucket of more than ``TASK_NODES`` nodes, or of large sets, is cut into
chunks, and each pair of chunks is a task group, so no group is unbounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import broadcast_if_small, prepare, sorted_groups, stage
from chorus.llm.components import components

SEED = 42
PERMUTATIONS, BANDS, ROWS = 100, 25, 4
#: Nodes of one bucket, and values of their sets, that are compared in one group.
TASK_NODES, TASK_VALUES = 1024, 1 << 23
#: Share of equal signature bytes below which a pair is not confirmed, as a
#: distance from the similarity asked for: four standard deviations (a pair of
#: exactly 0.8 falls below it once in 30,000 times, a closer one less often).
SLACK = 0.115
#: Links that one task may join to components (16 bytes each).
LOCAL_LINKS = 1 << 20
#: Closest nodes that a node is compared with before all others of a bucket.
PARTNERS = 2
#: Shingles whose permutations are evaluated together; words remembered.
BLOCK, WORDS = 1 << 15, 1 << 20

_RNG = np.random.default_rng(SEED)
_XOR, _MUL = (_RNG.integers(0, 2 ** 64, PERMUTATIONS, dtype=np.uint64) for _ in range(2))
_MUL = _MUL | np.uint64(1)
_POSITION = _RNG.integers(0, 2 ** 64, 64, dtype=np.uint64) | np.uint64(1)

FEATURES = "struct<n:bigint,digest:binary,bands:array<bigint>,sketch:binary>"


# ------------------------------------------------------------- sets, signatures
class _Words(dict):
    """XXH64 of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, shingle: int, known: _Words) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles.  ASCII
    letters are lower-cased; words are runs without ASCII white space; a text
    of fewer than ``shingle`` words is one shingle; without words, none."""
    words = (text or b"").lower().split()        # bytes: ASCII rules only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += h[j:j + n] * _POSITION[j]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of each set (none empty) under each permutation:
    values 2p and 2p + 1 belong to permutation p."""
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= BLOCK):
            size += len(sets[to])
            to += 1
        # A set longer than a block is evaluated in pieces.
        pieces = [s[i:i + BLOCK] for s in sets[at:to] for i in range(0, len(s), BLOCK)]
        many = len(pieces) > to - at
        low, high = _extremes(pieces) if not many else (None, None)
        if many:                                 # one long set
            ends = [_extremes([p]) for p in pieces]
            low = np.min([e[0] for e in ends], axis=0)
            high = np.max([e[1] for e in ends], axis=0)
        out[at:to, 0::2], out[at:to, 1::2] = low, high
        at = to
    return out


def _extremes(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate(pieces)
    starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
    low = np.empty((len(pieces), PERMUTATIONS), np.uint64)
    high = np.empty_like(low)
    for p in range(PERMUTATIONS):
        x = (h ^ _XOR[p]) * _MUL[p]
        low[:, p] = np.minimum.reduceat(x, starts)
        high[:, p] = np.maximum.reduceat(x, starts)
    return low, high


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band; band j takes values j, j + BANDS, ..."""
    rows = values[:, :BANDS * ROWS].reshape(len(values), ROWS, BANDS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), BANDS))
    for r in range(ROWS):
        key = _mixed(key * _POSITION[r] + rows[:, r])
    return key


def features_udf(text: Column, shingle: int) -> Column:
    """Set size, a 128-bit digest of the set, band keys and one byte of each
    signature value; the last three are null for an empty set."""
    @F.arrow_udf(FEATURES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Words()
        for texts in batches:
            sets = [shingle_set(t.as_py(), shingle, known) for t in texts.cast(pa.binary())]
            full = [s for s in sets if len(s)]
            values = signatures(full)
            keys = band_keys(values).view(np.int64)
            some = np.array([len(s) > 0 for s in sets], bool)
            spread = np.cumsum(some) - 1
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in full]
            bytes_ = (values >> np.uint64(40)).astype(np.uint8)
            sketches = [row.tobytes() for row in bytes_]
            at = [int(k) if ok else None for k, ok in zip(spread, some)]
            offsets = np.concatenate(([0], np.cumsum(np.where(some, BANDS, 0))))
            yield pa.StructArray.from_arrays(
                [pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([None if k is None else digests[k] for k in at], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                          pa.array(keys.ravel(), pa.int64())),
                 pa.array([None if k is None else sketches[k] for k in at], pa.binary())],
                ["n", "digest", "bands", "sketch"])
    return run.asNondeterministic()(text)


# --------------------------------------------------------------- confirmation
def set_udf(text: Column, shingle: int) -> Column:
    """The whole shingle set of a text, as the bytes of its sorted hashes."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Words()
        for texts in batches:
            yield pa.array([shingle_set(t.as_py(), shingle, known).tobytes()
                            for t in texts.cast(pa.binary())], pa.binary())
    return run.asNondeterministic()(text)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two whole sorted sets."""
    both = np.sort(np.concatenate((x, y)), kind="stable")        # two sorted runs
    both = int((both[1:] == both[:-1]).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(percent: int):
    """Rows (a, b, left, right: the two whole sets) -> (a, b, linked)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [_linked(np.frombuffer(x.as_buffer(), np.uint64),
                              np.frombuffer(y.as_buffer(), np.uint64), percent)
                      for x, y in zip(batch["left"], batch["right"])]
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(linked, pa.bool_())], ["a", "b", "linked"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``, staged."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    return stage(pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
                 .mapInArrow(_confirm(percent), "a long, b long, linked boolean"))


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links (a, b) of a table -> (node, root)."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())],
        ["node", "root"])


def linked_components(links: DataFrame) -> DataFrame:
    """(node, root), staged.  A table of at most ``LOCAL_LINKS`` links, as
    counted, is one task's work; a larger one is contracted in rounds over the
    cluster.  Both give the same components."""
    links = stage(links)
    if links.count() <= LOCAL_LINKS:
        return stage(links.coalesce(1).mapInArrow(_union_find, "node long, root long"))
    return stage(components(links))


# ------------------------------------------------------ candidates in a bucket
class _Group:
    """The nodes of a bucket, or of two of its chunks, that lie in several
    components."""

    def __init__(self, rows: pa.Table, percent: int):
        self.node, self.n, self.chunk = (rows[c].to_numpy() for c in ("node", "n", "chunk"))
        self.comp = np.unique(rows["comp"].to_numpy(), return_inverse=True)[1]
        self.whole = bool(rows["whole"][0].as_py())
        self.sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()),
                                    np.uint8).reshape(len(self.node), -1)
        self.percent = percent
        self.need = (percent / 100 - SLACK) * self.sketch.shape[1]

    def similar(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(i, others, equal bytes): each node outside the largest component
        with the similar nodes of other components.  A pair of two chunks is
        their common cell's, a pair of one chunk its own cell's."""
        count = np.bincount(self.comp)
        if len(count) < 2:
            return
        for i in np.flatnonzero(self.comp != count.argmax()).tolist():
            # Sizes alone bound the similarity from above.
            low, high = np.minimum(self.n, self.n[i]), np.maximum(self.n, self.n[i])
            ok = (self.comp != self.comp[i]) & (100 * low >= self.percent * high)
            if not self.whole:
                ok &= self.chunk != self.chunk[i]
            j = np.flatnonzero(ok)
            same = (self.sketch[j] == self.sketch[i]).sum(axis=1)
            near = same >= self.need
            if near.any():
                yield i, j[near], same[near]


def _closest(percent: int):
    """Rows sorted by (key, cell) -> (a, b): each node with its closest nodes
    of other components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ["key", "cell"]):
            g = _Group(rows, percent)
            pairs = [(g.node[i], x) for i, j, same in g.similar()
                     for x in g.node[j[np.argsort(-same, kind="stable")[:PARTNERS]]]]
            x = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x.min(axis=1)),
                                              pa.array(x.max(axis=1))], ["a", "b"])
    return run


def _all_links(percent: int):
    """Rows sorted by (key, cell), with whole sets -> (a, b): links that join
    the group's components as far as its pairs do.  A pair is looked at in the
    first bucket that its nodes share, and only there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ["key", "cell"]):
            g = _Group(rows, percent)
            key = rows["key"][0].as_py()
            bands = np.array(rows["bands"].to_pylist(), np.int64)
            sets = [np.frombuffer(x, np.uint64) for x in rows["set"].to_pylist()]
            up = list(range(len(g.node)))

            def find(x: int) -> int:
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x
            links = []
            for i, others, _ in g.similar():
                first = (bands[others] == bands[i]).argmax(axis=1)
                for j in others[bands[i][first] == key].tolist():
                    x, y = find(int(g.comp[i])), find(int(g.comp[j]))
                    if x != y and _linked(sets[i], sets[j], percent):
                        up[x] = y
                        links.append((g.node[i], g.node[j]))
            x = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
    return run


def _in_buckets(comps: DataFrame, members: DataFrame, carried: DataFrame) -> DataFrame:
    """The nodes of buckets with several components, sorted by (key, cell),
    with the columns of ``carried`` (node, n, ...).  A bucket of many nodes or
    large sets is cut into chunks by hash; each two chunks, and each chunk with
    itself (``whole``), are a cell."""
    named = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per = stage(named.join(carried.select("node", "n"), "node").groupBy("key").agg(
        F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.sum("n").alias("_values"))
        .filter("_lo <> _hi").select("key", F.greatest(
            F.ceil(2 * F.col("_n") / TASK_NODES), F.ceil(2 * F.col("_values") / TASK_VALUES))
            .cast("int").alias("chunks")))
    k = F.col("chunks")
    own = F.pmod(F.xxhash64("node"), k).cast("int")
    cells = F.transform(F.sequence(F.lit(0), k - 1),
                        lambda o: F.least(o, own) * k + F.greatest(o, own))
    rows = (named.join(per.withColumn("chunks", F.when(k > 2, k).otherwise(1)), "key")
            .select("key", "node", "comp", own.alias("chunk"), (own * k + own).alias("_own"),
                    F.explode(cells).alias("cell")))
    return (rows.join(carried, "node").withColumn("whole", F.col("cell") == F.col("_own"))
            .drop("_own").repartition("key", "cell").sortWithinPartitions("key", "cell"))


# -------------------------------------------------------------------- operator
def near_components(nodes: DataFrame, sets_of, percent: int) -> DataFrame:
    """(node, root) for every node with a link; root is the same for exactly
    the nodes that links of at least ``percent`` connect.  ``nodes`` (node, n,
    bands, sketch) is staged; ``sets_of`` gives (node, set) for a table of
    nodes."""
    every = nodes.select("node", F.explode("bands").alias("key"))
    lead = (every.groupBy("key").agg(F.min("node").alias("top"), F.count(F.lit(1)).alias("many"))
            .filter("many > 1").select("key", "top"))
    starred = stage(every.join(lead, "key").select("key", "node", "top"))
    members = starred.select("key", "node")
    sets = stage(sets_of(starred.select("node").distinct()))
    # Of the smallest nodes of its buckets, the one that a node meets most.
    star = (starred.filter("node <> top").groupBy("node", "top")
            .agg(F.count(F.lit(1)).alias("shared"))
            .groupBy("node").agg(F.max_by("top", "shared").alias("top")))
    tested = _confirmed(star.select(F.col("top").alias("a"), F.col("node").alias("b")),
                        sets, percent)
    # At first only the stars' links count as components: a finer division
    # than the components, so no pair between components is left out.
    up = tested.filter("linked").select(F.col("b").alias("node"), F.col("a").alias("comp"))
    above = up.select(F.col("node").alias("comp"), F.col("comp").alias("_above"))
    comps = up.join(above, "comp", "left").select(
        "node", F.coalesce("_above", "comp").alias("comp"))
    carried = nodes.select("node", "n", "sketch")
    pairs = _in_buckets(comps, members, carried).mapInArrow(_closest(percent), "a long, b long")
    tested = tested.union(_confirmed(
        pairs.distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti"), sets, percent))
    roots = linked_components(tested.filter("linked").select("a", "b"))
    comps = roots.select("node", F.col("root").alias("comp"))
    # What still lies in several components: every similar pair is looked at.
    rest = _in_buckets(comps, members, nodes.select("node", "n", "bands", "sketch")
                       .join(sets, "node"))
    links = stage(rest.mapInArrow(_all_links(percent), "a long, b long"))
    if not links.limit(1).count():
        return roots
    return linked_components(tested.filter("linked").select("a", "b").union(links))


def minmax_components(docs: DataFrame, shingle: int = 5, percent: int = 80,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles (size of the set of distinct shingles), component_id
    (the smallest id that links reach, the row's own included) and kept (the
    row's id is the component's) for every row.

    Two sets are linked when 100 * intersection >= ``percent`` * union, counted
    on 64-bit hashes of all shingles.  A text of fewer than ``shingle`` words is
    one shingle.  Null, empty and blank texts have an empty set and are linked
    with nothing.  Null ids count only when a component has no other id:
    component_id is then null.  Repeated rows are linked with each other and
    share their fate.  A very long text is one task's work, in memory
    proportional to it.  Other columns are not read, whatever their names.  An
    empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    made = stage(rows.select("doc_id", F.xxhash64("text").alias("th"),
                             features_udf(F.col("text"), shingle).alias("f"))
                 .select("doc_id", "th", "f.*"))
    low = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    # Numbered and staged in one step: the numbers stay as they were written.
    nodes = stage(made.filter("n > 0").groupBy("digest").agg(
        F.min(low).alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """The set of each wanted node, from the text of its smallest row."""
        named = stage(nodes.join(wanted, "node", "left_semi").select(
            "node", F.col("low.doc_id").alias("_d"), F.col("low.th").alias("_t")))
        named = broadcast_if_small(named, named.count(), 64)
        return (rows.join(named, (F.xxhash64("text") == F.col("_t"))
                          & F.col("doc_id").eqNullSafe(F.col("_d")))
                .select("node", set_udf(F.col("text"), shingle).alias("set"))
                .dropDuplicates(["node"]))

    roots = near_components(nodes, sets_of, percent)
    named = nodes.select("digest", "node", "low").join(roots, "node", "left")
    lows = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("_low"))
    label = (named.join(lows, "root", "left")
             .select("digest", F.coalesce("_low", "low")["doc_id"].alias("component_id")))
    return (made.select("doc_id", "n", "digest").join(label, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
