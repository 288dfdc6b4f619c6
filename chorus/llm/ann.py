"""Nearest neighbours by multiprobe p-stable hashing.

Inner products become distances by the usual lift: a base vector x is scaled
by the largest norm M and given the coordinate sqrt(1 - |x|^2 / M^2), a query
is scaled to length one and given 0; the nearest lifted vector has the
largest inner product.  A table hashes a vector to the ``k`` integers
``floor((a . x + b) / w)`` with Gaussian a (2-stable).  A query visits, in
each table, its own bucket and the perturbed buckets in the order of their
estimated success (the squared distances from the query's projections to the
slot borders, added over the perturbed slots).  Candidates of all tables are
reranked by the exact inner product of the original vectors and merged.

Equal vectors are one entry of the index, with the ``k_nearest`` + 1 smallest
ids: more of its copies can never be in a result.  Buckets are cut into
blocks of about ``BLOCK`` entries that different tasks may hold.  A query
that finds too few candidates is searched again against every block, so a
small table gives all its candidates.

The number of hash functions and of probes is fitted on some of the queries
and their true neighbours in the whole table.  When no number of hash
functions reaches ``AIM`` within ``MAX_PROBES``, every query is searched
against every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chorus.llm.common import prepare, stage

TABLES = 4
#: Expected entries of a bucket that a query meets in one table.
BUCKET = 2048
#: Entries of one block.
BLOCK = 4096
#: The index is fitted on at most about this many vectors and queries.
SAMPLE, SAMPLE_QUERIES = 4096, 128
#: Share of the sampled queries' true neighbours that the probes must reach.
AIM = 0.985
#: Most probes per table; fewer hash functions are used when more are needed.
MAX_PROBES = 512
#: Slot width in standard deviations of a projection of the (lifted) vectors.
WIDTH = 1.5


@dataclass(frozen=True)
class Index:
    """The fitted hash functions: A (tables, k, dim + 1), b, w, probes, M."""
    a: np.ndarray
    b: np.ndarray
    w: float
    probes: int
    norm: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]])

    def lift_query(self, q: np.ndarray) -> np.ndarray:
        q = q / np.abs(q).max(axis=1)[:, None]          # no overflow in the norm
        q = q / np.linalg.norm(q, axis=1)[:, None]
        return np.hstack([q, np.zeros((len(q), 1))])

    def slots(self, lifted: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Slot numbers and positions within the slots (0 to 1)."""
        f = (lifted @ self.a[table].T + self.b[table]) / self.w
        low = np.floor(f)
        return low.astype(np.int64), f - low

    def perturbations(self, inside: np.ndarray, n: int) -> np.ndarray:
        """For each query the ``n`` perturbations (-1, 0, 1 per slot) of least
        score, in order.  Scores add up over slots, so the best n over the
        first j slots extend only best n over the first j - 1."""
        q, k = inside.shape
        score = np.zeros((q, 1))
        moves = np.zeros((q, 1, 0), np.int8)
        for j in range(k):
            x = inside[:, j, None]
            grown = np.concatenate([score, score + x ** 2, score + (1 - x) ** 2], axis=1)
            width = score.shape[1]
            pick = np.argsort(grown, axis=1, kind="stable")[:, :n]
            score = np.take_along_axis(grown, pick, axis=1)
            step = np.array([0, -1, 1], np.int8)[pick // width]
            before = np.take_along_axis(moves, (pick % width)[:, :, None], axis=1)
            moves = np.concatenate([before, step[:, :, None]], axis=2)
        return moves


def bucket_keys(table: int, slots: np.ndarray) -> np.ndarray:
    """One long per row of slot numbers (equal slots, equal key)."""
    h = np.full(slots.shape[:-1], 1469598103934665603 + table, np.uint64)
    for j in range(slots.shape[-1]):
        h = (h ^ slots[..., j].astype(np.int64).view(np.uint64)) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def fit(sample: np.ndarray, n: int, norm: float, queries: np.ndarray,
        near: list[np.ndarray], seed: int = 7) -> Index | None:
    """Hash functions for ``n`` entries, fitted on a bounded ``sample`` of
    them and on ``queries`` with the vectors of their true neighbours ``near``.

    ``k`` starts at the smallest number of hash functions for which a sample
    vector meets at most ``BUCKET`` of ``n`` entries and falls until at most
    ``MAX_PROBES`` buckets per table reach ``AIM`` of the neighbours;
    ``probes`` is the smallest number that does.  None when no ``k`` does.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    blank = Index(np.zeros((0, 0, 0)), np.zeros((0, 0)), 1.0, 1, norm)
    lifted = blank.lift(sample)
    directions = rng.standard_normal((TABLES, 40, dim + 1))
    spread = float(np.std(lifted @ directions[0].T, axis=0).mean()) or 1.0
    w = WIDTH * spread
    offsets = rng.uniform(0, w, (TABLES, 40))
    for most in range(2, 41):
        index = Index(directions[:, :most], offsets[:, :most], w, 1, norm)
        slots, _ = index.slots(lifted, 0)
        _, size = np.unique(bucket_keys(0, slots), return_counts=True)
        if float((size.astype(float) ** 2).sum()) / len(sample) ** 2 * n <= BUCKET:
            break
    asked = [i for i, x in enumerate(near) if len(x)]
    if not asked:
        return index
    ql = blank.lift_query(queries[asked])
    theirs = [blank.lift(near[i]) for i in asked]
    for k in range(most, 0, -1):
        index = Index(directions[:, :k], offsets[:, :k], w, 1, norm)
        most_probes = min(MAX_PROBES, 3 ** k)
        ranks = [np.full(len(x), most_probes) for x in theirs]
        for t in range(TABLES):
            base, inside = index.slots(ql, t)
            moves = index.perturbations(inside, most_probes)
            for i, x in enumerate(theirs):
                delta = index.slots(x, t)[0] - base[i]
                hit = (moves[i][None, :, :] == delta[:, None, :]).all(axis=2)
                ranks[i] = np.minimum(ranks[i], np.where(
                    hit.any(axis=1), hit.argmax(axis=1), most_probes))
        every = np.sort(np.concatenate(ranks))
        probes = int(every[int(np.ceil(AIM * len(every))) - 1]) + 1
        if probes <= most_probes:
            return Index(index.a, index.b, w, probes, norm)
    return None


def usable(vec: Column, dim: int | None = None) -> Column:
    """True for a vector that takes part: not null, no null or non-finite
    component, not all zero (and of length ``dim``)."""
    finite = F.forall(vec, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    ok = vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)
    return F.coalesce(ok if dim is None else ok & (F.size(vec) == dim), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _best(queries: np.ndarray, keep: int, dim: int):
    """The ``keep`` best rows of each partition for each of a few queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(queries), 0))
        vecs = np.zeros((len(queries), 0, dim))
        for batch in batches:
            whole = _matrix(batch["vec"], dim)
            for at in range(0, len(whole), 4096):
                base = whole[at:at + 4096]
                new = queries @ base.T
                pick = np.argsort(-new, axis=1, kind="stable")[:, :keep]
                score = np.hstack([score, np.take_along_axis(new, pick, axis=1)])
                vecs = np.concatenate([vecs, base[pick]], axis=1)
                pick = np.argsort(-score, axis=1, kind="stable")[:, :keep]
                score = np.take_along_axis(score, pick, axis=1)
                vecs = np.take_along_axis(vecs, pick[:, :, None], axis=1)
        if score.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(queries)), score.shape[1]), pa.int32()),
                 pa.array(score.ravel(), pa.float64()),
                 pa.array(vecs.reshape(-1, dim).tolist(), pa.list_(pa.float64()))],
                ["query", "score", "vec"])
    return run


def true_neighbours(entries: DataFrame, queries: np.ndarray, k_nearest: int,
                    dim: int) -> list[np.ndarray]:
    """The vectors of the ``k_nearest`` best entries of each of a few queries
    by brute force over all entries, the query's own vector left out."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    rows = (entries.select("vec").mapInArrow(
                _best(queries, k_nearest + 1, dim),
                "query int, score double, vec array<double>")
            .withColumn("_r", F.row_number().over(best))
            .filter(F.col("_r") <= k_nearest + 1).orderBy("query", "_r").collect())
    near: list[list] = [[] for _ in queries]
    for r in rows:
        if r["vec"] != queries[r["query"]].tolist() and len(near[r["query"]]) < k_nearest:
            near[r["query"]].append(r["vec"])
    return [np.array(x, np.float64).reshape(-1, dim) for x in near]


def _hash_entries(index: Index, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lifted = index.lift(_matrix(batch["vec"], dim))
            for t in range(len(index.a)):
                slots, _ = index.slots(lifted, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_keys(t, slots)), batch["entry"], batch["vec"]],
                    ["bucket", "entry", "vec"])
    return run


def _probe(index: Index, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                vec = pa.array(batch["vec"].to_pylist(), batch["vec"].type)
                lifted = index.lift_query(_matrix(vec, dim))
                for t in range(len(index.a)):
                    base, inside = index.slots(lifted, t)
                    moves = index.perturbations(inside, index.probes)
                    keys = bucket_keys(t, base[:, None, :] + moves)
                    who = np.repeat(np.arange(len(base)), keys.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), batch["query_id"].take(pa.array(who)),
                         vec.take(pa.array(who))], ["bucket", "query_id", "vec"])
    return run


def _rerank(k_nearest: int, dim: int):
    """Rows sorted by block, entries before queries: each block of entries is
    multiplied with its queries; the best ``k_nearest`` + 1 entries per query
    are merged over the whole partition before they leave it."""
    keep = k_nearest + 1

    def merged(found: list) -> list:
        q, e, s = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((e, q))
        q, e, s = q[order], e[order], s[order]
        new = np.concatenate(([True], (q[1:] != q[:-1]) | (e[1:] != e[:-1])))
        q, e, s = q[new], e[new], s[new]
        order = np.lexsort((e, -s, q))
        q, e, s = q[order], e[order], s[order]
        first = np.concatenate(([0], np.flatnonzero(q[1:] != q[:-1]) + 1))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        return [(q[rank < keep], e[rank < keep], s[rank < keep])]

    def search(entries, base, queries, vecs):
        out = []
        for at in range(0, len(queries), 512):
            score = vecs[at:at + 512] @ base.T
            n = min(keep, score.shape[1])
            # Ties at the cut are all kept; the merge orders them.
            cut = -np.partition(-score, n - 1, axis=1)[:, n - 1]
            i, j = np.nonzero(score >= cut[:, None])
            out.append((queries[at:at + 512][i], entries[j], score[i, j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, entries, base, found, held = None, None, None, [], 0
        asked: list = []

        def flush():
            nonlocal found, held, asked
            if asked and base is not None:
                ids, vecs = (np.concatenate(c) for c in zip(*asked))
                found += search(entries, base, ids, vecs)
                if sum(len(f[0]) for f in found) > 500_000 + 2 * held:
                    found = merged(found)
                    held = len(found[0][0])
            asked = []

        for batch in batches:
            if not batch.num_rows:
                continue
            vec = _matrix(batch["vec"], dim)
            ids = batch["id"].to_numpy()
            kind = batch["kind"].to_numpy()
            key = np.stack([batch["bucket"].to_numpy(), batch["block"].to_numpy()], axis=1)
            new = np.concatenate(([0], np.flatnonzero(
                (key[1:] != key[:-1]).any(axis=1) | (kind[1:] != kind[:-1])) + 1, [len(ids)]))
            for a, b in zip(new[:-1], new[1:]):
                k = (int(key[a, 0]), int(key[a, 1]))
                if k != now:
                    flush()
                    now, entries, base = k, None, None
                if kind[a] == 0:
                    entries = ids[a:b] if entries is None else np.concatenate((entries, ids[a:b]))
                    base = vec[a:b] if base is None else np.concatenate((base, vec[a:b]))
                elif base is not None:
                    asked.append((ids[a:b], vec[a:b]))
                    if sum(len(x[0]) for x in asked) >= 4096:
                        flush()
        flush()
        if found:
            q, e, s = merged(found)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(e, pa.int64()), pa.array(s, pa.float64())],
                ["query_id", "entry", "score"])
    return run


def _search(entries: DataFrame, probes: DataFrame, k_nearest: int, dim: int) -> DataFrame:
    """(query_id, entry, score): entries in (bucket, block, id, vec) against
    the queries that visit the same (bucket, block)."""
    rows = (entries.select("bucket", "block", F.lit(0).alias("kind"), "id", "vec")
            .unionByName(probes.select("bucket", "block", F.lit(1).alias("kind"), "id", "vec")))
    return (rows.repartition("bucket", "block")
            .sortWithinPartitions("bucket", "block", "kind", "id")
            .mapInArrow(_rerank(k_nearest, dim), "query_id long, entry long, score double"))


def _search_all(entries: DataFrame, queries: DataFrame, n: int, k_nearest: int,
                dim: int) -> DataFrame:
    """(query_id, entry, score): every query against every block."""
    cuts = max(1, -(-n // BLOCK))
    every = entries.select(F.lit(-1).cast("long").alias("bucket"),
                           F.pmod(F.xxhash64("entry"), F.lit(cuts)).cast("int").alias("block"),
                           F.col("entry").alias("id"), "vec")
    asked = queries.select(F.lit(-1).cast("long").alias("bucket"),
                           F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))).alias("block"),
                           F.col("query_id").alias("id"), "vec")
    return _search(every, asked, k_nearest, dim)


def _ranked(hits: DataFrame, copies: DataFrame, k_nearest: int) -> DataFrame:
    """The ``k_nearest`` best rows of each query.  Hits are first cut to the
    best entries, then entries become the rows that hold them."""
    top = (hits.dropDuplicates(["query_id", "entry"])
           .withColumn("_r", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
           .filter(F.col("_r") <= k_nearest + 1).drop("_r"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (top.join(copies, "entry").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(final))
            .filter(F.col("rank") <= k_nearest)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, is_query: Column, k_nearest: int = 20,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k_nearest`` rows of largest inner
    product (double precision) found for each query row, nearest first, ties
    to the smaller id.

    ``is_query`` is a condition on ``id_col``.  Rows of a query's own id are
    never its neighbours.  Rows without an id, and vectors that are null, zero
    or hold a null or non-finite component, take no part.  Vectors of each
    length are searched among themselves, with an index of their own.  Repeated
    rows count once; rows that share an id but not the vector are candidates
    of their own.  Of different query vectors under one id the smallest (as an
    array, shorter lengths apart) is used per length.  Other columns are not
    read, whatever their names.  An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = (vectors
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                    F.col(f"`{vec_col}`").cast("array<double>").alias("vec"),
                    F.coalesce(is_query, F.lit(False)).alias("asked"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))))
    # One row per vector length.
    lengths = sorted(r["dim"] for r in rows.select(F.size("vec").alias("dim")).distinct().collect())
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim in lengths:
        found = _nearest_of_length(rows.filter(F.size("vec") == dim), dim, k_nearest)
        out = found if len(lengths) == 1 else out.unionByName(found)
    return out


def _nearest_of_length(rows: DataFrame, dim: int, k_nearest: int) -> DataFrame:
    """:func:`nearest` among vectors of one length."""
    # One entry per distinct vector, with a number of its own (staged, so that
    # it stays); of its rows the smallest ids.  The limit is applied before and
    # after the shuffle.
    copy = Window.partitionBy("vec").orderBy("vec_id")
    ids = stage(rows.select("vec_id", "vec").distinct()
                .withColumn("_c", F.row_number().over(copy))
                .filter(F.col("_c") <= k_nearest + 1))
    entries = stage(ids.filter("_c = 1").select(
        F.monotonically_increasing_id().alias("entry"), "vec"))
    copies = ids.join(entries, "vec").select("entry", "vec_id")
    size2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, norm = entries.agg(F.count(F.lit(1)), F.sqrt(F.max(size2))).first()
    sample = np.array([r["vec"] for r in entries.filter(
        F.pmod(F.xxhash64("vec"), F.lit(max(1, -(-n // SAMPLE)))) == 0)
        .orderBy(F.xxhash64("vec", F.lit(1)), "vec").limit(2 * SAMPLE).collect()], np.float64)
    if not len(sample):
        sample = np.array([entries.orderBy("vec").first()["vec"]], np.float64)
    queries = stage(rows.filter("asked").select(F.col("vec_id").alias("query_id"), "vec")
                    .groupBy("query_id").agg(F.min("vec").alias("vec")))
    some = np.array([r["vec"] for r in queries.orderBy(F.xxhash64("query_id"), "query_id")
                     .limit(SAMPLE_QUERIES).collect()], np.float64).reshape(-1, dim)
    if not len(some):
        return queries.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    index = fit(sample, n, norm, some, true_neighbours(entries, some, k_nearest, dim))
    if index is None:
        return _ranked(_search_all(entries, queries, n, k_nearest, dim), copies, k_nearest)

    hashed = entries.mapInArrow(
        _hash_entries(index, dim), "bucket long, entry long, vec array<double>")
    blocks = hashed.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = stage(blocks)
    own_block = F.pmod(F.xxhash64("entry"), F.coalesce("blocks", F.lit(1))).cast("int")
    split = blocks.filter("blocks > 1")       # at most tables * entries / BLOCK rows
    placed = (hashed.join(split, "bucket", "left")
              .select("bucket", own_block.alias("block"), F.col("entry").alias("id"), "vec"))
    visits = (queries.mapInArrow(_probe(index, dim),
                                 "bucket long, query_id long, vec array<double>")
              .join(blocks, "bucket")
              .select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                      F.col("query_id").alias("id"), "vec"))
    hits = stage(_search(placed, visits, k_nearest, dim))

    # Queries short of candidates (isolated ones, small tables): every block.
    enough = min(k_nearest + 1, n)
    met = hits.groupBy("query_id").agg(F.countDistinct("entry").alias("n")) \
        .filter(F.col("n") >= enough)
    short = stage(queries.join(met, "query_id", "left_anti"))
    if short.limit(1).count():
        hits = hits.unionByName(_search_all(entries, short, n, k_nearest, dim))
    return _ranked(hits, copies, k_nearest)
