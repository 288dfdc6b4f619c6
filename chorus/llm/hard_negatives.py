"""Hard-negative mining by Fagin's threshold algorithm on integer vectors.

Components become floor(scale * x); a score is the integer inner product, so
results are exact and the same on every machine.  For each anchor: its best
rows of the same label are its positives; for each positive, the best rows of
other labels whose score lies between ``low`` and ``high`` percent of the
positive's.

Rows are dealt by hash into blocks of about ``BLOCK_VALUES`` components, the
anchors into chunks of the same size; every anchor meets every block in one
cell.  (Anchors are a query set given by the caller; rows never meet rows.)
In a cell:

- the block's rows are sorted once per dimension: the candidate lists;
- an anchor reads all lists in step, from the top where its component is
  positive and from the bottom where it is negative;
- a row met for the first time in any list is fetched and scored whole;
- the threshold is the anchor's product with the last values read: no unread
  row scores more.  The anchor is done when the threshold is strictly below
  the k-th score of each of its windows (or below the window): a row not read
  could not even tie.

The best of every block are ranked together on Spark: k rows per window and
block at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorus.llm.common import prepare, sorted_groups, stage

SCALE = 256
#: Components in a block of rows, and in a chunk of anchors.
BLOCK_VALUES = 1 << 18
#: List entries read at first; doubled after every look at the threshold.
FIRST_DEPTH = 16
#: Largest component after scaling: products of 2 ** 15 of them fit a long.
LARGEST = 1 << 24

POSITIVE = "anchor binary, anchor_id long, id long, score long"
NEGATIVE = "anchor binary, anchor_id long, place int, positive_id long, " \
           "positive_score long, id long, score long"


# ------------------------------------------------------- threshold algorithm
class Lists:
    """The rows of a block with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def best(self, anchor: np.ndarray, allowed: np.ndarray,
             windows: list[tuple[int | None, int | None]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (lowest, highest score; None: open) the first k
        (score, id) of the rows in ``allowed``, highest score first, ties by
        smaller id."""
        m = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(m, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, depth = 0, FIRST_DEPTH
        while at < m:
            to = min(m, depth)
            if len(up) + len(down):
                met = np.zeros(m, bool)
                met[self.order[m - to:m - at, up]] = True
                met[self.order[at:to, down]] = True
                # No unread row scores more than this.
                threshold = int(self.values[m - to, up] @ anchor[up]
                                + self.values[to - 1, down] @ anchor[down])
            else:
                met, to, threshold = np.ones(m, bool), m, 0
            fresh = np.flatnonzero(met & ~seen & allowed)
            seen |= met
            rows = np.concatenate((rows, fresh))
            scores = np.concatenate((scores, self.vectors[fresh] @ anchor))
            at, depth = to, 2 * depth
            if at >= m or all(self._closed(scores, w, k, threshold) for w in windows):
                break
        return [self._first(rows, scores, w, k) for w in windows]

    @staticmethod
    def _inside(scores, window):
        low, high = window
        ok = np.ones(len(scores), bool)
        if low is not None:
            ok &= scores >= low
        if high is not None:
            ok &= scores <= high
        return ok

    def _closed(self, scores, window, k, threshold) -> bool:
        if window[0] is not None and threshold < window[0]:
            return True
        s = scores[self._inside(scores, window)]
        return len(s) >= k and threshold < np.partition(s, len(s) - k)[len(s) - k]

    def _first(self, rows, scores, window, k):
        ok = self._inside(scores, window)
        s, ids = scores[ok], self.ids[rows[ok]]
        first = np.lexsort((ids, -s))[:k]
        return list(zip(s[first].tolist(), ids[first].tolist()))


def window_of(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * p <= 100 * s <= high * p."""
    return -((-low * positive_score) // 100), (high * positive_score) // 100


def _in_cells(work):
    """Each cell's block (rows with ``chunked`` false) with its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_groups(batches, ["dims", "block", "chunk"]):
            dims = cell["dims"][0].as_py()
            vectors = np.concatenate(
                [c.values.to_numpy()[c.offsets[0].as_py():c.offsets[-1].as_py()]
                 for c in cell["v"].chunks]).astype(np.int64).reshape(-1, dims)
            anchors = cell["is_anchor"].to_numpy()
            n = int((~anchors).sum())                   # rows sort before anchors
            if 0 < n < len(cell):
                ids = cell["id"].to_numpy()
                labels = np.unique(cell["label"].to_numpy().astype(str), return_inverse=True)[1]
                yield work(Lists(ids[:n], labels[:n], vectors[:n]), cell.slice(n),
                           vectors[n:], labels[n:], ids[n:])
    return run


def _positives(k: int):
    def work(lists: Lists, anchors: pa.Table, vectors, labels, ids) -> pa.RecordBatch:
        out = []
        for key, v, label, own in zip(anchors["row"].to_pylist(), vectors, labels, ids.tolist()):
            same = (lists.labels == label) & (lists.ids != own)
            if same.any():
                for score, i in lists.best(v, same, [(None, None)], k)[0]:
                    out.append((key, own, i, score))
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary())] + [pa.array(c, pa.int64()) for c in cols[1:]],
            ["anchor", "anchor_id", "id", "score"])
    return _in_cells(work)


def _negatives(k: int, low: int, high: int):
    def work(lists: Lists, anchors: pa.Table, vectors, labels, ids) -> pa.RecordBatch:
        out = []
        for key, v, label, own, positives in zip(
                anchors["row"].to_pylist(), vectors, labels, ids.tolist(),
                anchors["positives"].to_pylist()):
            spans = [window_of(p["score"], low, high) for p in positives]
            asked = [(p, s) for p, s in zip(positives, spans) if s[0] <= s[1]]
            other = lists.labels != label
            if asked and other.any():
                found = lists.best(v, other, [s for _, s in asked], k)
                for (p, _), rows in zip(asked, found):
                    out += [(key, own, p["place"], p["id"], p["score"], i, s) for s, i in rows]
        cols = list(zip(*out)) or [()] * 7
        kinds = [pa.binary(), pa.int64(), pa.int32()] + [pa.int64()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)],
            ["anchor", "anchor_id", "place", "positive_id", "positive_score", "id", "score"])
    return _in_cells(work)


# -------------------------------------------------------------------- operator
def _rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v, dims, row) of the rows that take part, each once; ``row``
    names a row by its contents."""
    x = F.col(f"`{vec_col}`")
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fine = F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) * scale < LARGEST), F.lit(False)))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                           F.col(f"`{label_col}`").cast("string").alias("label"),
                           F.when(fine, whole).alias("v"))
            .filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
            .withColumn("dims", F.size("v"))
            .filter(F.col("dims") > 0)
            .withColumn("row", F.unhex(F.md5(F.to_json(F.struct("id", "label", "v")))))
            .dropDuplicates(["row"]))


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int,
           positives: bool) -> DataFrame:
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    kind = "array<struct<place:int,id:bigint,score:bigint>>"
    asked = F.col("positives") if positives else F.lit(None)
    a = anchors.select("dims", "id", "label", "row", "v", F.lit(True).alias("is_anchor"),
                       asked.cast(kind).alias("positives"),
                       dealt(chunks).alias("chunk"), each(blocks).alias("block"))
    r = rows.select("dims", "id", "label", "row", "v", F.lit(False).alias("is_anchor"),
                    F.lit(None).cast(kind).alias("positives"),
                    each(chunks).alias("chunk"), dealt(blocks).alias("block"))
    keys = ["dims", "block", "chunk"]
    return r.unionByName(a).repartition(*keys).sortWithinPartitions(*keys, "is_anchor")


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5,
                   n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
                   id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score: for each anchor (rows where ``anchors``, a condition on
    the column ``id``, holds) and each of its first ``n_positives`` rows of the
    same label and another id, the first ``n_negatives`` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score.
    Higher scores come first, ties by smaller id.

    Rows with a null id or label, a null or empty vector, a null or non-finite
    component, or a component of 2 ** 24 or more after scaling take no part.
    Vectors of different lengths are not compared.  Repeated rows count once;
    rows that share an id but not the contents are rows of their own.  Windows
    of a negative positive_score are empty.  Other columns are not read,
    whatever their names.  An empty table gives an empty table.
    """
    prepare(vectors.sparkSession)
    rows = stage(_rows(vectors, id_col, vec_col, label_col, scale))
    asked = rows.filter(anchors)
    n, widest = rows.agg(F.count(F.lit(1)), F.max("dims")).first()
    per = max(1, BLOCK_VALUES // (widest or 1))
    blocks, chunks = -(-max(n, 1) // per), -(-max(asked.count(), 1) // per)

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    positives = (_cells(rows, asked, blocks, chunks, False)
                 .mapInArrow(_positives(n_positives), POSITIVE)
                 .withColumn("place", F.row_number().over(best))
                 .filter(F.col("place") <= n_positives)
                 .groupBy("anchor").agg(F.collect_list(
                     F.struct("place", "id", "score")).alias("positives")))
    asked = stage(asked.join(positives, asked["row"] == positives["anchor"]).drop("anchor"))

    ranked = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return (_cells(rows, asked, blocks, chunks, True)
            .mapInArrow(_negatives(n_negatives, low, high), NEGATIVE)
            .withColumn("rank", F.row_number().over(ranked))
            .filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
