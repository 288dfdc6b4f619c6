"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of each text; a chunk ends where its low
bits are zero, so borders depend on the last ``WINDOW`` bytes only and an
insertion shifts no border beyond its surroundings.  Chunks are named by
their digest; of equal chunks those in the document with the smallest id stay.
Neighbouring repeated chunks with one keeper form a piece, extended at both ends
as far as the text equals the keeper's.  Pieces that touch form a run, whatever
their keepers, and the length limit holds for the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chorus.llm.common import field, packed, prepare, unpacked

#: Bytes that a border depends on.
WINDOW = 32
#: Shortest chunk but for a text's last.
MIN_CHUNK = 16
#: A border every 2**MASK_BITS bytes on average, beyond the shortest chunk.
MASK_BITS = 4
#: Longest chunk.
MAX_CHUNK = 256
#: Shortest run that is reported: below 51 words of one letter each.
MIN_SPAN = 100
#: Code points on either side of a piece that are compared with the keeper's;
#: borders of equal texts meet again after few chunks.
REACH = 4 * MAX_CHUNK
#: Blocks of documents, by doc_key: a block number is a short name of a document
#: that travels with each of its chunks.
BLOCKS = 1 << 20
#: Bytes hashed at a time.
BLOCK = 1 << 22

GEAR = np.random.default_rng(20240229).integers(0, 2 ** 32, 256, dtype=np.uint32)
# Low bits of the plain gear hash depend on few bytes; the test is on the high
# ones, which depend on all WINDOW bytes.
_SHIFT = np.uint32(32 - MASK_BITS)


def gear_hash(x: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[x[i - k]] << k for k < 32 (mod 2**32), by doubling:
    the sum over 2n bytes is two sums over n bytes, one of them shifted."""
    h = GEAR[x]
    n = 1
    while n < WINDOW:
        later = h.copy()
        later[n:] += h[:-n] << np.uint32(n)
        h = later
        n *= 2
    return h


def borders(x: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes: candidate borders, taken from
    left to right under the shortest and longest chunk, never inside a
    character."""
    n = len(x)
    found = []
    for at in range(0, n, BLOCK):
        back = min(WINDOW, at)
        h = gear_hash(x[at - back:at + BLOCK])[back:]
        found.append(np.flatnonzero((h >> _SHIFT) == 0) + at + 1)
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    starts_character = np.append((x & 0xC0) != 0x80, True)
    ends = ends[starts_character[ends]]
    out, start = [], 0
    for e in ends.tolist():
        while e - start > MAX_CHUNK:
            start = _cut(starts_character, start + MAX_CHUNK)
            out.append(start)
        if e - start >= MIN_CHUNK:
            out.append(e)
            start = e
    while n - start > MAX_CHUNK:
        start = _cut(starts_character, start + MAX_CHUNK)
        out.append(start)
    if start < n:
        out.append(n)
    return out


def _cut(starts_character: np.ndarray, at: int) -> int:
    while not starts_character[at]:
        at -= 1
    return at


CANDIDATE = "digest binary, doc_id long, doc_key long, start long, end long"
_DOCS = "array<struct<doc_id: long, doc_key: long, text: string>>"


def _block(key: Column) -> Column:
    return key.bitwiseAND(F.lit(BLOCKS - 1)).cast("int")


def _digests(raw: bytes) -> tuple[np.ndarray, list[int], list[bytes]]:
    """Bytes, ends of the chunks and digests of the chunks of one text."""
    x = np.frombuffer(raw, np.uint8)
    ends = borders(x)
    return x, ends, [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip([0, *ends], ends)]


def _short(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.frombuffer(b"".join(digests), np.int64)[::2]


def _texts(docs: pa.ListArray) -> Iterator[list[tuple[int | None, int, bytes]]]:
    """Per block its documents, equal rows once: doc_id, doc_key, text."""
    every = docs.flatten()
    ids, keys = every.field("doc_id").to_pylist(), every.field("doc_key").to_pylist()
    texts = every.field("text").cast(pa.binary())
    at = 0
    for n in docs.value_lengths().to_pylist():
        seen = {keys[i]: i for i in range(at, at + n)}
        yield [(ids[i], key, texts[i].as_py()) for key, i in seen.items()]
        at += n


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, block): every document's different chunks, by the first eight
    bytes of their digests."""
    for batch in batches:
        marks, blocks = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for block, docs in zip(batch["block"].to_pylist(), _texts(batch["docs"])):
            for _, _, raw in docs:
                marks.append(np.unique(_short(_digests(raw)[2])))
                blocks.append(np.full(len(marks[-1]), block, np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(marks)), pa.array(np.concatenate(blocks))], ["mark", "block"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks whose mark is among the block's ``marks``."""
    names = ["digest", "doc_id", "doc_key", "start", "end"]
    types = [pa.binary(), *[pa.int64()] * 4]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for marks, docs in zip(batch["marks"], _texts(batch["docs"])):
            marks = marks.values.to_numpy()
            for doc_id, key, raw in docs:
                x, ends, digests = _digests(raw)
                kept = np.flatnonzero(np.isin(_short(digests), marks)).tolist()
                if not kept:
                    continue
                # Code points before each border.
                points = np.cumsum((x & 0xC0) != 0x80)
                char_ends = [0, *points[np.array(ends, np.int64) - 1].tolist()]
                n = len(kept)
                for c, v in zip(cols, ([digests[i] for i in kept], [doc_id] * n, [key] * n,
                                       [char_ends[i] for i in kept],
                                       [char_ends[i + 1] for i in kept])):
                    c.extend(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types)], names)


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, docs): the documents with a text, by some bits of doc_key (the
    hash of id and text).  The only shuffle of the texts: all steps use it."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc_key"),
                        F.col(text_col).alias("text"))
            .filter(F.length("text") > 0)
            .groupBy(_block(F.col("doc_key")).alias("block"))
            .agg(F.collect_list(F.struct("doc_id", "doc_key", "text")).cast(_DOCS).alias("docs")))


def _text_of(key: str) -> Column:
    """The text of the document ``key`` among the ``docs`` of its block."""
    return F.filter("docs", lambda d: d["doc_key"] == F.col(key))[0]["text"]


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _resolve(text: str, pieces: list[dict]) -> list[list[tuple]]:
    """The runs of one text, each a list of (start, end, n_chunks,
    keep_doc_id).  A piece inside an extended one with a smaller keeper joins
    it; what two spans both reach counts for the first."""
    spans: list[list] = []
    for p in sorted(pieces, key=lambda p: (
            p["keep_doc_id"] is None, p["keep_doc_id"] or 0, p["start"])):
        start, end = p["start"], p["end"]
        inside = next((x for x in spans if x[0] <= start and end <= x[1]), None)
        if inside:
            inside[2] += p["n_chunks"]
            continue
        before, after = p["before"], p["after"]
        own = text[max(0, start - len(before)):start]
        spans.append([start - _common(own[::-1], before[::-1]),
                      end + _common(text[end:end + len(after)], after),
                      p["n_chunks"], p["keep_doc_id"]])
    runs: list[list[tuple]] = []
    last = -1
    for start, end, n, keep in sorted(spans, key=lambda x: x[:2]):
        if end <= last:
            continue
        if not runs or start > last:
            runs.append([])
        runs[-1].append((max(start, last), end, n, keep))
        last = end
    return runs


SPAN = ("doc_id long, doc_key long, start long, end long, n_bytes long, "
        "n_chunks long, keep_doc_id long")


def _spans(min_span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "doc_key", "start", "end", "n_bytes", "n_chunks", "keep_doc_id"]
        for batch in batches:
            rows = []
            for docs, sides in zip(_texts(batch["docs"]), batch["sides"]):
                per: dict[int, dict[int, dict]] = {}
                for x in sides.as_py():
                    pieces = per.setdefault(x["doc_key"], {})
                    pieces.setdefault(x["start"], x)[x["side"]] = x["part"]
                for doc_id, key, raw in docs:
                    if key not in per:
                        continue
                    text = raw.decode()
                    for spans in _resolve(text, list(per[key].values())):
                        size = [len(text[a:b].encode()) for a, b, _, _ in spans]
                        if sum(size) >= min_span:
                            rows += [(doc_id, key, a, b, n_bytes, n, keep)
                                     for (a, b, n, keep), n_bytes in zip(spans, size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_span: int = MIN_SPAN) -> DataFrame:
    """One row per repeated span: doc_id, doc_key, start and end (code
    points), n_bytes, n_chunks and keep_doc_id, the document whose copy stays.

    A chunk is repeated when an equal one occurs in a document with a smaller
    id.  A span is a stretch of chunks with the same keeper, extended at both
    ends over the text that equals the keeper's.  Spans that touch are a run,
    and the spans of runs of at least ``min_span`` bytes are reported (one of
    several spans may be shorter).  Repeats within one document (a
    refrain, a ruled table) are left alone.  Null ids rank last,
    each distinct text a document of its own, in the order of doc_key, and have
    a null keep_doc_id when no other document holds the passage.  Rows that
    share an id are one document; equal rows report their spans once.
    Documents without a repeat have no row.
    """
    prepare(docs.sparkSession)
    blocks = _blocks(docs, id_col, text_col)
    # Most chunks occur once.  What travels of every chunk is eight bytes and
    # the block; only the chunks of a mark met again are made a second time
    # and travel whole.  A mark's rows pass one by one, however many.
    same = Window.partitionBy("mark").orderBy("block")
    again = (blocks.mapInArrow(_marks, "mark long, block int")
             .withColumn("_other", F.coalesce(F.lag("block").over(same), F.lead("block").over(same)))
             .filter("_other IS NOT NULL")
             .groupBy("block").agg(F.collect_list("mark").alias("marks")))
    found = blocks.join(again, "block").select("docs", "marks").mapInArrow(_candidates, CANDIDATE)
    # The first place of a digest is its keeper's.
    place = ["no_id", "doc_id", "doc_key", "start"]
    order = (Window.partitionBy("digest").orderBy(*place)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    repeats = (found.withColumn("no_id", F.col("doc_id").isNull())
               .withColumn("_keep", F.first(F.struct(*place)).over(order))
               .filter((F.col("doc_id") > F.col("_keep.doc_id"))
                       | (F.col("doc_id").isNull() & (F.col("doc_key") != F.col("_keep.doc_key"))))
               .select("doc_id", "doc_key", "start", "end", "_keep"))
    run = Window.partitionBy("doc_key").orderBy("start")
    fresh = (F.col("start") != F.lag("end").over(run)) \
        | ~F.col("_keep.doc_id").eqNullSafe(F.lag("_keep.doc_id").over(run)) \
        | (F.col("_keep.no_id") & (F.col("_keep.doc_key") != F.lag("_keep.doc_key").over(run)))
    pieces = (repeats.withColumn("_new", F.coalesce(fresh, F.lit(True)).cast("int"))
              .withColumn("_piece", F.sum("_new").over(run))
              .groupBy("doc_key", "_piece")
              .agg(F.first("doc_id").alias("doc_id"),
                   F.min("start").alias("start"), F.max("end").alias("end"),
                   F.count(F.lit(1)).alias("n_chunks"),
                   F.min_by("_keep", "start").alias("_first"),
                   F.max_by(F.struct(F.col("_keep.doc_key").alias("doc_key"),
                                     (F.col("_keep.start") + F.col("end") - F.col("start"))
                                     .alias("end")), "start").alias("_last")))
    # The keepers' texts around the pieces; a keeper of very many is a skewed
    # join, which AQE may split.
    own = ["doc_id", "doc_key", "start", "end", "n_chunks", "keep_doc_id"]
    ask = F.explode(F.array(
        F.struct(F.lit("before").alias("side"), F.col("_first.doc_key").alias("text_key"),
                 F.greatest(F.col("_first.start") - REACH, F.lit(0)).cast("int").alias("at"),
                 F.least(F.col("_first.start"), F.lit(REACH)).cast("int").alias("n")),
        F.struct(F.lit("after").alias("side"), F.col("_last.doc_key").alias("text_key"),
                 F.col("_last.end").cast("int").alias("at"), F.lit(REACH).alias("n")))).alias("ask")
    around = (pieces.withColumn("keep_doc_id", F.col("_first.doc_id")).select(*own, ask)
              .select(*own, "ask.*").withColumn("block", _block(F.col("text_key")))
              .join(blocks, "block").withColumn("text", _text_of("text_key"))
              .select(*own, "side", F.expr("substring(text, at + 1, n)").alias("part")))
    per = around.groupBy(_block(F.col("doc_key")).alias("block")).agg(
        F.collect_list(F.struct(*own, "side", "part")).alias("sides"))
    return (blocks.join(per, "block").select("docs", "sides")
            .mapInArrow(_spans(min_span), SPAN))


def cut_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the spans of :func:`repeated_spans` cut out
    of the texts; a text that repeats throughout becomes empty."""
    cols = docs.columns
    per = spans.groupBy("doc_key").agg(F.sort_array(F.collect_list(
        F.struct("start", "end"))).alias("_spans"))
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0).cast("long")), F.col("_spans.end")),
        F.concat(F.col("_spans.start"), F.array(F.length("_text").cast("long"))),
        lambda a, b: F.substring(F.col("_text"), (a + 1).cast("int"), (b - a).cast("int")))
    kept = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(F.array_join(gaps, ""))
    return (packed(docs).withColumn("_text", field(text_col))
            .withColumn("_key", F.xxhash64(field(id_col), field(text_col)))
            .join(per, F.col("_key") == F.col("doc_key"), "left")
            .select(*unpacked(cols, **{text_col: kept})))
