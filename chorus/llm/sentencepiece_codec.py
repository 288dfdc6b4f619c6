"""SentencePiece encoding and decoding by an Aho-Corasick Viterbi.

An automaton over all pieces reads a text once; at each character it follows
the output links to every piece that ends there, and each of them relaxes the
best path of the position.  The path back from the end is the encoding.

What is best depends on the model.  In a unigram model it is the largest sum
of the pieces' scores.  In a merge-ranked model (type BPE) it is the path that
the merges leave: a prefix of a text has one such path, it extends such a path
of a shorter prefix, and a piece may extend it when the merges, run over the
characters of the path's last piece and of this one, leave just these two.
Its ids are the library's.

Characters that no piece covers are written as byte pieces.  Spaces are
written as U+2581 behind one dummy space; a U+2581 of the text itself goes
through byte pieces, so decoding gives back every text exactly.

Texts are cut where a run of U+2581 begins: no piece of such a model spans
that border (checked when the model is loaded; otherwise texts are not cut),
so the best path of a text is the best paths of its parts, and a part met
before is not searched again.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import prepare

MARK = "▁"
#: Score of one byte piece.
BYTE_SCORE = -30.0
#: Remembered parts per worker, in each of two generations (about 140 bytes each).
MEMO_PARTS = 400_000
#: Remembered pairs of neighbours per worker (merge-ranked models).
MEMO_PAIRS = 200_000
#: Last piece of the empty path.
START = -1
#: A pair's key is left * PAIR + right; ids lie within half of it.
PAIR = 1 << 22


@dataclass(frozen=True, eq=False)
class Pieces:
    """The vocabulary, as shipped to the tasks."""
    key: str
    pieces: tuple      # (text, id, score) of ordinary pieces
    bytes: tuple       # id of each byte piece
    n_ids: int
    cuts: bool
    merges: bool       # scores are merge ranks

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Pieces:
    """Read a SentencePiece model file (on the driver)."""
    import hashlib

    import sentencepiece

    with open(path, "rb") as f:
        raw = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    n = sp.get_piece_size()
    plain, byte_ids = [], [None] * 256
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            plain.append((sp.id_to_piece(i), i, sp.get_score(i)))
    if None in byte_ids:
        raise ValueError(f"the model has no byte pieces: {path}")
    ranked = sorted((v for _, _, v in plain), reverse=True)[:64]
    merges = all(float(v).is_integer() for v in ranked)
    cuts = not any(MARK in p.lstrip(MARK) for p, _, _ in plain)
    return Pieces(hashlib.sha256(raw).hexdigest(), tuple(plain), tuple(byte_ids), n, cuts, merges)


@lru_cache(maxsize=2)
def automaton(pieces: Pieces):
    """Aho-Corasick automaton: piece -> (length, id, score); once per worker."""
    import ahocorasick

    a = ahocorasick.Automaton()
    if pieces.merges:                  # merges start from single characters
        for c in {c for text, _, _ in pieces.pieces for c in text}:
            a.add_word(c, (1, _bare(c), BYTE_SCORE))
    for text, i, score in pieces.pieces:
        a.add_word(text, (len(text), i, score))
    a.make_automaton()
    return a


def _bare(c: str) -> int:
    """Stands for a character that is no piece of its own."""
    return START - 1 - ord(c)


class _Parts(dict):
    """part, with spaces for U+2581 (which keeps most of them in one byte a
    character) -> its piece ids as int32 bytes.  Two generations: when the
    young one is full it becomes the old one, whose parts come back when met."""

    def __init__(self, search, limit: int = MEMO_PARTS):
        super().__init__()
        self.search, self.limit, self.old = search, limit, {}

    def __missing__(self, part: str) -> bytes:
        raw = self.old.get(part)
        if raw is None:
            raw = array("i", self.search(part.replace(" ", MARK))).tobytes()
        if len(part) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[part] = raw
        return raw


class _Pairs(dict):
    """left * PAIR + right -> whether the merges leave the two pieces."""

    def __init__(self, test, limit: int = MEMO_PAIRS):
        super().__init__()
        self.test, self.limit = test, limit

    def __missing__(self, pair: int) -> bool:
        left = (pair + PAIR // 2) // PAIR
        kept = self.test(left, pair - left * PAIR)
        if len(self) >= self.limit:
            self.clear()
        self[pair] = kept
        return kept


class Codec:
    """Encodes and decodes, with a bounded memory of parts."""

    def __init__(self, pieces: Pieces):
        self.cuts, self.byte_ids = pieces.cuts, pieces.bytes
        self.automaton = automaton(pieces)
        self.singles = frozenset(t for t, _, v in pieces.pieces
                                 if len(t) == 1 and v > BYTE_SCORE)
        self.memo = _Parts(self.merge_path if pieces.merges
                           else lambda part: self.viterbi(part)[0])
        if pieces.merges:
            self.alphabet = frozenset(c for t, _, _ in pieces.pieces for c in t)
            self.rank = {t: v for t, _, v in pieces.pieces}
            self.piece = {i: t for t, i, _ in pieces.pieces} | {
                _bare(c): c for c in self.alphabet} | {START: ""}
            self.grow = lru_cache(None)(self._grow)          # one per piece
            self.pairs = _Pairs(self.beside)
        self.parts = re.compile(" *[^ ]+| +")
        self.mark = np.array([pieces.bytes[b] for b in MARK.encode()], np.int32).tobytes()
        self.text_of = [b""] * pieces.n_ids
        self.score_of = np.zeros(pieces.n_ids)
        for text, i, score in pieces.pieces:
            self.text_of[i] = text.replace(MARK, " ").encode()
            self.score_of[i] = score
        for b, i in enumerate(pieces.bytes):
            self.text_of[i] = bytes([b])
            self.score_of[i] = BYTE_SCORE

    def viterbi(self, s: str) -> tuple[list[int], float]:
        """Best path over ``s``; of equal scores the longer last piece."""
        if self.singles.issuperset(s):
            return self._covered(s)
        n = len(s)
        best = [0.0] + [-math.inf] * n
        back: list = [None] * (n + 1)      # (length, id); id None: bytes of one character
        settled = 0

        def settle(upto: int) -> None:
            # No more pieces end at these positions: offer the byte pieces.
            nonlocal settled
            while settled < upto:
                v = best[settled] + BYTE_SCORE * len(s[settled].encode())
                settled += 1
                if v > best[settled]:
                    best[settled], back[settled] = v, (1, None)

        for end, (length, i, score) in self.automaton.iter(s):
            settle(end)
            v = best[end + 1 - length] + score
            if v > best[end + 1] or v == best[end + 1] and length > back[end + 1][0]:
                best[end + 1], back[end + 1] = v, (length, i)
        settle(n)
        ids, at = [], n
        while at:
            length, i = back[at]
            if i is None:
                ids.extend(self.byte_ids[b] for b in reversed(s[at - 1].encode()))
            else:
                ids.append(i)
            at -= length
        return ids[::-1], best[n]

    def _covered(self, s: str) -> tuple[list[int], float]:
        """The same where every character is a piece: bytes, which score less
        than any piece, are then on no best path.  The automaton names the
        longest piece of a position first, so it also wins ties."""
        n = len(s)
        best = [-math.inf] * n
        best.append(0.0)                   # best[-1]: nothing read yet
        back: list = [None] * n
        for end, piece in self.automaton.iter(s):
            length, _, score = piece
            v = best[end - length] + score
            if v > best[end]:
                best[end] = v
                back[end] = piece
        ids, at = [], n - 1
        while at >= 0:
            length, i, _ = back[at]
            ids.append(i)
            at -= length
        ids.reverse()
        return ids, best[n - 1]

    def merge_path(self, s: str) -> list[int]:
        """The path that the merges leave over ``s``.  Characters outside the
        model's alphabet merge with nothing, so ``s`` falls apart there."""
        if self.alphabet.issuperset(s):
            return self._merge_path(s)
        ids = []
        for known, run in groupby(s, self.alphabet.__contains__):
            stretch = "".join(run)
            ids += self._merge_path(stretch) if known else map(
                self.byte_ids.__getitem__, stretch.encode())
        return ids

    def _merge_path(self, s: str) -> list[int]:
        n, pairs = len(s), self.pairs
        back: list = [None] * n
        last: list = [None] * n + [START]          # last[-1]: nothing read yet
        for end, piece in self.automaton.iter(s):
            if last[end] is None:
                length, i, _ = piece
                if pairs[last[end - length] * PAIR + i]:
                    last[end], back[end] = i, piece
        ids, at = [], n - 1
        while at >= 0:
            length, i, _ = back[at]
            if i < 0:
                ids.extend(self.byte_ids[b] for b in reversed(s[at].encode()))
            else:
                ids.append(i)
            at -= length
        ids.reverse()
        return ids

    def _grow(self, i: int):
        """How a piece grows out of its characters when the best-scored pair
        of neighbours merges first, of equals the leftmost: its left edges
        and its right edges, each with the score at which it grows on.  None
        when the merges leave something else."""
        parts, rank = list(self.piece[i]), self.rank.get
        left, right, before = [parts[0]], [parts[-1]], math.inf
        left_ends, right_ends = [], []
        while len(parts) > 1:
            scores = [rank(x + y, -math.inf) for x, y in zip(parts, parts[1:])]
            score = max(scores)
            if score == -math.inf:
                return None
            if score > before:
                raise ValueError(f"merges of {self.piece[i]!r} do not follow their ranks")
            at, before = scores.index(score), score
            if at == 0:
                left.append(parts[0] + parts[1])
                left_ends.append(score)
            if at == len(parts) - 2:
                right.append(parts[-2] + parts[-1])
                right_ends.append(score)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (list(zip(left, [*left_ends, -math.inf])),
                list(zip(right, [*right_ends, -math.inf])))

    def beside(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are: both
        grow, and no pair over their border is ever the next to merge."""
        after = self.grow(right)
        if after is None or left == START:
            return after is not None
        tails, heads, a, b = self.grow(left)[1], after[0], 0, 0
        while True:
            (tail, tail_ends), (head, head_ends) = tails[a], heads[b]
            over = self.rank.get(tail + head, -math.inf)
            if over > tail_ends and over >= head_ends:
                return False
            if tail_ends == head_ends:       # leftmost first, unless both are done
                if tail_ends == -math.inf:
                    return True
                a += 1
            elif tail_ends > head_ends:
                a += 1
            else:
                b += 1

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a text (none for an empty one)."""
        if not text:
            return np.zeros(0, np.int32)
        out: list[bytes] = []
        for k, stretch in enumerate((" " + text).split(MARK)):
            if k:                           # a U+2581 of the text itself
                out.append(self.mark)
            out += map(self.memo.__getitem__, self.parts.findall(stretch) if self.cuts
                       else [stretch] if stretch else [])
        return np.frombuffer(b"".join(out), np.int32)

    def score(self, ids: np.ndarray) -> float:
        return float(self.score_of[ids].sum())

    def decode(self, ids) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8")[1:]


@lru_cache(maxsize=2)
def codec(pieces: Pieces) -> Codec:
    """One codec per worker; its memory of parts serves all its tasks."""
    return Codec(pieces)


def encode_udf(pieces: Pieces):
    """Column function text -> struct(ids, score, round_trip), where
    round_trip tells that the ids decode to the text; null for a null text."""
    fields = [pa.field("ids", pa.list_(pa.int32())), pa.field("score", pa.float64()),
              pa.field("round_trip", pa.bool_())]

    @F.arrow_udf("struct<ids: array<int>, score: double, round_trip: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(pieces)
        for texts in batches:
            flat, scores, back = [np.zeros(0, np.int32)], [], []
            for t in texts:
                text = t.as_py() or ""
                ids = own.encode(text)
                flat.append(ids)
                scores.append(own.score(ids))
                back.append(own.decode(ids) == text)
            ends = np.cumsum([len(ids) for ids in flat], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(np.concatenate(flat)))
            yield pa.StructArray.from_arrays(
                [lists, pa.array(scores, pa.float64()), pa.array(back, pa.bool_())],
                fields=fields, mask=texts.is_null())
    return run.asNondeterministic()


def decode_udf(pieces: Pieces):
    """Column function ids -> text; null for null ids."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = codec(pieces).decode
        for lists in batches:
            yield pa.array([None if x.as_py() is None else decode(x.values.to_numpy())
                            for x in lists], pa.string())
    return run.asNondeterministic()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, n_pieces, score and round_trip (the ids decode
    to exactly the text).

    A null text has null ids and score, no pieces, and round_trip true; an
    empty one has no ids and score 0.  Repeated rows and null ids are kept.
    """
    prepare(docs.sparkSession)
    pieces = load_pieces(model_path)
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
            .select("doc_id", encode_udf(pieces)(F.col("_t")).alias("_e"))
            .select("doc_id", F.col("_e.ids").alias("ids"),
                    F.coalesce(F.size("_e.ids"), F.lit(0)).alias("n_pieces"),
                    F.col("_e.score").alias("score"),
                    F.coalesce(F.col("_e.round_trip"), F.lit(True)).alias("round_trip")))
