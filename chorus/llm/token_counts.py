"""Exact token counts by the whole-token shortcut.

Offline, once, on the driver: every string of the vocabulary is encoded by
the tokenizer itself; those that come back as their own single id are proven
to be whole tokens.  A pre-token found in that set counts one without any
merge; only the other pre-tokens go through the merges, and their counts are
remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import prepare

#: The byte-level pre-token pattern (fixed value of the public tokenizer).
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
             r"| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Remembered pre-tokens per worker; beyond it the memory starts afresh.
MEMO_ENTRIES = 500_000
#: Texts above this many characters are matched as a stream, not a list.
STREAM_CHARS = 1 << 20


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    shown = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE}
    table, spare = {}, 0x100
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b] = chr(spare)
            spare += 1
    return table


@dataclass(frozen=True, eq=False)
class Vocabulary:
    """What a task needs: whole tokens, ids, merges and special strings."""
    key: str
    whole: frozenset
    ids: dict
    merges: tuple
    special: tuple
    unknown: str

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE tokenizer file and prove its whole tokens."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or spec.get("normalizer")):
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    back = {c: b for b, c in byte_alphabet().items()}
    texts, ids = [], []
    for piece, i in model["vocab"].items():
        try:
            texts.append(bytes(back[c] for c in piece).decode("utf-8"))
            ids.append(i)
        except (KeyError, UnicodeDecodeError):
            continue       # not a text by itself, so never a pre-token
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    encoded = tok.encode_batch(texts, add_special_tokens=False)
    whole = frozenset(t for t, i, e in zip(texts, ids, encoded) if e.ids == [i])
    merges = tuple(tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                   for m in model["merges"])
    special = tuple(t["content"] for t in spec.get("added_tokens", []))
    key = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()
    return Vocabulary(key, whole, dict(model["vocab"]), merges, special,
                      _unknown_letters(tok.pre_tokenizer))


def _unknown_letters(pre_tokenizer) -> str:
    """Letters and digits of newer Unicode versions that the library's older
    tables do not know and treat as symbols, as ranges of a character class."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer = [c for c in regex.findall(r"[\p{L}\p{N}]", every)
             if unicodedata.category(c) == "Cn"]
    points = [ord(c) for c in newer
              if len(pre_tokenizer.pre_tokenize_str("a" + c)) > 1
              and len(pre_tokenizer.pre_tokenize_str("1" + c)) > 1]
    starts = [p for p, before in zip(points, [-1, *points]) if p != before + 1]
    ends = [p for p, later in zip(points, [*points[1:], -1]) if later != p + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


@lru_cache(maxsize=4)
def merger(vocab: Vocabulary):
    """The merge procedure of the vocabulary, built once per worker."""
    from tokenizers.models import BPE

    return BPE(vocab=vocab.ids, merges=list(vocab.merges))


class _Lengths(dict):
    """pre-token -> number of tokens: the whole tokens from the start, any
    other merged when first met and remembered within the bound."""

    def __init__(self, vocab: Vocabulary):
        super().__init__(dict.fromkeys(vocab.whole, 1))
        self.vocab, self.shown = vocab, byte_alphabet()
        self.tokenize = merger(vocab).tokenize

    def __missing__(self, pre: str) -> int:
        n = len(self.tokenize(pre.encode("utf-8").decode("latin-1").translate(self.shown)))
        if len(pre) <= 256:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
                self.update(dict.fromkeys(self.vocab.whole, 1))
            self[pre] = n
        return n


class TokenCounter:
    """Counts tokens of texts, with a bounded memory of pre-tokens."""

    def __init__(self, vocab: Vocabulary):
        self.lengths = _Lengths(vocab)
        self.pattern = regex.compile(PRE_TOKEN)
        unknown = vocab.unknown
        # A cheap test first: almost no text reaches the lowest such letter.
        self.beyond = re.compile(f"[^\x00-{chr(ord(unknown[0]) - 1)}]") if unknown else None
        self.unknown = re.compile(f"[{unknown}]") if unknown else None
        self.narrow = regex.compile(
            PRE_TOKEN.replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{unknown}]]+")
            .replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{unknown}]]+")
            .replace(r"[^\p{White_Space}\p{L}\p{N}]",
                     rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{unknown}])"),
            regex.V1) if unknown else None
        self.special = regex.compile("|".join(
            regex.escape(s) for s in sorted(vocab.special, key=len, reverse=True))) \
            if vocab.special else None

    def _run(self, text: str) -> int:
        pattern = self.pattern
        if self.beyond and self.beyond.search(text) and self.unknown.search(text):
            pattern = self.narrow
        found = pattern.findall(text) if len(text) <= STREAM_CHARS else \
            (m.group() for m in pattern.finditer(text))
        return sum(map(self.lengths.__getitem__, found))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._run(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self._run(text[at:m.start()]) + 1
            at = m.end()
        return total + self._run(text[at:])


@lru_cache(maxsize=2)
def token_counter(vocab: Vocabulary) -> TokenCounter:
    """One counter per worker; its memory serves all its tasks."""
    return TokenCounter(vocab)


def count_udf(path: str):
    """A column function text -> number of tokens; the vocabulary is read and
    proven on the driver and shipped with the function."""
    vocab = load_vocabulary(path)

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = token_counter(vocab)
        for texts in batches:
            yield pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return n_tokens.asNondeterministic()


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for the whole text of every row.

    Counts equal the tokenizer library's, without added begin or end tokens;
    special strings inside a text are one token each, as by its default.  A
    null text counts like an empty one: 0 bytes, 0 tokens.  Repeated rows and
    null ids are kept, other columns are not read, and an empty table gives an
    empty table.  A very long text is counted whole by one task, in memory
    proportional to it.
    """
    prepare(docs.sparkSession)
    n = count_udf(vocabulary_path)
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
            .select("doc_id",
                    F.coalesce(F.octet_length("_t"), F.lit(0)).cast("long").alias("n_bytes"),
                    n(F.col("_t")).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
