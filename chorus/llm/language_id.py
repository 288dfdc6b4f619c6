"""Language identification by hierarchical discrimination.

A first level of linear support vector machines tells language families
apart; within the winning family, one machine per pair of languages votes.
Features are hashed byte 2- and 3-grams of the lower-cased text with
everything but letters written as spaces, as shares of the text's n-grams.

Training reads a bounded sample per language (``SAMPLE`` documents, chosen by
hash); the n-gram counts of the sample are made on the executors, and each
machine is fitted by a task of its own.  Prediction is one pass over the
texts with the weights shipped to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import field, packed, prepare, unpacked

UND = "und"
#: Hashed features (a power of two); feature 0 is never used.
BUCKET_BITS = 14
#: Documents per language that the machines are fitted on, about.
SAMPLE = 400
#: Score from which a prediction places a text in its language.
MIN_SCORE = 0.45
#: Languages that a label column may hold.
MAX_LANGUAGES = 1000
#: Bytes of text whose n-grams are looked up at a time.
BLOCK = 1 << 21
STEPS, REGULAR = 250, 1e-5

# Families of the languages (fixed values); a language not listed is a
# family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic",
    "da": "germanic", "no": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "gl": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic",
    "sk": "slavic", "bg": "slavic", "sr": "slavic", "hr": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
    "hi": "indic", "bn": "indic", "ur": "indic", "mr": "indic",
}


# ------------------------------------------------------------------ features
def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): lower-cased, non-letters as spaces, a space around
    each text.  Bytes beyond ASCII count as letters."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    padded = pc.binary_join_element_wise(
        pa.scalar("", pa.large_string()), low, pa.scalar("", pa.large_string()),
        pa.scalar(" ", pa.large_string()))
    _, offsets, data = padded.buffers()
    offsets = np.frombuffer(offsets, np.int64)[padded.offset:padded.offset + len(padded) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table[raw[offsets[0]:offsets[-1]]], offsets - offsets[0]


def _features(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature of the 2-gram and the 3-gram that end at each byte; 0
    for an n-gram of spaces, and where the text has not begun."""
    if len(x) < 2:
        return np.zeros(len(x), np.int32), np.zeros(len(x), np.int32)
    c = x.astype(np.uint32)
    two = np.zeros(len(x), np.uint32)
    two[1:] = (c[:-1] << np.uint32(8)) | c[1:]
    three = np.zeros(len(x), np.uint32)
    three[2:] = (c[:-2] << np.uint32(16)) | two[2:]
    shift = np.uint32(32 - BUCKET_BITS)
    out = []
    for gram, blank, salt in ((two, 0x2020, 0x9E3779B1), (three, 0x202020, 0x85EBCA77)):
        h = ((gram + np.uint32(1)) * np.uint32(salt)) >> shift
        h[(gram == blank) | (gram == 0)] = 0
        out.append(h.astype(np.int32))
    return out[0], out[1]


def _blocks(x: np.ndarray, offsets: np.ndarray):
    """(features of one text's stretch, its number), a bounded stretch at a
    time; stretches overlap by the two bytes that n-grams look back."""
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        for at in range(a, b, BLOCK):
            back = min(2, at - a)
            two, three = _features(x[at - back:min(b, at + BLOCK)])
            yield i, two[back:], three[back:]


def histogram(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, shares) of each text."""
    x, offsets = _codes(texts)
    counts = [np.zeros(1 << BUCKET_BITS) for _ in range(len(texts))]
    for i, two, three in _blocks(x, offsets):
        counts[i] += np.bincount(two, minlength=1 << BUCKET_BITS)
        counts[i] += np.bincount(three, minlength=1 << BUCKET_BITS)
    out = []
    for c in counts:
        c[0] = 0
        index = np.flatnonzero(c)
        out.append((index, c[index] / max(1.0, c.sum())))
    return out


# ------------------------------------------------------------------ machines
def fit_svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps;
    ``x`` is scaled in place.

    Features are scaled by the square root of their mean share, so that rare
    n-grams count beside common ones; the scale is folded into the weights.
    """
    scale = (1.0 / np.sqrt(x.mean(axis=0) + 1e-6)).astype(x.dtype)
    x *= scale                                 # in place: one matrix per task
    n = np.where(y > 0, (y > 0).sum(), (y < 0).sum())       # classes weigh alike
    weight = (0.5 / n).astype(x.dtype)
    lipschitz = 2.2 * _largest_eigenvalue(x, weight) + REGULAR
    w = v = np.zeros(x.shape[1] + 1, x.dtype)  # the last weight is the bias
    for t in range(1, STEPS + 1):
        pull = weight * y * np.maximum(0.0, 1.0 - y * (x @ v[:-1] + v[-1]))
        gradient = REGULAR * v - 2 * np.append(x.T @ pull, pull.sum())
        step = v - gradient / lipschitz
        v, w = step + (t - 1) / (t + 2) * (step - w), step
    return (w[:-1] * scale).astype(np.float64), float(w[-1])


def _largest_eigenvalue(x: np.ndarray, weight: np.ndarray) -> float:
    """Of the weighted Gram matrix with a bias column, by power iteration."""
    u = np.ones(x.shape[1] + 1, x.dtype)
    size = 1.0
    for _ in range(30):
        u = u / size
        r = weight * (x @ u[:-1] + u[-1])
        u = np.append(x.T @ r, r.sum())
        size = float(np.linalg.norm(u)) or 1.0
    return size


def _fit_group(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("h", "ascending"), ("lang", "ascending")])
    used = np.unique(rows["index"].combine_chunks().flatten().to_numpy())
    x = np.zeros((rows.num_rows, len(used)), np.float32)
    for i, (index, share) in enumerate(zip(rows["index"], rows["share"])):
        x[i, np.searchsorted(used, index.values.to_numpy())] = share.values.to_numpy()
    y = rows["side"].to_numpy().astype(np.float32)
    w, bias = fit_svm(x, y)
    return pa.table({"machine": rows["machine"].slice(0, 1),
                     "index": pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                     "weight": pa.array([w], pa.list_(pa.float64())),
                     "bias": pa.array([bias], pa.float64())})


@dataclass(frozen=True)
class Model:
    """Families in order; per level the machines (positive, negative, column)."""
    families: tuple                    # ((family, (lang, ...)), ...)
    levels: dict                       # "" or family -> (W (buckets, n), bias, pairs)

    def predict(self, texts: pa.Array) -> tuple[list, np.ndarray]:
        """(language, score 0 to 1) of each text; the caller rules out texts
        without a letter."""
        n = len(texts)
        if not self.families or not n:
            return [UND] * n, np.zeros(n)
        x, offsets = _codes(texts)
        names = [f for f, _ in self.families]
        place, score = self._level("", names, x, offsets, np.arange(n))
        langs = np.empty(n, object)
        for k, (family, members) in enumerate(self.families):
            rows = np.flatnonzero(place == k)
            if len(rows):
                who, s = self._level(family, list(members), x, offsets, rows)
                langs[rows] = np.array(members, object)[who]
                score[rows] *= s
        return langs.tolist(), score

    def _level(self, level, names, x, offsets, rows):
        """One against one: votes, then summed margins, then the first name."""
        if len(names) == 1:
            return np.zeros(len(rows), np.int64), np.ones(len(rows))
        weights, bias, pairs = self.levels[level]
        total = np.zeros((len(rows), len(pairs)))
        grams = np.zeros(len(rows))
        for r, i in enumerate(rows):
            for at in range(offsets[i], offsets[i + 1], BLOCK):
                back = min(2, at - offsets[i])
                two, three = _features(x[at - back:min(offsets[i + 1], at + BLOCK)])
                two, three = two[back:], three[back:]
                total[r] += weights[two].sum(axis=0, dtype=np.float64)
                total[r] += weights[three].sum(axis=0, dtype=np.float64)
                grams[r] += np.count_nonzero(two) + np.count_nonzero(three)
        margin = total / np.maximum(1.0, grams)[:, None] + bias
        votes = np.zeros((len(rows), len(names)))
        sums = np.zeros((len(rows), len(names)))
        for c, (p, q) in enumerate(pairs):
            m = margin[:, c]
            votes[:, p] += m >= 0
            votes[:, q] += m < 0
            sums[:, p] += m
            sums[:, q] -= m
        best = np.lexsort((-np.arange(len(names))[None, :].repeat(len(rows), 0), sums, votes),
                          axis=1)[:, -1]
        chance = np.zeros(len(rows))
        for c, (p, q) in enumerate(pairs):
            sign = np.where(best == p, 1.0, np.where(best == q, -1.0, 0.0))
            chance += np.where(sign != 0, 1 / (1 + np.exp(-3 * np.clip(sign * margin[:, c], -20, 20))), 0)
        return best, chance / (len(names) - 1)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, labelled: Column, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang",
          families: dict[str, str] = FAMILIES, sample: int = SAMPLE) -> Model:
    """Fit the machines on rows where ``labelled`` holds, the label is not
    null and the text has a letter; about ``sample`` rows per language.  With
    no such row the model is empty and predicts ``und``."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text"), F.coalesce(labelled, F.lit(False)).alias("ok")) \
        .filter("ok AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different labels in {lang_col}")
    if not counts:
        return Model((), {})
    h = F.xxhash64(F.lit(11), "id")
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, sample / n))])
    picked = rows.withColumn("h", h).filter(
        (F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)) & has_letter(F.col("text")))

    @F.arrow_udf("struct<index: array<int>, share: array<double>>")
    def grams(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([{"index": i.astype(np.int32), "share": s} for i, s in (
                histogram(texts.slice(k, 1))[0] for k in range(len(texts)))],
                pa.struct([("index", pa.list_(pa.int32())), ("share", pa.list_(pa.float64()))]))

    tree: dict[str, list[str]] = {}
    for lang in sorted(counts):
        tree.setdefault(families.get(lang, lang), []).append(lang)
    order = tuple((f, tuple(tree[f])) for f in sorted(tree))
    machines: dict[str, dict[str, int]] = {}       # machine -> language -> side
    pairs: dict[str, list] = {}
    for level, names, of in [("", [f for f, _ in order], lambda lang: families.get(lang, lang)),
                             *((f, list(m), lambda lang: lang) for f, m in order)]:
        members = [lang for lang in counts if level in ("", families.get(lang, lang))]
        pairs[level] = list(combinations(range(len(names)), 2))
        for p, q in pairs[level]:
            machines[f"{level}/{p}/{q}"] = {
                lang: 1 if of(lang) == names[p] else -1
                for lang in members if of(lang) in (names[p], names[q])}
    weights: dict[str, tuple] = {}
    if machines:
        sides = F.create_map(*[v for lang in counts for v in (F.lit(lang), F.array(*[
            F.struct(F.lit(m).alias("machine"), F.lit(s[lang]).alias("side"))
            for m, s in machines.items() if lang in s] or [
            F.struct(F.lit("").alias("machine"), F.lit(0).alias("side"))]))])
        fitted = (picked.withColumn("_g", grams(F.col("text")))
                  .withColumn("_s", F.explode(sides[F.col("lang")]))
                  .filter("_s.side <> 0")
                  .select(F.col("_s.machine").alias("machine"), F.col("_s.side").alias("side"),
                          "h", "lang", "_g.index", "_g.share")
                  .groupBy("machine").applyInArrow(
                      _fit_group, "machine string, index array<int>, weight array<double>, bias double"))
        weights = {r["machine"]: (np.array(r["index"], np.int64), np.array(r["weight"]), r["bias"])
                   for r in fitted.collect()}
    levels = {}
    for level, combos in pairs.items():
        w = np.zeros((1 << BUCKET_BITS, len(combos)), np.float32)
        b = np.zeros(len(combos))
        for c, (p, q) in enumerate(combos):
            index, value, bias = weights.get(f"{level}/{p}/{q}", (np.zeros(0, np.int64), 0.0, 0.0))
            w[index, c] = value
            b[c] = bias
        w[0] = 0
        levels[level] = (w, b, combos)
    return Model(order, levels)


def predict_udf(model: Model):
    """Column function (text, has a letter) -> struct(lang_pred, score)."""
    out = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, letters in batches:
            langs, score = model.predict(texts)
            ok = letters.to_numpy(zero_copy_only=False)
            langs = [lang if k else UND for lang, k in zip(langs, ok)]
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.where(ok, score, 0.0))], fields=out)
    return run.asNondeterministic()


def held_out(id_col: Column) -> Column:
    """The fold kept from training: crc32 of the id as text, mod 3, is 1
    (a null id is not held out, and not learned from)."""
    return F.crc32(id_col.cast("string")) % 3 == 1


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row.

    Learned from rows that are not held out and have an id and a label.
    ``und`` with score 0 for a null text or one without a letter, and when
    there is nothing to learn from.  Repeated rows and null ids are kept.  A
    very long text is read whole by one task, its n-grams a block at a time.
    Other columns are not read, whatever their names.  An empty table gives an
    empty table.
    """
    model = train(docs, ~held_out(F.col(id_col)), id_col, text_col, lang_col)
    text = F.col(text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"),
                        F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"))
            .withColumn("_p", predict_udf(model)(F.col("_t"), has_letter(F.col("_t"))))
            .select("doc_id", "held_out", F.col("_p.lang_pred").alias("lang_pred"),
                    F.col("_p.score").alias("score")))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs``, all columns, without the documents that the machines place in
    no learned language: predicted ``und`` (null text, or no letter), or with
    a score below ``min_score``, where no language is ahead of the others.
    With no label to learn from, documents with a letter stay.  Repeated rows
    share their fate, null ids are kept like others, a very long text is
    read whole by one task, and an empty table gives an empty table."""
    model = train(docs, ~held_out(F.col(id_col)), id_col, text_col, lang_col)
    if not model.families:
        return docs.filter(has_letter(F.col(text_col)))
    letters = has_letter(field(text_col))
    return (packed(docs).withColumn("_p", predict_udf(model)(field(text_col), letters))
            .filter((F.col("_p.lang_pred") != UND) & (F.col("_p.score") >= min_score))
            .select(*unpacked(docs.columns)))
