"""The registered queries of the operators, over whole test tables.

Each ``opN_<name>`` applies its operator with production parameters.  SQL
twins exist where SQL can express the result; the others are tested against
brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.llm import (ann, chat_format, exact_dedup, hard_negatives, language_id,
                        minmax_hash, mixing, periodic_runs, sentencepiece_codec,
                        sharding, simhash, substring_dedup, token_counts)
from chorus.llm.common import WORD, read_table

#: Names of the tokenizer files; their folder is a parameter (see ``tokenizer``).
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 24)


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_spans(
        read_table(spark, sf_dir, "documents")).drop("doc_key")


@query("op4_chat_format")
def op4_chat_format(spark, sf_dir):
    sample = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", sample), (-7, 1, "assistant", sample)],
        "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat_format.read_back(chat_format.format_windows(turns.unionByName(extra)))


@query("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir):
    """The given model is merge-ranked: its scores are ranks, whose largest
    sum is not the library's encoding.  Over the automaton's output links a
    piece therefore relaxes a position when the merges leave it beside the
    path's last piece, which gives the library's ids; models with
    log-probabilities relax by the sum of scores."""
    return sentencepiece_codec.encode_documents(
        read_table(spark, sf_dir, "documents"), tokenizer(PIECES))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    return simhash.simhash_components(
        read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


OP8_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         3 * source_size AS cap, sum(source_size) OVER () AS total
  FROM per),
-- Water level: the sources whose cap lies below it are full, the rest get level * weight.
steps AS (
  SELECT a.k, a.cap, a.weight,
         (max(a.total) - coalesce(sum(b.cap) FILTER (WHERE b.lower), 0))::DOUBLE
         / sum(b.weight) FILTER (WHERE NOT b.lower) AS level
  FROM ranked a JOIN LATERAL (
    SELECT r.cap, r.weight,
           r.cap / r.weight < a.cap / a.weight
           OR (r.cap / r.weight = a.cap / a.weight AND r.k < a.k) AS lower
    FROM ranked r) b ON true
  GROUP BY a.k, a.cap, a.weight),
water AS (SELECT min_by(level, cap / weight) AS level FROM steps WHERE level * weight <= cap),
rates AS (
  SELECT source, source_size, least(level * weight, cap::DOUBLE) AS target,
         CASE WHEN source_size > 0
              THEN least(least(level * weight, cap::DOUBLE) / source_size, 3.0::DOUBLE)
              ELSE 0.0::DOUBLE END AS rate
  FROM ranked, water),
draws AS (
  SELECT s.doc_id, s.size, r.*, d.d AS draw,
         (('0x' || substr(md5((d.d // 4)::VARCHAR || '|' || coalesce('=' || s.doc_id::VARCHAR, '0')
           || '|=' || s.size::VARCHAR), 1 + 8 * (d.d % 4)::INTEGER, 8))::BIGINT)::DOUBLE
         / 4294967296 AS u
  FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source,
       range(8) d(d)),
copies AS (
  SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM draws),
off AS (
  SELECT source, draw, abs(sum(size * copies) - max(target)) AS off
  FROM copies GROUP BY source, draw),
best AS (SELECT source, min(struct_pack(off := off, draw := draw)).draw AS draw
         FROM off GROUP BY source)
SELECT c.doc_id, c.size, c.source_size, c.target, (c.size * c.copies)::BIGINT AS taken, c.copies
FROM copies c JOIN best b ON c.source IS NOT DISTINCT FROM b.source AND c.draw = b.draw
"""


@query("op8_mixing", OP8_SQL)
def op8_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


NORMALISED_SQL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


@query("op9_exact_dedup", f"""
WITH digests AS (
  SELECT doc_id, sha256({NORMALISED_SQL}) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)""")
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


@query("op10_ann")
def op10_ann(spark, sf_dir):
    return ann.nearest(read_table(spark, sf_dir, "embeddings"),
                       F.col("vec_id") % 20 == 0, 20)


def planted_text(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The contract's planted repeats: every tenth text by CRC-32 of its id
    goes round and round from a word on."""
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    i32 = lambda c: c.cast("int")
    turn = F.slice(words, i32(a) + 1, i32(p))
    turns = F.flatten(F.array_repeat(turn, i32(F.ceil((n - a) / p))))
    planted = F.concat(F.slice(words, F.lit(1), i32(a)), F.slice(turns, F.lit(1), i32(n - a)))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(F.col(text))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", planted_text().alias("text"))
    found = periodic_runs.periodic_runs(docs)
    # Greatest length, then smallest start, then smallest period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"),
        (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                              F.lit("\n"))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP12_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM worded),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
       coalesce(low.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(low.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN low USING (doc_id)
"""


@query("op12_minhash", OP12_SQL)
def op12_minhash(spark, sf_dir):
    return minmax_hash.minmax_components(read_table(spark, sf_dir, "documents"), shingle=4,
                                         percent=80)


OP13_SQL = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id
                          ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10) \
        .otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", label.alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0)
