"""Multi-line CSV in parallel, a lexicon too large to broadcast, thousands of
keywords, and inferred types."""

import random

import pytest
from pyspark.sql import functions as F

from chorus.functions.text import mentions, mentions_word
from chorus.operators import inference, lexicon
from chorus.sources import csv_split, files
from conftest import SF001
from test_plans import plan


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


SCHEMA = "id int, text string, n double"


@pytest.fixture(params=[40, 200, 1 << 20])
def block_bytes(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param),
            "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k in keys:
        spark.conf.unset(k)


def test_split_csv_equals_the_multi_line_reader(spark, tmp_dir, block_bytes):
    """Records of many lines, over block borders and whole blocks."""
    rng = random.Random(3)
    parts = ["a", "é", '"', ",", "\n", "\n\n", "x" * 30, ' "q" ', "line\nline"]
    rows = [(rng.choice([None, i]), rng.choice([None, "".join(
        rng.choice(parts) for _ in range(rng.randrange(1, 12)))]), i / 4) for i in range(150)]
    path = f"{tmp_dir}/csv"
    files.write_extract(spark.createDataFrame(rows, SCHEMA), path, single_file=True)
    split = csv_split.read_csv_split(spark, path, SCHEMA)
    if block_bytes < 1 << 20:
        assert csv_split._lines(spark, path).rdd.getNumPartitions() > 10
    assert _rows(split) == _rows(files.read_csv(spark, path, SCHEMA))


def test_split_csv_query_is_written_by_several_tasks(spark, tmp_dir, monkeypatch):
    import glob

    from chorus.plans import queries_daily
    rows = [(i, f'two\nlines, "{i}"', "en", "web", 9) for i in range(30)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(queries_daily, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    got = queries_daily.csv_split_scan(spark, tmp_dir)
    assert sorted(map(tuple, got.collect())) == rows
    assert len(glob.glob(f"{tmp_dir}/csv_split_scan/part-*.csv")) == 3


def test_split_csv_counts_corrupt_records(spark, tmp_dir):
    with open(f"{tmp_dir}/f.csv", "w", newline="") as f:
        f.write('id,text,n\r\n1,"two\r\nlines",0.5\r\nx,bad id,1\r\n3,"a ""quoted"" word",2\r\n')
    got = csv_split.read_csv_split(spark, f"{tmp_dir}/f.csv", SCHEMA, keep_corrupt=True).collect()
    good = sorted((r.id, r.text, r.n) for r in got if r[csv_split.CORRUPT] is None)
    assert good == [(1, "two\r\nlines", 0.5), (3, 'a "quoted" word', 2.0)]
    bad = csv_split.corrupt_records(spark, f"{tmp_dir}/f.csv", SCHEMA).first()
    assert (bad.n_records, bad.n_corrupt) == (3, 1)


def test_only_hot_terms_of_a_large_lexicon_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "HOT_SHARE", 0.05)
    rng = random.Random(2)
    words = ["hot"] * 30 + [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(rng.choices(words, k=20))) for i in range(200)] + [(7, None), (None, "hot")]
    df = spark.createDataFrame(rows, "id long, t string")
    lex = spark.createDataFrame([("hot", 1.5)] + [(f"w{i}", (i - 50) / 8) for i in range(100)],
                                "term string, valence double")
    want = _rows(lexicon.lexicon_score(df, "id", "t", lex))
    got = lexicon.lexicon_score(df, "id", "t", lex, lexicon_rows=lexicon.LEXICON_MAX_ROWS + 1)
    assert _rows(got) == want
    tokens = df.select(F.explode(F.split("t", " ")).alias("term"))
    assert [r.term for r in lexicon.hot_terms(tokens, 0.05).collect()] == ["hot"]
    assert lexicon.hot_terms(tokens.limit(0), 0.05).count() == 0
    p = plan(got)
    assert "LeftAnti" in p          # the hot terms' tokens are kept out of the shuffle


def test_many_words_equal_the_word_pattern(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("text").union(
        spark.createDataFrame([("The-end",), ("theend",), (None,), ("",), ("l'été",)], "t string"))
    words = ["the", "end", "é", "été", "de", "ou", "Was"]
    for case in (False, True):
        got = df.select(mentions_word("text", words, case).alias("a"),
                        mentions("text", words, "word", case).alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]
        assert {r.a for r in got} == {True, False}
    for bad in ([], ["two words"], ["a-b"]):
        with pytest.raises(ValueError):
            mentions_word("text", bad)


def test_profiles_of_parts_add_up(spark):
    rows = [("1", "true", "2024-01-02", "1.5", "x", None), ("-20", "FALSE", "2024-02-30", "2e3", "", None),
            ("3000000000", None, "2024-03-01", ".5", "y", None), (None, "true", None, "oops", "z", None)]
    df = spark.createDataFrame(rows, "i string, b string, d string, f string, s string, e string")
    whole = inference.type_profile(df)
    parts = inference.merge_profiles(inference.type_profile(df.filter("i = '1'")).unionByName(
        inference.type_profile(df.filter("i IS NULL OR i <> '1'"))))
    assert _rows(parts) == _rows(whole.select(*parts.columns))
    strict = {r["column"]: (r["type"], r.n_malformed) for r in inference.inferred(whole).collect()}
    assert strict == {"i": ("bigint", 0), "b": ("boolean", 0), "d": ("string", 0),
                      "f": ("string", 0), "s": ("string", 0), "e": ("string", 0)}
    loose = {r["column"]: (r["type"], r.n_malformed)
             for r in inference.inferred(whole, 0.34).collect()}
    assert loose["d"] == ("date", 1) and loose["f"] == ("double", 1) and loose["i"] == ("int", 1)
    assert len([x for x in plan(whole).splitlines() if "HashAggregate (" in x or "ObjectHashAggregate (" in x]) <= 4


# ------------------------------------------------------------ load that survives a retry
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
TYPES = "k VARCHAR(100), v VARCHAR(100)"


def test_a_load_with_doubled_rows_counts_each_once(spark, monkeypatch):
    from chorus.sources import jdbc
    url = "jdbc:derby:memory:chorus_merge;create=true"
    write = jdbc.write_jdbc

    def twice(df, url, table, mode, *a, **kw):
        """A task that committed its rows, was lost and ran again."""
        write(df, url, table, mode, *a, **kw)
        if mode == "overwrite":
            write(df.filter("n % 2 = 0"), url, table, "append", *a, **kw)
    monkeypatch.setattr(jdbc, "write_jdbc", twice)

    def load(rows, **kw):
        df = spark.createDataFrame(rows, "k string, n int, v string").repartition(3)
        jdbc.merge_jdbc(df, url, "facts", ["k", "n"], DERBY, TYPES, **kw)
    table = lambda: _rows(jdbc.read_jdbc(spark, url, "facts", DERBY).select("k", "n", "v"))
    # Derby takes no null string in a VARCHAR column from Spark's writer.
    first = [("a", 1, "x"), ("a", 2, "y"), ("z", None, "z"), ("b", 6, "")]
    load(first)
    assert table() == sorted(first, key=repr)
    load(first)                                          # the whole run again
    assert table() == sorted(first, key=repr)
    load([("a", 2, "new"), ("z", None, "null key"), ("c", 8, "c")])
    want = [("a", 1, "x"), ("a", 2, "new"), ("z", None, "null key"), ("b", 6, ""), ("c", 8, "c")]
    assert table() == sorted(want, key=repr)


def test_a_failed_merge_leaves_the_target(spark):
    from chorus.sources import jdbc
    url = "jdbc:derby:memory:chorus_merge_fail;create=true"
    df = spark.createDataFrame([("a", 1, "x")], "k string, n int, v string")
    jdbc.merge_jdbc(df, url, "facts", ["k"], DERBY, TYPES)
    with pytest.raises(Exception, match="nothere"):
        jdbc.merge_jdbc(df, url, "facts", ["nothere"], DERBY, TYPES, run="r7")
    assert jdbc.read_jdbc(spark, url, "facts", DERBY).count() == 1
    with pytest.raises(Exception, match="(?i)facts_r7"):
        jdbc.read_jdbc(spark, url, "facts_r7", DERBY).count()


def test_the_star_is_served_by_key(spark):
    from chorus.plans import star
    from chorus.sources import jdbc
    url = "jdbc:derby:memory:chorus_star_merge;create=true"
    tables = {"dim_date": spark.createDataFrame(
        [("2024-01-02", "01", "2024", "01-2024")], "date string, month string, year string, "
        "month_year string").withColumn("date", F.to_date("date"))}
    for _ in range(2):
        star.serve(tables, url, DERBY, "merge",
                   column_types={"dim_date": "month_year VARCHAR(7)"})
    assert jdbc.read_jdbc(spark, url, "dim_date", DERBY).count() == 1


def test_phrases_match_longest_from_the_left(spark):
    lex = {"a": 1.0, "b": -2.0, "a b": 3.5, "b c": 5.0, "a b a": 0.25, "c c c": -1.5}
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 25))) for _ in range(80)]
    rows = [(i % 50, t) for i, t in enumerate(texts)] + [(1, None), (None, "A  b\nc!"), (None, "a b")] * 2

    def score(t):
        words, i, s = (t or "").lower().split(), 0, 0.0
        while i < len(words):
            for k in (3, 2, 1):
                if i + k <= len(words) and " ".join(words[i:i + k]) in lex:
                    s += lex[" ".join(words[i:i + k])]
                    i += k
                    break
            else:
                i += 1
        return round(s / (s * s + 15) ** 0.5, 4)
    df = spark.createDataFrame(rows, "id long, t string")
    table = spark.createDataFrame([(t.upper().replace(" ", "  "), v) for t, v in lex.items()],
                                  "term string, valence double")
    want = sorted(((i, score(t)) for i, t in rows), key=repr)
    assert _rows(lexicon.phrase_scores(df, "id", "t", table)) == want
    large = lexicon.LEXICON_MAX_ROWS + 1
    assert _rows(lexicon.phrase_scores(df, "id", "t", table, lexicon_rows=large)) == want
    assert lexicon.phrase_scores(df.limit(0), "id", "t", table).count() == 0
