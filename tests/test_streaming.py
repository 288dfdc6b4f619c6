"""Incremental load: each run processes only new files, once."""


from chorus.plans.queries import LEXICON
from chorus.sources import proxies
from chorus.streaming.incremental import read_facts, run_incremental_fact
from conftest import SF01


def test_incremental_runs_process_new_files_once(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    docs = proxies.table(spark, SF01, "documents")
    docs.filter("doc_id < 500").write.parquet(f"{src}/part1")
    lex = spark.createDataFrame(LEXICON, "term string, valence double")
    args = dict(schema=docs.schema, lexicon=lex, sink_dir=f"{tmp_dir}/sink",
                checkpoint_dir=f"{tmp_dir}/ckpt",
                transform=proxies.raw_comments)
    run_incremental_fact(spark, f"{src}/part1", **args)
    first = read_facts(spark, f"{tmp_dir}/sink").count()
    run_incremental_fact(spark, f"{src}/part1", **args)   # nothing new
    assert read_facts(spark, f"{tmp_dir}/sink").count() == first
    expected = proxies.raw_comments(docs.filter("doc_id < 500")) \
        .filter("author_name IS NOT NULL").count()
    assert first == expected


def test_incremental_picks_up_only_new_files(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    docs = proxies.table(spark, SF01, "documents")
    docs.filter("doc_id < 300").write.parquet(src)
    lex = spark.createDataFrame(LEXICON, "term string, valence double")
    args = dict(schema=docs.schema, lexicon=lex, sink_dir=f"{tmp_dir}/sink",
                checkpoint_dir=f"{tmp_dir}/ckpt",
                transform=proxies.raw_comments, glob="*.parquet")
    run_incremental_fact(spark, src, **args)
    docs.filter("doc_id >= 300 AND doc_id < 700").write.mode("append") \
        .parquet(src)
    run_incremental_fact(spark, src, **args)
    run_incremental_fact(spark, src, **args)          # nothing new
    got = read_facts(spark, f"{tmp_dir}/sink")
    want = proxies.raw_comments(docs.filter("doc_id < 700")) \
        .filter("author_name IS NOT NULL")
    assert got.count() == want.count()
    assert got.select("comment_id").distinct().count() == want.count()


def test_stream_query_reads_a_table_of_several_files(spark, tmp_dir):
    from chorus.plans.queries import QUERIES
    docs = proxies.table(spark, SF01, "documents")
    rows = [(i, f"good word {i}", "en", "web", 11 + len(str(i))) for i in range(40)]
    spark.createDataFrame(rows, docs.schema).repartition(3) \
        .write.parquet(f"{tmp_dir}/documents.parquet")
    got = QUERIES["stream_fact_comment"](spark, tmp_dir)
    want = proxies.raw_comments(spark.createDataFrame(rows, docs.schema)) \
        .filter("author_name IS NOT NULL")
    assert sorted(r.comment_id for r in got.select("comment_id").collect()) == \
        sorted(r.comment_id for r in want.select("comment_id").collect())
