"""Benchmark the headline queries; prints ONE JSON line.

(so JIT compilation is not charged to whichever query comes first), then
each query is timed three times and the median is kept.  Every run writes
to the ``noop`` sink, so every row is computed.  Data: ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "extract_daily_stance", "extract_topic_label", "extract_topic_score",
    "author_stance", "author_stance_onepass", "lexicon_score",
    "lexicon_score_negated", "lexicon_score_rules", "top_terms",
    "doc_term_counts", "dim_post",
    "dim_user", "dq_suite", "welch_ttest", "fact_comment", "star_schema",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] \
        or HEADLINE
    from chorus.session import build_session
    from chorus.plans.queries import QUERIES

    spark = build_session(f"local[{cpus}]", app="chorus-bench",
                          shuffle_partitions=int(os.environ.get(
                              "BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus))),
                          **{"spark.driver.memory": "16g"})
    settings = {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.autoBroadcastJoinThreshold")}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()

    def run(n: str) -> float:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:          # warm-up pass
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(runs)), 3)
             for n in names}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cores": cpus, "runs": runs,
        "input_documents": docs, "settings": settings}))
    spark.stop()


if __name__ == "__main__":
    main()
