"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. ``ingest`` is the time to build the stored pipeline
tables (votes, comments, topics, arguments, edges, assignment) from the raw
tables, once; every other entry is the median of $BENCH_RUNS runs (default 1)
of a query over those stored tables, its own intermediates rebuilt each run.
``value`` is their sum. Before that everything runs twice at sf0.01 (where
that folder exists): a warm-up, then one timed run to show growth.
Each run executes the whole plan into Spark's no-op sink (nothing collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["argument_topic_support", "latest_vote", "ctfidf", "moderation_metrics",
            "density_clusters", "comment_tally", "representative_docs", "correlate_pairs",
            "argdown_top"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from polyvox.plans.catalog import load_all
    from polyvox.session import get_session
    from polyvox.sources.adapters import Fixture
    from polyvox.sources.store import forget_intermediates

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()

    def ingest(at: str) -> float:
        forget_intermediates(all_tables=True)
        t = time.time()
        f = Fixture(spark, at)
        for name in Fixture.BASE:
            getattr(f, name)
        return time.time() - t

    def run(name: str, at: str) -> float:
        forget_intermediates()
        t = time.time()
        reg[name].build(spark, at).write.format("noop").mode("overwrite").save()
        return time.time() - t

    names = [n for n in HEADLINE if n in reg]
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    # the smaller scale warms the JVM up and, timed again, shows growth with data size
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    small: dict[str, float] = {}
    if os.path.isdir(small_dir) and os.path.realpath(small_dir) != os.path.realpath(sf_dir):
        ingest(small_dir)
        for name in names:
            run(name, small_dir)
        small = {"ingest": round(ingest(small_dir), 3)} | {n: round(run(n, small_dir), 3) for n in names}
    out = {"ingest": round(ingest(sf_dir), 3)}
    for name in names:
        if not small:
            run(name, sf_dir)
        out[name] = round(statistics.median(run(name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "ingest_and_headline_queries_median_sec", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "queries_sf0.01": small, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
