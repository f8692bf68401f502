"""Benchmark: the registered analytics over staged tables.

Stages the six dump-shaped tables from the parquet inputs at $BENCH_SF_DIR
once, plus the materialised post_tags relation (timed together as
``stage_sec``), then runs every analytic over them: one warm-up
run, then the median of three timed runs each (a ``noop`` write forces the
whole plan without collecting rows). ``ingest_sec`` times the dump-to-tables
pipeline for posts, users and votes. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qalake import adapter  # noqa: E402
from qalake.operators.derive import post_tags  # noqa: E402
from qalake.registry import bodies  # noqa: E402
from qalake.session import build_session, scratch_path  # noqa: E402


def _sf_value(sf_dir: str):
    name = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def timed(build) -> float:
    """Seconds to build a query's plan and run it (some queries fetch a row while they are built)."""
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def _ingest(spark, qa) -> float:
    """Dump -> tables for posts, users and votes: the scan, staging with
    manifest and the typed load (rendering the dump files is not timed)."""
    from qalake.pipeline import PipelineArgs, run_pipeline
    from qalake.registry_ingest import POST_ATTRS, USER_ATTRS, VOTE_ATTRS
    from qalake.sources import dump
    src = scratch_path(spark, "bench-xml")
    for name, df, attrs in (("Posts", qa.posts, POST_ATTRS), ("Users", qa.users, USER_ATTRS),
                            ("Votes", qa.votes, VOTE_ATTRS)):
        dump.write_dump(df, f"{src}/{name}.xml", attrs)
    args = PipelineArgs(site="bench_site_" + uuid.uuid4().hex[:8], source_dir=src,
                        staging_dir=scratch_path(spark, "bench-staging"),
                        tables=("posts", "users", "votes"), parallel_tables=3,
                        warehouse_dir=scratch_path(spark, "bench-warehouse"))
    t = time.perf_counter()
    run_pipeline(spark, args)
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    buckets = int(os.environ.get("BENCH_BUCKETS", "0")) or None
    spark = build_session(f"local[{cpus}]", app="qalake-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    db = "bench_" + uuid.uuid4().hex[:8]
    if buckets:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    t0 = time.perf_counter()
    locs = adapter.stage(adapter.load(spark, sf_dir), scratch_path(spark, "bench-tables"),
                         buckets=buckets, db=db)
    qa = adapter.load_stored(spark, locs)
    # the derived relation is materialised once, like the reference's view
    pt_path = scratch_path(spark, "bench-post-tags")
    (post_tags(qa.posts, qa.tags).repartition("post_id").sortWithinPartitions("post_id")
     .write.mode("overwrite").parquet(pt_path))
    stage_sec = time.perf_counter() - t0
    pt = spark.read.parquet(pt_path)
    per_query: dict[str, float] = {}
    for key, (body, _) in bodies().items():
        def build(body=body):
            return body(qa, pt)

        timed(build)  # warm-up
        per_query[key] = round(statistics.median(timed(build) for _ in range(runs)), 4)
    total = round(sum(per_query.values()), 4)
    ingest_sec = None
    if os.environ.get("BENCH_INGEST", "1") == "1":
        ingest_sec = round(_ingest(spark, qa), 3)
    print(json.dumps({"metric": "analytics_total_sec", "value": total, "unit": "sec",
                      "queries": per_query, "sf": _sf_value(sf_dir),
                      "stage_sec": round(stage_sec, 3), "ingest_sec": ingest_sec, "cpus": cpus,
                      "layout": f"bucketed{buckets}" if buckets else "parquet"}))
    spark.stop()


if __name__ == "__main__":
    main()
