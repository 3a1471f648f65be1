"""Benchmark of the headline queries.

Runs each query on the driver tables at $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] (default 8): one warm-up pass,
then $BENCH_REPS passes (default 3); a query's time is the median wall time
of a full execution into the ``noop`` sink (no driver collect). With
$BENCH_REPLICATE=k the event log is k disjoint copies (k times the users and
events). Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from streakflow.config import local_session  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def replicated(spark, sf_dir: str, copies: int, scratch: str) -> str:
    """Scaling runs: the driver tables with ``copies`` disjoint copies of the event
    log and of its customers (ids shifted), written once to ``scratch``."""
    from pyspark.sql import functions as F

    out = tempfile.mkdtemp(prefix="replicated-", dir=scratch)
    shift = 1_000_000_000
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))).alias("_copy")
    for name, keys in (("events", ("user_id", "event_id")), ("customer", ("c_custkey",)), ("nation", ()), ("region", ())):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if keys:
            df = df.select("*", copy).withColumns({k: F.col(k) + F.col("_copy") * 2 * shift for k in keys}).drop("_copy")
        df.write.parquet(f"{out}/{name}.parquet")
    return out


def headline(spark, sf_dir: str, scratch: str) -> dict:
    from streakflow.plans import curate as curate_plan, nightly, queries as Q
    from streakflow.plans.inputs import raw, user_dim
    from streakflow.sources import adapter

    def p1_curate():
        out = tempfile.mkdtemp(prefix="curated-", dir=scratch)
        curate_plan.run_curate(raw(spark, sf_dir), user_dim(spark, sf_dir), out)

    # the nightly job reads stored tables: materialise its inputs once (untimed)
    tables = tempfile.mkdtemp(prefix="tables-", dir=scratch)
    acc0 = Q._accepted(spark, sf_dir)
    acc0.write.parquet(f"{tables}/events")
    adapter.daily_with_faults(Q.ingest_plan.daily_activity(acc0)).write.parquet(f"{tables}/daily")
    Q._stored(spark, sf_dir, acc0).write.parquet(f"{tables}/state")

    def p4_nightly():
        acc = spark.read.parquet(f"{tables}/events")
        daily = spark.read.parquet(f"{tables}/daily")
        state = spark.read.parquet(f"{tables}/state")
        rec = nightly.nightly_reconcile(acc, daily, state, adapter.RECONCILE_AT)
        for df in (rec.drift, rec.corrections, rec.audit, rec.points, rec.streak_mismatch, rec.missing_days,
                   rec.orphan_days):
            _noop(df)

    def q(name):
        return lambda: _noop(Q.QUERIES[name](spark, sf_dir))

    return {
        "p1_curate": p1_curate,
        "e1_daily_summaries": q("daily_summaries"),
        "p2_ingest_verdicts": q("ingest_verdicts"),
        "f2_streaks": q("streaks"),
        "f5_leaderboard": q("leaderboard_by_country"),
        "d12_merge_by_key": q("merge_by_key"),
        "e4_weekly_streak_stats": q("weekly_streak_stats"),
        "e5_streak_distribution": q("streak_distribution"),
        "e6_event_type_performance": q("event_type_performance"),
        "f14_anomaly_log": q("anomaly_log"),
        "p4_nightly_reconcile": p4_nightly,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    scratch = tempfile.mkdtemp(prefix="streakflow-bench-")
    os.environ.setdefault("STREAKFLOW_SCRATCH", scratch)
    copies = int(os.environ.get("BENCH_REPLICATE", "1"))
    spark = local_session(cpus, app="streakflow-bench", shuffle_partitions=max(8, 2 * int(cpus)),
                          extra={"spark.sql.files.maxPartitionBytes": os.environ.get("BENCH_SPLIT", "512k"),
                                 "spark.sql.files.openCostInBytes": "64k", "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    data_dir = replicated(spark, sf_dir, copies, scratch) if copies > 1 else sf_dir
    jobs = headline(spark, data_dir, scratch)
    times: dict[str, list[float]] = {k: [] for k in jobs}
    for rep in range(reps + 1):
        for name, fn in jobs.items():
            t0 = time.perf_counter()
            fn()
            dt = time.perf_counter() - t0
            if rep > 0:
                times[name].append(dt)
    medians = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(medians.values()), 3),
                      "unit": "sec", "queries": medians, "sf": sf, "cpus": int(cpus), "reps": reps,
                      "replicate": copies}))


if __name__ == "__main__":
    main()
