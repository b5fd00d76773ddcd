"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Builds the lake once (timed as ``ingest_lake``: derive raw records, clean,
write Parquet), then times every headline query warm: one warm-up run, then
the median of five runs (``BENCH_RUNS``) into the ``noop`` sink.  Prints one JSON line.
Spark's event log (written to a fresh local scratch folder; the UI stays off)
gives the completed stages and shuffle bytes written per run of each query.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from postlake.plans import questions as q  # noqa: E402
from postlake.plans.lake import lake  # noqa: E402
from postlake.plans.registry import QUERIES  # noqa: E402
from postlake.session import local_session  # noqa: E402

HEADLINE = list(QUERIES)  # every key of the library's own registry


# Questions re-timed on tables where one key holds a third of all rows
# (ind % 3 == 0 -> 0).  A plain join would emit (rows/3)^2 pairs for that key,
# (rows/3)^3 for the three-way questions.
SKEWED = {
    "category_counts_by_country": lambda g, p, u: q.category_counts_by_country(g, p),
    "top_user_by_country": lambda g, p, u: q.top_user_by_country(g, p, u),
    "top_category_by_age_group": lambda g, p, u: q.top_category_by_age_group(u, p),
    "median_followers_by_age_group": lambda g, p, u: q.median_followers_by_age_group(u, p),
    "median_followers_by_age_group_year": lambda g, p, u: q.median_followers_by_age_group_year(u, p),
}


def _hot(df):
    return df.withColumn("ind", F.when(F.col("ind") % 3 == 0, F.lit(0)).otherwise(F.col("ind")))


def stage_summary(event_dir: str, runs_of: dict[str, int], labels: set[str]) -> dict:
    """Per query label: completed stages and shuffle bytes written per run,
    read from Spark's event log (jobs of other descriptions are skipped)."""
    job_key, stage_key = {}, {}
    stages, shuffle = defaultdict(int), defaultdict(int)
    for path in glob.glob(f"{event_dir}/**/events_*", recursive=True) + glob.glob(f"{event_dir}/*.inprogress") \
            + [p for p in glob.glob(f"{event_dir}/*") if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    key = (ev.get("Properties") or {}).get("spark.job.description")
                    if key in labels:
                        for sid in ev.get("Stage IDs", []):
                            stage_key[sid] = key
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    key = stage_key.get(info["Stage ID"])
                    if key is None:
                        continue
                    stages[key] += 1
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            shuffle[key] += int(acc.get("Value", 0))
    return {k: {"stages": round(stages[k] / runs_of[k], 1),
                "shuffle_write_bytes": int(shuffle[k] / runs_of[k])} for k in stages}


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE
    event_dir = tempfile.mkdtemp(prefix="postlake-bench-events-")  # local bench only
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app_name="postlake-bench",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                                 "spark.eventLog.compress": "false"})

    memory = spark.sparkContext.getConf().get("spark.driver.memory", "1g")
    # first job of the JVM (executor start, class loading), reported on its own
    warmup = round(timed(lambda: spark.read.parquet(f"{sf_dir}/nation.parquet").count()), 3)
    results = {"ingest_lake": round(timed(lambda: lake(spark, sf_dir).build()), 3)}
    runs_of: dict[str, int] = {}
    for key in keys:
        spark.sparkContext.setJobDescription(key)
        run = lambda: QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        n = runs if timed(run) < 5 else 1  # after the warm-up; a long one is timed once
        results[key] = round(statistics.median(timed(run) for _ in range(n)), 3)
        runs_of[key] = n + 1
    total = round(sum(v for k, v in results.items() if k != "ingest_lake"), 3)
    skew = {}
    if os.environ.get("BENCH_SKEW", "1") == "1" and not sys.argv[1:]:
        lk = lake(spark, sf_dir)
        g, p, u = _hot(lk.geo), _hot(lk.posts), _hot(lk.users)
        for key, fn in SKEWED.items():
            spark.sparkContext.setJobDescription(f"skew:{key}")
            run = lambda: fn(g, p, u).write.format("noop").mode("overwrite").save()
            run()
            runs_of[f"skew:{key}"] = runs + 1
            skew[key] = round(statistics.median(timed(run) for _ in range(runs)), 3)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    plan_stats = stage_summary(event_dir, runs_of, set(keys) | {f"skew:{k}" for k in skew})
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "driver_memory": memory, "runs": runs, "session_warmup": warmup,
                      "skew_one_key_third_of_rows": skew,
                      "per_run_stages_and_shuffle": plan_stats}))


if __name__ == "__main__":
    main()
