"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8).  Each query is built and fully
materialised through the ``noop`` sink; after one warm-up run of the
flagship, every query reports the median of ``$BENCH_REPEAT`` (default 3)
runs.  Building a query is timed too (some operators decide their plan
from a small aggregate first).  Prints ONE JSON line.

Shuffle volume comes from Spark's event log (written to
``$BENCH_EVENT_DIR`` or a fresh scratch folder; no server is involved):
each run executes under a job group, and the shuffle bytes written by the
tasks of that group's stages are summed per query.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_listings",       # P1 flagship
    "distinct_rows",        # U2
    "distinct_columns",     # U3
    "vocab",                # V1 over documents.text
    "classify_roof",        # T7, widest vocabulary
    "value_counts",         # A2 over lineitem
    "iqr_outliers",         # A11
    "describe_numeric",     # A7 (exact quantiles)
    "quality_report",       # P6
    "import_directory",     # P4
    "transfer_zone",        # P5
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from hausprep.registry import queries
    from hausprep.session import build_session

    event_dir = os.environ.get("BENCH_EVENT_DIR") or tempfile.mkdtemp(prefix="hausprep-bench-events-")
    spark = build_session(f"local[{cpus}]", app_name="hausprep-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    qs = queries()
    results: dict[str, float] = {}
    rows: dict[str, int] = {}
    # Warm the JVM once (code generation, JIT, Parquet footers) on the flagship.
    qs["clean_listings"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        def run() -> int:
            obs = Observation(f"rows_{name}")
            df = qs[name](spark, sf_dir)
            df.observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
            return int(obs.get["n"])

        times = []
        for i in range(repeat):
            sc.setJobGroup(f"bench::{name}::{i}", name)
            t0 = time.perf_counter()
            rows[name] = run()      # output rows, counted during the run itself
            times.append(time.perf_counter() - t0)
        sc.setJobGroup("bench::other", "other")
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    app_id = sc.applicationId
    spark.stop()
    shuffle = shuffle_bytes_per_query(event_dir, app_id, repeat)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "rows": rows,
        "rows_per_sec": {k: round(rows[k] / v, 1) if v else None for k, v in results.items()},
        "shuffle_bytes": shuffle,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }))


def shuffle_bytes_per_query(event_dir: str, app_id: str, repeat: int) -> dict[str, int]:
    """Median over runs of the shuffle bytes written per query, read from
    the application's event log."""
    entries = [f for f in glob.glob(os.path.join(event_dir.replace("file:", ""), "*")) if app_id in f]
    if not entries:
        return {}
    files = []
    for entry in entries:   # rolling logs are a directory of events_<n>_* files
        if os.path.isdir(entry):
            parts = [f for f in os.listdir(entry) if f.startswith("events_")]
            parts.sort(key=lambda f: int(f.split("_")[1]))
            files += [os.path.join(entry, f) for f in parts]
        else:
            files.append(entry)
    stage_group: dict[int, str] = {}
    per_group: dict[str, int] = defaultdict(int)
    for path in files:
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"), "")
                    metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    per_group[group] += int(metrics.get("Shuffle Bytes Written", 0))
    runs: dict[str, list[int]] = defaultdict(list)
    for group, n in per_group.items():
        parts = group.split("::")
        if len(parts) == 3 and parts[0] == "bench":
            runs[parts[1]].append(n)
    return {q: int(statistics.median(v)) for q, v in runs.items()}


if __name__ == "__main__":
    main()
