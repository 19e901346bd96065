"""Benchmark: build the warehouse from the star-schema tables and time it.

Prints ONE JSON line::

    {"metric": "warehouse_build_sec", "value": <median full build>, "unit": "sec",
     "queries": {...}, "sf": ...}


* ``build:*`` - building tables from raw inputs at the bench scale. The
  headline value is the full layered build (detail + 6 summaries + 10 marts,
  each written as Parquet); ``build:<mart>`` times each mart as one lazy plan
  from raw tables to a no-op sink.
* ``scan:*`` - ``SELECT *`` of a finished mart in a warm session (the closest
  analogue of the reference's published numbers, which include a cold JVM
  start and so are not directly comparable).

``last_build`` holds tasks, task time, shuffle, spill and bytes read of the last
full build, from Spark's event log.

Every figure is the median of ``BENCH_REPEATS`` runs after a warm-up.
Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEATS`` (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martforge.plans.pipeline import run_pipeline  # noqa: E402
from martforge.plans.registry import build_queries  # noqa: E402
from martforge.schemas import MART_TABLES  # noqa: E402
from martforge.session import get_session  # noqa: E402
from martforge.sources.raw import read_table  # noqa: E402

SCAN_TABLES = ("gmv_trend", "product_topn")


def _median_time(fn, repeats: int) -> float:
    runs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def log_figures(folder: str, since: float, until: float) -> dict[str, float]:
    """Tasks, task time, shuffle and spill of the stages that ended within a
    time window, from Spark's event log."""
    total = dict.fromkeys(("tasks", "task_sec", "longest_task_sec", "shuffle_write_mb", "spill_mb", "read_mb"), 0.0)
    for name in os.listdir(folder):
        with open(os.path.join(folder, name), errors="replace") as lines:
            for line in lines:
                if not line.startswith('{"Event":"SparkListenerTaskEnd"'):
                    continue
                event = json.loads(line)
                info, metrics = event["Task Info"], event.get("Task Metrics") or {}
                if not since * 1000 <= info["Finish Time"] <= until * 1000:
                    continue
                run = metrics.get("Executor Run Time", 0) / 1000
                total["tasks"] += 1
                total["task_sec"] += run
                total["longest_task_sec"] = max(total["longest_task_sec"], run)
                total["shuffle_write_mb"] += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                total["spill_mb"] += metrics.get("Disk Bytes Spilled", 0) / 1e6
                total["read_mb"] += metrics.get("Input Metrics", {}).get("Bytes Read", 0) / 1e6
    return {k: round(v, 3) for k, v in total.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir

    scratch = tempfile.mkdtemp(prefix="martforge-bench-")
    events = os.path.join(scratch, "events")
    os.mkdir(events)
    spark = get_session(f"local[{cpus}]", app="martforge-bench", extra={
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
    })
    queries = build_queries()
    out: dict[str, float] = {}

    # warm-up: JVM, code generation caches, file listing
    queries["gmv_trend"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # (b) full layered build, written to Parquet
    builds, layer_runs, windows = [], [], []
    for i in range(repeats):
        begun = time.time()
        res = run_pipeline(spark, f"{scratch}/wh{i}", star_dir=sf_dir, etl_date="2026-01-01")
        builds.append(res["timings"]["total"])
        windows.append((begun, time.time()))
        layer_runs.append(res["timings"])
    total = round(statistics.median(builds), 3)
    for name in layer_runs[0]:
        if name != "total":
            out[f"build_layer:{name.lstrip('_')}"] = round(
                statistics.median(r[name] for r in layer_runs), 3)

    # (b) each mart as one lazy plan from raw tables
    for name in MART_TABLES:
        out[f"build:{name}"] = _median_time(
            lambda n=name: queries[n](spark, sf_dir).write.format("noop")
            .mode("overwrite").save(), repeats)

    # (a) warm scans of finished marts
    for name in SCAN_TABLES:
        out[f"scan:{name}"] = _median_time(lambda n=name: read_table(spark, f"{scratch}/wh0", n).collect(),
                                           max(repeats, 5))

    spark.stop()  # flushes the event log
    print(json.dumps({"metric": "warehouse_build_sec", "value": total, "unit": "sec", "queries": out, "sf": sf,
                      "last_build": log_figures(events, *windows[-1])}))


if __name__ == "__main__":
    main()
