"""Benchmark the headline queries.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS], fully
executing the plan into Spark's ``noop`` sink (nothing is collected to the driver): one warm-up,
then the median of three timed runs.  Shuffle bytes written and input rows of the first timed run
come from Spark's event log (written to a fresh local folder; each run is tagged with a job
group).  Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harmonia.queries import QUERIES  # noqa: E402
from harmonia.session import build_session  # noqa: E402

HEADLINE = [
    "q_lesion_pivot", "q_valve_wide", "q_valve_map", "q_dx_flags", "q_med_parse", "q_med_union",
    "q_lab_union", "q_merge_versions", "q_redact_id", "q_code_clean", "q_date_mixed", "q_table_infer",
    "q_canonical_schema", "q_sanitize_names", "q_ledger_anti", "q_clean_ecg_iecg", "q_clean_ehr_patient",
    "q_export_date",
]


def run_once(spark, name, sf_dir, tag) -> float:
    spark.sparkContext.setJobGroup(tag, tag)
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def task_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """job group -> {shuffle_bytes, input_rows} summed over the tasks of its jobs."""
    stage_group, out = {}, {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in paths:
        if "appstatus" in os.path.basename(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if group is None:
                        continue
                    acc = out.setdefault(group, {"shuffle_bytes": 0, "input_rows": 0})
                    acc["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    acc["input_rows"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    log_dir = tempfile.mkdtemp(prefix="harmonia-bench-eventlog-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": "file://" + log_dir, "spark.eventLog.compress": "false"})
    results = {}
    for name in names:
        warm = run_once(spark, name, sf_dir, f"{name}#warm")
        runs = [run_once(spark, name, sf_dir, f"{name}#{i}") for i in range(3 if warm < 60 else 1)]
        results[name] = round(statistics.median(runs), 3)
    version = spark.version
    spark.stop()   # flushes the event log
    metrics = task_metrics(log_dir)
    detail = {n: {"sec": results[n], **metrics.get(f"{n}#0", {})} for n in names}
    for d in detail.values():
        if d.get("input_rows"):
            d["rows_per_sec"] = round(d["input_rows"] / d["sec"]) if d["sec"] else None
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "detail": detail, "sf": sf, "cpus": int(cpus), "spark": version}))


if __name__ == "__main__":
    main()
