"""Job and stage times of a load from Spark's event log (the Spark UI stays off).

    python tools/stage_times.py --load pipe_btid --sf /root/testdata/sf0.1

Runs the load once to warm up and once with the event log written to a fresh
scratch folder, then prints one line per job and stage of the second run.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder: str):
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True) + glob.glob(f"{folder}/*.inprogress")):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            yield json.loads(line)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--load", default="pipe_btid")
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    from pyspark.sql import SparkSession

    from chronodim.plans.pipelines import PIPELINES
    from chronodim.plans.scd2 import apply_scd2
    logs = tempfile.mkdtemp(prefix="chronodim-eventlog-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    p = PIPELINES[a.load]
    scratch = tempfile.mkdtemp(prefix="chronodim-stages-")
    dim, stg = p.frames(spark, a.sf)
    dim.write.parquet(f"{scratch}/dim")
    stg.write.parquet(f"{scratch}/stg")
    d, s = spark.read.parquet(f"{scratch}/dim"), spark.read.parquet(f"{scratch}/stg")
    spark.sparkContext.setJobGroup("warmup", "warm-up run")
    apply_scd2(d, s, p.spec, p.batch_ts).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("load", "timed run")
    apply_scd2(d, s, p.spec, p.batch_ts).write.format("noop").mode("overwrite").save()
    spark.stop()

    jobs, stages = {}, {}
    for e in read_events(logs):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            jobs[e["Job ID"]] = {"group": group, "start": e["Submission Time"],
                                 "stages": [si["Stage ID"] for si in e["Stage Infos"]]}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"].split(" at ")[0], si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0))
    for j, info in sorted(jobs.items()):
        if info["group"] != "load":
            continue
        print(f"job {j}: {info.get('end', info['start']) - info['start']} ms")
        for sid in info["stages"]:
            if sid in stages:
                name, tasks, ms = stages[sid]
                print(f"   stage {sid} {name}: {tasks} tasks, {ms} ms")


if __name__ == "__main__":
    main()
