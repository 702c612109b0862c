"""Wall time of the headline loads at one core count and scale factor (one
process per setting: local[N] is fixed per JVM).

    python tools/scaling.py --cores 2 --sf /root/testdata/sf0.1
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from chronodim.plans.pipelines import PIPELINES  # noqa: E402
from chronodim.plans.scd2 import apply_scd2  # noqa: E402
from chronodim.session import local_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--cores", type=int, default=4)
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--reps", type=int, default=3)
    a = ap.parse_args()
    spark = local_session(cores=a.cores, shuffle_partitions=max(4, 2 * a.cores), app="chronodim-scaling")
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="chronodim-scaling-")
    inputs = {}
    for name in HEADLINE:
        dim, stg = PIPELINES[name].frames(spark, a.sf)
        dim.write.parquet(f"{scratch}/{name}/dim")
        stg.write.parquet(f"{scratch}/{name}/stg")
        inputs[name] = (spark.read.parquet(f"{scratch}/{name}/dim"), spark.read.parquet(f"{scratch}/{name}/stg"))

    def run(name):
        p = PIPELINES[name]
        apply_scd2(*inputs[name], p.spec, p.batch_ts).write.format("noop").mode("overwrite").save()

    run(HEADLINE[0])
    times = {}
    for name in HEADLINE:
        samples = []
        for _ in range(a.reps):
            t0 = time.perf_counter()
            run(name)
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    rows = {n: inputs[n][0].count() + inputs[n][1].count() for n in HEADLINE}
    print(json.dumps({"cores": a.cores, "sf": os.path.basename(a.sf), "sec": times, "input_rows": rows}))


if __name__ == "__main__":
    main()
