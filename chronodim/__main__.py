"""Run one of the seventeen loads on real tables and publish the next snapshot.

    python -m chronodim --load merchant --dim /lake/dim/merchant \\
        --staging /lake/stg/merchant/2024-06-01 [--batch-ts "2024-06-01 02:00:00"] \\
        [--format parquet|table] [--partition-by lastversion]

``--dim`` is a snapshot root (the newest committed snapshot is read and the
result is published next to it), a bucketed table (``sources/buckets.py``: only the buckets
that the batch touches are read and written) or, with ``--format table``, a catalog table
whose result is published under ``--out``.  The session (master, shuffle
partitions, ``spark.checkpoint.dir``) comes from ``spark-submit`` / the cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans.pipelines import PIPELINES
from .plans.scd2 import apply_scd2
from .sources.buckets import latest_manifest, load_table, manifest_path
from .sources.io import publish, read_dim, read_staging

LOADS = {name.removeprefix("pipe_"): p.spec for name, p in PIPELINES.items()}


def main(argv=None):
    ap = argparse.ArgumentParser(prog="chronodim", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--list", action="store_true", help="print the loads and exit")
    ap.add_argument("--load", choices=sorted(LOADS))
    ap.add_argument("--dim")
    ap.add_argument("--staging")
    ap.add_argument("--out", help="snapshot root to publish to (default: --dim)")
    ap.add_argument("--format", default="parquet", help="parquet (paths) or table (catalog names)")
    ap.add_argument("--batch-ts", help="batch clock for batch-clock loads (default: now, UTC)")
    ap.add_argument("--partition-by", nargs="*", default=["lastversion"])
    a = ap.parse_args(argv)
    if a.list:
        for name, spec in sorted(LOADS.items()):
            print(f"{name:24s} {spec.name:34s} {spec.mode:15s} key={','.join(spec.key_cols)}")
        return
    if not (a.load and a.dim and a.staging):
        ap.error("--load, --dim and --staging are required")
    if a.format == "table" and not a.out:
        ap.error("--format table needs --out, the snapshot root to publish to")

    spec = LOADS[a.load]
    spark = SparkSession.builder.appName(f"chronodim-{a.load}").getOrCreate()
    batch_ts = a.batch_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    if a.format == "parquet" and not a.out and latest_manifest(spark, a.dim):
        print(manifest_path(a.dim, load_table(spark, a.dim, a.staging, spec, batch_ts)))
        return
    nxt = apply_scd2(read_dim(spark, a.dim, spec, a.format, other_columns=True), read_staging(spark, a.staging, spec, a.format),
                     spec, batch_ts)
    out = a.out or a.dim
    print(publish(nxt, out, partition_by=a.partition_by or None))


if __name__ == "__main__":
    main()
