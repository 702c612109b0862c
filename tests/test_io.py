"""S6 snapshot publish: all-or-nothing, newest committed snapshot wins."""

import os

from pyspark.sql import functions as F

from chronodim.sources.io import publish, read_dim, read_latest, read_staging, snapshot_path, snapshots
from chronodim.plans.pipelines import PIPELINES
from conftest import SF_SMALL


def test_publish_and_read_latest(spark, tmp_path):
    root = str(tmp_path / "dim")
    df1 = spark.range(5).withColumn("v", F.lit(1))
    df2 = spark.range(7).withColumn("v", F.lit(2))
    p1 = publish(df1, root)
    p2 = publish(df2, root)
    assert p1 != p2 and snapshots(spark, root) == [1, 2]
    got = read_latest(spark, root)
    assert got.count() == 7 and {r.v for r in got.collect()} == {2}


def test_crashed_snapshot_is_ignored(spark, tmp_path):
    root = str(tmp_path / "dim")
    publish(spark.range(3).withColumn("v", F.lit(1)), root)
    # a load that died mid-write: files but no _SUCCESS marker
    broken = snapshot_path(root, 2)
    spark.range(100).withColumn("v", F.lit(9)).write.parquet(broken)
    os.remove(os.path.join(broken, "_SUCCESS"))
    assert snapshots(spark, root) == [1]
    assert {r.v for r in read_latest(spark, root).collect()} == {1}
    # the retry does not reuse the half-written directory
    p3 = publish(spark.range(4).withColumn("v", F.lit(3)), root)
    assert p3.endswith("snapshot=000000000003")
    assert {r.v for r in read_latest(spark, root).collect()} == {3}


def test_load_round_trip_through_snapshots(spark, tmp_path):
    from chronodim.plans.scd2 import apply_scd2
    p = PIPELINES["pipe_merchant"]
    dim, stg = p.frames(spark, SF_SMALL)
    root = str(tmp_path / "merchant")
    publish(dim, root, partition_by=["lastversion"])
    stg_path = str(tmp_path / "stg")
    stg.write.parquet(stg_path)
    nxt = apply_scd2(read_dim(spark, root, p.spec), read_staging(spark, stg_path, p.spec), p.spec)
    publish(nxt, root, partition_by=["lastversion"])
    assert snapshots(spark, root) == [1, 2]
    latest = read_dim(spark, root, p.spec)
    assert latest.count() == apply_scd2(dim, stg, p.spec).count()
    # exactly one current row per key that has history
    per_key = latest.where("lastversion").groupBy("merchant_code").count()
    assert per_key.where("count > 1").count() == 0


def test_command_line_load(spark, tmp_path):
    """python -m chronodim: read the newest snapshot, load, publish the next."""
    from chronodim.__main__ import main
    p = PIPELINES["pipe_dc_emi"]
    dim, stg = p.frames(spark, SF_SMALL)
    root, stg_path = str(tmp_path / "dc_emi"), str(tmp_path / "stg")
    publish(dim, root)
    stg.write.parquet(stg_path)
    main(["--load", "dc_emi", "--dim", root, "--staging", stg_path])
    assert snapshots(spark, root) == [1, 2]
    from chronodim.plans.scd2 import apply_scd2
    want = apply_scd2(dim, stg, p.spec)
    got = read_dim(spark, root, p.spec)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
