"""Plan shape of a load over Parquet tables: one hash exchange (the key),
the untouched history joined by broadcast without a shuffle, pruned scans."""

import contextlib
import io

from chronodim.plans.pipelines import PIPELINES
from chronodim.plans.scd2 import apply_scd2
from conftest import SF_SMALL


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _load(spark, tmp_path, name, **kw):
    p = PIPELINES[name]
    dim, stg = p.frames(spark, SF_SMALL)
    dim.write.parquet(str(tmp_path / "dim"))
    stg.write.parquet(str(tmp_path / "stg"))
    d, s = spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "stg"))
    return apply_scd2(d, s, p.spec, p.batch_ts, **kw), p


def test_one_shuffle_and_broadcast_split(spark, tmp_path):
    out, p = _load(spark, tmp_path, "pipe_merchant", skew="off")
    plan = _explain(out)
    hash_exchanges = [l for l in plan.splitlines() if "Arguments: hashpartitioning" in l]
    assert len(hash_exchanges) == 1, hash_exchanges
    assert "REPARTITION_BY_COL" in hash_exchanges[0]
    assert "BroadcastHashJoin LeftAnti" in plan and "BroadcastHashJoin LeftSemi" in plan
    assert plan.count("Sort (") <= 3


def test_version_partition_is_the_shuffle_key(spark, tmp_path):
    out, p = _load(spark, tmp_path, "pipe_merchant_chain", skew="off")
    hash_exchanges = [l for l in _explain(out).splitlines() if "Arguments: hashpartitioning" in l]
    assert len(hash_exchanges) == 1 and "merchant_code" in hash_exchanges[0] and "chain_code" not in hash_exchanges[0]


def test_staging_scan_is_pruned(spark, tmp_path):
    out, p = _load(spark, tmp_path, "pipe_utid", skew="off")
    plan = _explain(out)
    reads = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert reads and all("crtupd_dt" in r or "utid" in r for r in reads)
    assert "PushedFilters: [IsNotNull(utid)]" in plan


def test_bucket_split_plan(spark, tmp_path):
    spark.conf.set("chronodim.split.buckets", "8192")
    try:
        out, p = _load(spark, tmp_path, "pipe_merchant", skew="off", split="buckets")
        plan = _explain(out)
    finally:
        spark.conf.unset("chronodim.split.buckets")
    assert "xxhash64" in plan and "BroadcastHashJoin LeftAnti" in plan
    hash_exchanges = [l for l in plan.splitlines() if "Arguments: hashpartitioning" in l]
    # one shuffle of rows (the load); the others only dedupe the bounded bucket set
    assert sum("REPARTITION_BY_COL" in l for l in hash_exchanges) == 1, hash_exchanges
    assert all("_bucket" in l for l in hash_exchanges if "REPARTITION_BY_COL" not in l), hash_exchanges
