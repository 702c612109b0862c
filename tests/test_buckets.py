"""Bucketed tables: a load touches only its batch's buckets, commits by manifest, keeps other
columns; broadcasts are bounded by measured bytes."""

import os

import pytest
from pyspark.sql import functions as F

from chronodim import DimSpec, apply_scd2
from chronodim.operators import checked_broadcast
from chronodim.plans.pipelines import PIPELINES
from chronodim.sources.buckets import (create_table, data_path, latest_manifest, load_table, manifest_path,
                                       read_table)
from chronodim.sources.io import publish, read_dim
from conftest import SF_SMALL

SPEC = DimSpec(name="d", keys=(("k", "src_k"),), tracked=(("a", "src_a"),), ts="at")
DIM = "k bigint, a string, note string, version int, lastversion boolean, date_from timestamp_ntz, date_to timestamp_ntz"


def _bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _dim(spark, n=40):
    return spark.range(n).select(
        F.col("id").alias("k"), F.lit("x").alias("a"), F.concat(F.lit("n"), "id").alias("note"), F.lit(1).alias("version"),
        F.lit(True).alias("lastversion"), F.expr("timestamp_ntz'2020-01-01'").alias("date_from"),
        F.expr("timestamp_ntz'2200-01-01'").alias("date_to"))


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), "src_k int, src_a string").withColumn("at", F.expr("timestamp_ntz'2021-01-01'"))


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs}


def test_one_key_batch_writes_one_bucket(spark, tmp_path):
    root = str(tmp_path / "t")
    dim, batch = _dim(spark), _batch(spark, (7, "y"))
    first = create_table(dim, root, ["k"], 16)
    before = _files(root)
    second = load_table(spark, root, batch, SPEC)
    after = _files(root)
    assert all(after[f] == t for f, t in before.items())
    m = latest_manifest(spark, root)
    assert sorted(set(m["data"].values())) == [first, second] and list(m["data"].values()).count(second) == 1
    assert len([d for d in os.listdir(data_path(root, second)) if d.startswith("_bucket=")]) == 1
    assert _bag(read_table(spark, root)) == _bag(apply_scd2(dim, batch, SPEC))
    assert load_table(spark, root, batch.limit(0), SPEC) == second          # an empty batch changes nothing


def test_crash_retry_and_second_writer(spark, tmp_path):
    root = str(tmp_path / "t")
    dim, batch = _dim(spark), _batch(spark, (7, "y"), (99, "z"), (None, "q"))
    create_table(dim, root, ["k"], 8)
    _dim(spark, 3).write.parquet(data_path(root, 2) + "/_bucket=0")         # died before its manifest
    with open(manifest_path(root, 3), "w") as f:
        f.write("{\"buckets\": 8, ")                                       # died in its manifest
    assert _bag(read_table(spark, root)) == _bag(dim)
    assert load_table(spark, root, batch, SPEC) == 4
    assert _bag(read_table(spark, root)) == _bag(apply_scd2(dim, batch, SPEC))
    from chronodim.sources.buckets import _commit
    with pytest.raises(Exception):
        _commit(spark, root, 4, {})
    with pytest.raises(ValueError):
        load_table(spark, root, batch, DimSpec(name="o", keys=(("a", "src_a"),), tracked=(("note", "src_k"),), ts="at"))


@pytest.mark.parametrize("skew", ["off", "all"])
def test_other_columns_stay(spark, skew):
    dim, batch = _dim(spark, 4), _batch(spark, (1, "y"), (9, "z"))
    got = {(r.k, r.version): r.note for r in apply_scd2(dim, batch, SPEC, skew=skew).collect()}
    assert got == {(0, 1): "n0", (1, 1): "n1", (1, 2): None, (2, 1): "n2", (3, 1): "n3", (9, 1): None}
    own = apply_scd2(dim.drop("note"), batch, SPEC, skew=skew)
    assert _bag(own) == _bag(apply_scd2(dim, batch, SPEC, skew=skew).drop("note"))


def test_two_loads_of_one_dimension_keep_each_others_columns(spark, tmp_path):
    m, c = PIPELINES["pipe_merchant"], PIPELINES["pipe_merchant_chain"]
    dim, stg = m.frames(spark, SF_SMALL)
    root = str(tmp_path / "dim")
    publish(dim.withColumn("other", F.lit("kept")), root)
    got = read_dim(spark, root, m.spec, other_columns=True)
    assert "other" in got.columns and "other" not in read_dim(spark, root, m.spec).columns
    nxt = apply_scd2(got, stg, m.spec, m.batch_ts)
    assert nxt.where("other = 'kept'").count() == dim.count()
    assert set(m.spec.partition_cols) == set(c.spec.partition_cols)          # they can share a bucketed table


def test_broadcast_bound_counts_real_bytes(spark):
    spark.conf.set("chronodim.broadcast.maxBytes", "100000")
    try:
        short = spark.range(100).select(F.lit("x").alias("k"))
        long = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("k"))
        assert checked_broadcast(short)[1:] == (100, True)
        assert checked_broadcast(long)[1:] == (100, False)
        assert checked_broadcast(spark.range(100).select(F.struct(F.repeat(F.lit("x"), 1000).alias("s")).alias("k")))[2] is False
    finally:
        spark.conf.unset("chronodim.broadcast.maxBytes")


def test_registered_load_leaves_buckets_untouched(spark, tmp_path):
    """The batch of the query bucketed_load touches some of its buckets only."""
    p = PIPELINES["pipe_merchant"]
    dim, stg = p.frames(spark, SF_SMALL)
    root = str(tmp_path / "t")
    first = create_table(dim, root, p.spec.partition_cols, 256)
    second = load_table(spark, root, stg, p.spec, p.batch_ts)
    held = list(latest_manifest(spark, root)["data"].values())
    assert first in held and second in held
