"""Loads driven by a staging stream: one snapshot per micro-batch, equal to the
batch load, and a re-delivered epoch is skipped."""

import pytest

from chronodim import DimSpec
from chronodim.plans.pipelines import PIPELINES
from chronodim.plans.scd2 import apply_scd2
from chronodim.sources import buckets
from chronodim.sources.buckets import create_table, latest_manifest, load_table, read_table
from chronodim.sources.io import publish, read_dim, snapshots
from chronodim.sources.origins import holds, with_origin
from chronodim.streaming import load_batch, start_loads
from conftest import SF_SMALL


def test_stream_of_batches(spark, tmp_path):
    p = PIPELINES["pipe_merchant"]
    dim, stg = p.frames(spark, SF_SMALL)
    root, stg_dir = str(tmp_path / "dim"), str(tmp_path / "stg")
    publish(dim, root, 1)
    stg.write.parquet(stg_dir)
    stream = spark.readStream.schema(stg.schema).parquet(stg_dir)
    q = start_loads(stream, root, p.spec, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    assert snapshots(spark, root) == [1, 2]
    want = apply_scd2(dim, stg, p.spec)
    got = read_dim(spark, root, p.spec)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    # the same epoch of the same stream delivered again is skipped
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", str(q.id))
    try:
        assert load_batch(stg, 0, root, p.spec) is None
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert snapshots(spark, root) == [1, 2]


def test_existing_snapshots_and_half_written_ones(spark, tmp_path):
    """Epoch 0 of a new stream is loaded beside snapshots 1 and 2; delivered again it is
    skipped; after a crash in the middle of its write it is loaded under a new id."""
    import os
    from chronodim.plans.pipelines import PIPELINES
    from chronodim.sources.io import claim, publish, snapshots
    from chronodim.streaming.loader import load_batch
    from conftest import SF_SMALL
    p = PIPELINES["pipe_chain_upsert"]
    dim, stg = p.frames(spark, SF_SMALL)
    root = str(tmp_path / "dim")
    publish(dim, root)
    publish(dim, root)
    assert load_batch(stg, 0, root, p.spec) is not None and snapshots(spark, root) == [1, 2, 3]
    assert load_batch(stg, 0, root, p.spec) is None and snapshots(spark, root) == [1, 2, 3]
    claim(spark, root, 4, {"manual": [[0, 1]]})                          # epoch 1 died in its write
    os.makedirs(f"{root}/{os.path.basename(load_batch(stg, 7, root, p.spec))}".replace("000005", "000006"))
    assert load_batch(stg, 5, root, p.spec).endswith("000007")
    assert load_batch(stg, 1, root, p.spec).endswith("000008")
    assert [load_batch(stg, e, root, p.spec) for e in (0, 1, 5, 7)] == [None] * 4
    assert snapshots(spark, root) == [1, 2, 3, 5, 7, 8]


SPEC = DimSpec(name="d", keys=(("k", "src_k"),), tracked=(("a", "src_a"),), ts="at")


def _dim(spark):
    return spark.range(0).selectExpr("id AS k", "'x' AS a", "1 AS version", "true AS lastversion",
                                     "timestamp_ntz'2020-01-01' AS date_from", "timestamp_ntz'2200-01-01' AS date_to")


def _batch(spark, k):
    return spark.range(k, k + 1).selectExpr("id AS src_k", "'y' AS src_a", "timestamp_ntz'2021-01-01' AS at")


@pytest.mark.parametrize("bucketed", [False, True])
def test_a_foreign_load_between_crash_and_redelivery_loses_no_batch(spark, tmp_path, monkeypatch, bucketed):
    """Epoch 0 dies in its write, another load takes the next id, epoch 0 is delivered again."""
    root = str(tmp_path / "dim")
    if bucketed:
        create_table(_dim(spark), root, ["k"], 16)
    else:
        publish(_dim(spark), root)

    def dies(*a, **kw):
        raise OSError("the driver is lost")
    with monkeypatch.context() as m:                # after the claim, or after the data and before the manifest
        m.setattr(buckets, "_commit", dies) if bucketed else m.setattr("pyspark.sql.DataFrameWriter.parquet", dies)
        with pytest.raises(OSError):
            load_batch(_batch(spark, 1), 0, root, SPEC)
    if bucketed:
        load_table(spark, root, _batch(spark, 2), SPEC)
    else:
        publish(apply_scd2(read_dim(spark, root, SPEC), _batch(spark, 2), SPEC), root)

    def keys():
        return sorted(r.k for r in (read_table(spark, root) if bucketed else read_dim(spark, root, SPEC)).collect())
    assert keys() == [2]
    assert load_batch(_batch(spark, 1), 0, root, SPEC) is not None and keys() == [1, 2]
    assert load_batch(_batch(spark, 1), 0, root, SPEC) is None
    # a load by command line takes the record over
    if bucketed:
        load_table(spark, root, _batch(spark, 3), SPEC)
    else:
        publish(apply_scd2(read_dim(spark, root, SPEC), _batch(spark, 3), SPEC), root)
    assert load_batch(_batch(spark, 1), 0, root, SPEC) is None and keys() == [1, 2, 3]
    assert load_batch(_batch(spark, 4), 1, root, SPEC) is not None and keys() == [1, 2, 3, 4]


def test_stream_into_a_bucketed_table(spark, tmp_path):
    """Micro-batches of a stream; files of untouched buckets stay as they were."""
    root, stg = str(tmp_path / "dim"), str(tmp_path / "stg")
    create_table(_batch(spark, 0).limit(0).selectExpr("src_k AS k", "src_a AS a", "1 AS version", "true AS lastversion",
                                                      "at AS date_from", "at AS date_to"), root, ["k"], 64)
    load_table(spark, root, spark.range(100).selectExpr("id AS src_k", "'x' AS src_a", "timestamp_ntz'2020-01-01' AS at"), SPEC)
    before = latest_manifest(spark, root)["data"]
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "dim").rglob("*.parquet")}
    for k in (7, 8, 200):
        _batch(spark, k).coalesce(1).write.mode("append").parquet(stg)
    stream = spark.readStream.schema(_batch(spark, 0).schema).option("maxFilesPerTrigger", 1).parquet(stg)
    q = start_loads(stream, root, SPEC, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    m = latest_manifest(spark, root)
    assert m["loaded"] == {str(q.id): [[0, 2]]}
    assert len({b for b, i in m["data"].items() if before.get(b) != i}) <= 3
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    got = sorted((r.k, r.version, r.a) for r in read_table(spark, root).collect())
    assert got == sorted([(k, 1, "x") for k in range(100)] + [(7, 2, "y"), (8, 2, "y"), (200, 1, "y")])


def test_ranges_of_epochs():
    loaded = {}
    for epoch in (0, 1, 2, 7, 5, 6, 1):
        loaded = with_origin(loaded, ("s", epoch))
    assert loaded == {"s": [[0, 2], [5, 7]]} and with_origin(loaded, None) is loaded
    assert [holds(loaded, ("s", e)) for e in range(9)] == [True] * 3 + [False] * 2 + [True] * 3 + [False]
    assert not holds(loaded, ("t", 0))
