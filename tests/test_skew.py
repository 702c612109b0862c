"""The hot-key path (aggregates, range-sliced ranks and leads) gives the rows
of the window path, for every load; keys route by the hot-key threshold."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronodim.operators.ordered import lead_within, rank_within
from chronodim.plans.pipelines import PIPELINES
from chronodim.plans.scd2 import apply_scd2, hot_keys
from conftest import SF_SMALL


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(PIPELINES))
def test_hot_path_equals_window_path(spark, name):
    p = PIPELINES[name]
    dim, stg = p.frames(spark, SF_SMALL)
    want = _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, skew="off"))
    assert _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, skew="all")) == want


def test_threshold_routes_some_keys(spark):
    p = PIPELINES["pipe_pan_info"]
    dim, stg = p.frames(spark, SF_SMALL)
    spark.conf.set("chronodim.skew.hotKeyRows", "3")
    try:
        from chronodim.operators.versions import map_columns
        s = map_columns(stg, p.spec)
        hk = hot_keys(dim, s, p.spec, "auto")
        n_hot, n_all = hk.count(), s.select(*p.spec.key_cols).distinct().count()
        assert 0 < n_hot < n_all
        got = _bag(apply_scd2(dim, stg, p.spec, p.batch_ts))
    finally:
        spark.conf.unset("chronodim.skew.hotKeyRows")
    assert got == _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, skew="off"))


def test_ordered_helpers_match_windows(spark):
    random.seed(7)
    rows = [(random.choice([1, 2, 2, 2, 2, 3]), i, float(i % 97)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, o int, v double").repartition(5)
    w = Window.partitionBy("g").orderBy("o")
    want = df.withColumn("rn", F.row_number().over(w)).withColumn("nx", F.lead("v").over(w))
    got = lead_within(rank_within(df, ["g"], ["o"], "rn"), ["g"], ["o"], "v", "nx")
    assert _bag(got.select("g", "o", "v", "rn", "nx")) == _bag(want.select("g", "o", "v", "rn", "nx"))


def test_real_skew_event_history(spark):
    """A dimension keyed by event type: five keys, each about a fifth of all
    rows.  Auto detection sends every key to the hot path; the rows equal the
    window path."""
    from pyspark.sql import Window as W

    from chronodim import DimSpec
    from chronodim.functions.columns import open_end, ts_literal
    from chronodim.sources.fixtures import table

    ev = table(spark, SF_SMALL, "events").select(
        "event_type", "event_id", "ts", F.floor(F.col("value") / 25).cast("int").alias("target"))
    cut = ts_literal("2024-01-20 00:00:00")
    w = W.partitionBy("event_type").orderBy("ts", "event_id")
    nxt = F.lead("ts").over(w)
    dim = ev.where(F.col("ts") < cut).select(
        "event_type", "target", "event_id", F.row_number().over(w).cast("int").alias("version"),
        nxt.isNull().alias("lastversion"), F.col("ts").alias("date_from"),
        F.coalesce(nxt, open_end()).alias("date_to"))
    stg = ev.where(F.col("ts") >= cut).select(
        F.col("event_type").alias("src_type"), F.col("target").alias("src_target"),
        F.col("event_id").alias("src_event_id"), F.col("ts").alias("src_ts"))
    spec = DimSpec(name="event_history", keys=(("event_type", "src_type"),),
                   tracked=(("target", "src_target"),), payload=(("event_id", "src_event_id"),),
                   ts="src_ts", tiebreak=("event_id",))
    want = _bag(apply_scd2(dim, stg, spec, skew="off"))
    spark.conf.set("chronodim.skew.hotKeyRows", "100")
    try:
        from chronodim.operators.versions import map_columns
        s = map_columns(stg, spec)
        hk = hot_keys(dim, s, spec, "auto")
        assert hk.count() == 5
        got = _bag(apply_scd2(dim, stg, spec))
    finally:
        spark.conf.unset("chronodim.skew.hotKeyRows")
    assert got == want


def test_stepwise_skewed_forms(spark):
    """number_versions / next_start with skewed=True equal their window forms."""
    from chronodim.operators import flags as fl
    from chronodim.operators import versions as vs
    from chronodim.plans.queries import G
    p = G["fx2"]
    dim, stg = p.frames(spark, SF_SMALL)
    s = vs.map_columns(stg, p.spec)
    chg = vs.changed_rows(s, dim, p.spec)
    assert _bag(vs.number_versions(chg, p.spec, skewed=True)) == _bag(vs.number_versions(chg, p.spec))
    for scope in ("touched", "batch"):
        assert _bag(fl.next_start(dim, s, p.spec.key_cols, scope, skewed=True)) == \
            _bag(fl.next_start(dim, s, p.spec.key_cols, scope))


@pytest.mark.parametrize("limit", [3, 5, 8])
def test_a_numbering_group_is_never_divided(spark, limit):
    """Numbering over a part of the key: its groups go to one path or the other whole."""
    p = PIPELINES["pipe_merchant_chain"]
    dim, stg = p.frames(spark, SF_SMALL)
    want = _bag(apply_scd2(dim, stg, p.spec, p.batch_ts, skew="off"))
    spark.conf.set("chronodim.skew.hotKeyRows", str(limit))
    try:
        assert _bag(apply_scd2(dim, stg, p.spec, p.batch_ts)) == want
    finally:
        spark.conf.unset("chronodim.skew.hotKeyRows")


def test_ordered_helpers_without_a_checkpoint_directory(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    n = 200_000
    df = spark.range(n, numPartitions=16).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % n).alias("o"))
    bad = rank_within(df, ["g"], ["o"], "rn").where("rn <> o + 1").count()
    got = lead_within(df, ["g"], ["o"], "o", "nx").where(f"nx <> o + 1 or (nx is null) <> (o = {n - 1})").count()
    assert (bad, got) == (0, 0)
