"""A load's work and memory as its tables grow: inputs are made once, tasks hold a bounded
number of rows, and the rows of repeated new keys are made after the shuffle."""

from dataclasses import replace

import pytest
from pyspark.sql import Row

from chronodim.plans import scd2
from chronodim.plans.pipelines import PIPELINES, run_pipeline
from chronodim.plans.scd2 import apply_scd2
from chronodim.plans.stepwise import apply_stepwise
from chronodim.spec import DimSpec
from chronodim.sources import fixtures as fx
from conftest import SF_SMALL

SPEC = DimSpec(name="d", keys=(("k", "k"),), tracked=(("a", "a"), ("b", "b")), carry=(("c", "ts"),), ts="ts")


def _tables(spark):
    import datetime as dt
    day = [dt.datetime(2024, 1, i) for i in range(1, 9)]
    dim = spark.createDataFrame(
        [(1, "x", 1, day[0], 1, True, day[0], dt.datetime(2200, 1, 1))],
        "k int, a string, b int, c timestamp_ntz, version int, lastversion boolean, date_from timestamp_ntz, date_to timestamp_ntz")
    rows = [(1, "y", 2, day[1]), (1, "z", 2, day[2]), (None, "q", 1, day[1])]
    rows += [(2, a, b, day[i]) for i, (a, b) in enumerate([("x", 1), ("x", 1), ("y", None), (None, None), ("y", 2)])]
    rows += [(k, "x", k % 3, day[k % 7]) for k in range(3, 40)] + [(3, "w", 9, day[3])] * 3
    return dim, spark.createDataFrame(rows, "k int, a string, b int, ts timestamp_ntz")


def _bag(df):
    return sorted(map(repr, df.collect()))


def _exchanges(df):
    return [l for l in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in l]


@pytest.mark.parametrize("mode", ["upsert", "close_previous"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_repeated_new_keys_are_compared_after_the_shuffle(spark, mode, null_safe):
    dim, s = _tables(spark)
    spec = replace(SPEC, mode=mode, null_safe=null_safe)
    at = "2024-02-01 00:00:00"
    expected = _bag(apply_stepwise(dim, s, spec, at).select(*spec.dim_cols))
    out = apply_scd2(dim, s, spec, at, split="never")
    assert len(_exchanges(out)) == 1            # neither the pairs nor the rows made from them are shuffled
    assert _bag(out) == expected
    for most in ("1", "3"):                     # all, or the keys staged more often, by joins of classes
        spark.conf.set("chronodim.repeats.inTask", most)
        try:
            assert _bag(apply_scd2(dim, s, spec, at)) == expected
        finally:
            spark.conf.unset("chronodim.repeats.inTask")


def test_tasks_follow_the_rows(spark, monkeypatch):
    dim, s = _tables(spark)
    expected = _bag(apply_scd2(dim, s, SPEC))
    monkeypatch.setattr(scd2, "ROWS_A_TASK", 1)
    out = apply_scd2(dim, s, SPEC)
    # 47 staged rows with a key, and 20 + 4 * 3 pairs of the keys 2 and 3
    split = [l for l in _exchanges(out) if "REPARTITION_BY_NUM" in l]
    assert len(split) == 1 and int(split[0].rsplit("), REPARTITION")[0].rsplit(", ", 1)[1].rstrip(")")) > 47
    assert _bag(out) == expected


@pytest.mark.parametrize("name", ["pipe_btid", "pipe_bank_terminal", "pipe_kpi_close", "pipe_kpi_upsert"])
def test_inputs_are_made_once(spark, name):
    """The load reads its inputs from a table; no step runs their windows again."""
    plan = run_pipeline(spark, SF_SMALL, name)._jdf.queryExecution().analyzed().toString()
    assert "lineitem" not in plan and "l_shipdate" not in plan and "event_id" not in plan


def test_fixture_rows_without_the_kept_table(spark, tmp_path):
    """One window deals a log out as a rank over the log and a history of the rest did."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [Row(event_id=i, ts=None if i == 5 else i % 9, user_id=None if i % 11 == 0 else i % 7,
                event_type="ab"[i % 2], value=float(i)) for i in range(200)]
    ev = spark.createDataFrame(rows, "event_id long, ts int, user_id long, event_type string, value double")
    ev = ev.withColumn("ts", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.col("ts"))).cast("timestamp_ntz"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    dim, stg = fx.fx4(spark, str(tmp_path))
    log = ev.select(F.col("event_type").alias("kpi_name"), F.month("ts").alias("mon"), F.year("ts").alias("yr"),
                    F.col("user_id").alias("category"), F.floor(F.col("value") / 25).cast("int").alias("target"), "ts", "event_id")
    keys = ["kpi_name", "mon", "yr", "category"]
    ranked = log.withColumn("rd", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("event_id"))))
    staged = ((F.col("category") % 4) == 0) | ((F.col("rd") == 1) & ((F.col("category") % 3) != 0))
    assert _bag(dim) == _bag(fx._history(ranked.where(~staged), keys, ["ts", "event_id"], ["target"]))
    assert _bag(stg.toDF("a", "b", "c", "d", "e", "f")) == _bag(ranked.where(staged).select(*keys, "target", "ts").toDF("a", "b", "c", "d", "e", "f"))
    assert set(PIPELINES["pipe_kpi_close"].frames(spark, SF_SMALL)[0].columns) > {"kpi_name", "version"}
