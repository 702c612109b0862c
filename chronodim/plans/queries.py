"""

Every query reads whole fixture tables and applies one operator (or the short
chain of statements the operator needs to see, e.g. the inserts before an
update).  Staged rows are shown in dimension names with the staged timestamp
as ``staged_ts``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import due
from ..operators import flags as fl
from ..operators import versions as vs
from ..sources.io import read_dim, read_staging
from ..spec import DimSpec
from .pipelines import BATCH_TS, PIPELINES, Pipeline, run_bucketed
from .stepwise import insert_all, insert_changed, insert_new

LONG_HISTORY = 3      # versions per key reported by long_histories
DUE_TS = "2024-01-03 12:00:00"   # a batch date inside January 2024 where the two F9 forms differ on FX4

FX1_SPEC = DimSpec(name="fx1", keys=(("k", "src_k"),), tracked=(("seg", "src_seg"), ("nat", "src_nat")),
                   carry=(("configuration_date", "crtupd_dt"),), ts="crtupd_dt")
FX2_SPEC = DimSpec(name="fx2", keys=(("k1", "src_k1"), ("k2", "src_k2")),
                   tracked=(("st", "src_st"), ("amt", "src_amt")), ts="src_created_on")
FX3_SPEC = DimSpec(name="fx3", keys=(("k1", "k1"), ("k2", "k2"), ("k3", "k3")),
                   tracked=(("ls", "ls"), ("qty", "qty")), ts="crtupd_dt")
FX4_SPEC = DimSpec(name="fx4", keys=(("kpi_name", "src_kpi_name"), ("mon", "src_month"), ("yr", "src_year"),
                                     ("category", "src_category")),
                   tracked=(("target", "src_target"),), ts="src_created_on")

_ID1 = {"seg": "{seg}", "nat": "{nat}"}
_ID2 = {"st": "{st}", "amt": "{amt}"}
_ID3 = {"ls": "{ls}", "qty": "{qty}"}
_ID4 = {"target": "{target}"}

# fixture loads the operator queries run on (identity bindings: fixture names)
G = {
    "fx1": Pipeline("g_fx1", FX1_SPEC, "fx1", overrides=_ID1),
    "fx1_touched": Pipeline("g_fx1_touched", replace(FX1_SPEC, retire="touched", redate="touched"), "fx1",
                            overrides=_ID1),
    "fx1_close": Pipeline("g_fx1_close", replace(FX1_SPEC, carry=(), mode="close_previous", start="batch"),
                          "fx1", batch_ts=BATCH_TS, overrides=_ID1),
    "fx2": Pipeline("g_fx2", FX2_SPEC, "fx2", overrides=_ID2),
    "fx2_append": Pipeline("g_fx2_append", replace(FX2_SPEC, mode="append_all"), "fx2", overrides=_ID2),
    "fx2_narrow": Pipeline("g_fx2_narrow", replace(FX2_SPEC, version_partition=("k1",), tiebreak=("k2",)),
                           "fx2", overrides=_ID2),
    "fx3": Pipeline("g_fx3", FX3_SPEC, "fx3", overrides=_ID3),
    "fx4": Pipeline("g_fx4", FX4_SPEC, "fx4", overrides=_ID4),
    "fx4_close": Pipeline("g_fx4_close", replace(FX4_SPEC, mode="close_previous", start="batch", due="midnight"),
                          "fx4", batch_ts=BATCH_TS, overrides=_ID4),
}


def _ctx(spark: SparkSession, sf_dir: str, g: str):
    p = G[g]
    dim, stg = p.frames(spark, sf_dir)
    return dim.select(*p.spec.dim_cols), vs.map_columns(stg, p.spec), p.spec, p.batch_ts


def _staged(df: DataFrame, spec: DimSpec, *extra) -> DataFrame:
    return df.select(*spec.key_cols, *spec.attr_cols, F.col(vs.TS).alias("staged_ts"), *extra)


def _d2(spark, sf_dir, g):
    d, s, spec, bts = _ctx(spark, sf_dir, g)
    return insert_changed(insert_new(d, s, spec, bts), s, spec, bts), s, spec, bts


def q_current_version_scan(spark, sf_dir):
    d, _, _, _ = _ctx(spark, sf_dir, "fx1")
    return vs.current(d)


def q_insert_new_with_defaults(spark, sf_dir):
    d, s, spec, bts = _ctx(spark, sf_dir, "fx1")
    return insert_new(d, s, spec, bts)


def q_insert_new_dup_column(spark, sf_dir):
    p = PIPELINES["pipe_bank_terminal"]
    dim, stg = p.frames(spark, sf_dir)
    s = vs.map_columns(stg, p.spec)
    return vs.open_row(vs.new_rows(s, dim, p.spec), p.spec)


def q_carry_forward_config_date(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx1")
    return _staged(vs.changed_rows(s, d, spec), spec, "configuration_date", "cur_version")


def q_next_version_plus_one(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx1_close")
    return _staged(vs.next_version_plus_one(vs.changed_rows(s, d, spec)), spec, "version")


def q_append_version_numbers(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx2_append")
    return insert_all(d, s, spec)


def _due(how):
    def q(spark, sf_dir):
        d, s, spec, _ = _ctx(spark, sf_dir, "fx4")
        return fl.touched_rows(d, s, spec.key_cols).where(due(F.col("date_from"), DUE_TS, how))
    return q


def _changed(g, cols=None, null_safe=None):
    def q(spark, sf_dir):
        d, s, spec, _ = _ctx(spark, sf_dir, g)
        return _staged(vs.changed_rows(s, d, spec, cols=cols, null_safe=null_safe), spec, "cur_version")
    return q


def q_second_latest_version(spark, sf_dir):
    d, _, spec, _ = _ctx(spark, sf_dir, "fx2")
    return fl.second_latest(d, spec.key_cols)


def _new_keys(g):
    def q(spark, sf_dir):
        d, s, spec, _ = _ctx(spark, sf_dir, g)
        return _staged(vs.new_rows(s, d, spec), spec)
    return q


def q_batch_rows(spark, sf_dir):
    d2, s, spec, _ = _d2(spark, sf_dir, "fx1")
    return fl.batch_rows(d2, s, spec.key_cols)


def _max_touched(g):
    def q(spark, sf_dir):
        d, s, spec, _ = _ctx(spark, sf_dir, g)
        return vs.max_version(fl.touched_rows(d, s, spec.key_cols), spec.key_cols)
    return q


def q_max_version_all(spark, sf_dir):
    d, _, spec, _ = _ctx(spark, sf_dir, "fx2")
    return vs.max_version(d, spec.key_cols)


def q_max_version_batch(spark, sf_dir):
    d2, s, spec, _ = _d2(spark, sf_dir, "fx1")
    return vs.max_version(fl.batch_rows(d2, s, spec.key_cols), spec.key_cols)


def _next_version_rownum(g):
    def q(spark, sf_dir):
        d, s, spec, _ = _ctx(spark, sf_dir, g)
        return _staged(vs.number_versions(vs.changed_rows(s, d, spec), spec, "cur_version"), spec, "version")
    return q


def q_next_start_touched(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx2")
    return fl.next_start(d, s, spec.key_cols, "touched")


def q_next_start_batch(spark, sf_dir):
    d2, s, spec, _ = _d2(spark, sf_dir, "fx1")
    return fl.next_start(d2, s, spec.key_cols, "batch")


def q_flag_off_touched(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx1")
    return fl.flag_off_touched(d, s, spec.key_cols)


def q_flag_on_latest(spark, sf_dir):
    d, s, spec, _ = _ctx(spark, sf_dir, "fx2_append")
    return fl.flag_on_latest(insert_all(d, s, spec), s, spec.key_cols)


def _retire(g, scope):
    def q(spark, sf_dir):
        d2, s, spec, _ = _d2(spark, sf_dir, g)
        return fl.retire_older(d2, s, spec.key_cols, scope)
    return q


def _redate(scope):
    def q(spark, sf_dir):
        d2, s, spec, _ = _d2(spark, sf_dir, "fx1")
        return fl.redate(d2, s, spec.key_cols, scope)
    return q


def q_long_histories(spark, sf_dir):
    from ..operators.reports import long_histories
    d, _, spec, _ = _ctx(spark, sf_dir, "fx2")
    return long_histories(d, spec, LONG_HISTORY)


def _close(g):
    def q(spark, sf_dir):
        d2, s, spec, bts = _d2(spark, sf_dir, g)
        return fl.close_previous(d2, s, spec.key_cols, bts, spec.due, spec.close_at)
    return q


#: The orders table as a staging batch.
ORDER_BATCH = DimSpec(name="orders", keys=(("customer", "o_custkey"), ("priority", "o_orderpriority")),
                      tracked=(("status", "o_orderstatus"), ("price", "o_totalprice")), ts="o_orderdate")


def q_staging_scan(spark, sf_dir):
    return read_staging(spark, f"{sf_dir.rstrip('/')}/orders.parquet", ORDER_BATCH)


def q_dimension_scan(spark, sf_dir):
    p = PIPELINES["pipe_merchant"]
    dim, _ = p.frames(spark, sf_dir)
    return read_dim(spark, dim, p.spec)


def q_bucketed_load(spark, sf_dir):
    return run_bucketed(spark, sf_dir, "pipe_merchant")


def q_closed_apart_load(spark, sf_dir):
    return run_bucketed(spark, sf_dir, "pipe_pan_info", 32, apart=True)


OPERATOR_QUERIES = {
    "staging_scan": q_staging_scan,                                     # S1
    "dimension_scan": q_dimension_scan,                                 # S2
    "bucketed_load": q_bucketed_load,                                   # S6
    "closed_apart_load": q_closed_apart_load,                           # S3, S6, U3, U4b
    "current_version_scan": q_current_version_scan,                     # S3
    "insert_new_with_defaults": q_insert_new_with_defaults,             # S4, P3, P5, P6, J1
    "insert_new_dup_column": q_insert_new_dup_column,                   # P1, P2
    "carry_forward_config_date": q_carry_forward_config_date,           # P7
    "next_version_plus_one": q_next_version_plus_one,                   # P8
    "append_version_numbers": q_append_version_numbers,                 # P9, J3, W1
    "close_due_filter_date": _due("date"),                              # P10, F9
    "close_due_filter_midnight": _due("midnight"),                      # F9
    "changed_rows_or": _changed("fx1"),                                 # F1, J2
    "changed_rows_null_safe": _changed("fx1", null_safe=True),          # F1 option
    "changed_rows_single": _changed("fx1", cols=("seg",)),              # F2
    "changed_rows_where_current": _changed("fx4"),                      # F3
    "changed_rows_composite": _changed("fx3"),                          # J2, three-column key
    "second_latest_version": q_second_latest_version,                   # W2, F10, Q1s
    "new_keys_1": _new_keys("fx1"),                                     # J1, F4
    "new_keys_2": _new_keys("fx2"),
    "new_keys_3": _new_keys("fx3"),
    "new_keys_4": _new_keys("fx4"),
    "batch_rows": q_batch_rows,                                         # J4
    "max_version_touched_join": _max_touched("fx4"),                    # J5, A4
    "max_version_touched_in": _max_touched("fx1"),                      # J6, A2
    "max_version_touched_tuple_in": _max_touched("fx2"),                # J7, A2
    "max_version_all": q_max_version_all,                               # A1
    "max_version_batch": q_max_version_batch,                           # A3, Q2s
    "next_version_rownum": _next_version_rownum("fx1"),                 # W1
    "next_version_narrow_partition": _next_version_rownum("fx2_narrow"),  # W1, Q8
    "next_start_touched": q_next_start_touched,                         # W3
    "next_start_batch": q_next_start_batch,                             # W4, Q2s
    "flag_off_touched": q_flag_off_touched,                             # U1, F6
    "flag_on_latest": q_flag_on_latest,                                 # U2, F8
    "retire_older_batch": _retire("fx1", "batch"),                      # U3, F7
    "retire_older_touched": _retire("fx1_touched", "touched"),          # U3
    "redate_touched": _redate("touched"),                               # U4, F5
    "redate_batch": _redate("batch"),                                   # U4b, F5
    "close_previous_1": _close("fx1_close"),                            # U5, one-column key
    "close_previous_4": _close("fx4_close"),                            # U5, four-column key
    "long_histories": q_long_histories,                                 # hard part 6: long histories
}
