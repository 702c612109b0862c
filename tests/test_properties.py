"""

* Invariants of an upsert with ``retire='touched'``, ``redate='touched'``,
  ``null_safe=True`` on well-formed input (dense versions, one current row, no
  late rows, one staged row per new key): versions stay 1..n per key, exactly
  one current row and it is the highest, ``date_to(v) = date_from(v+1)``, the
  last version ends at 2200, no input row is lost, a second run of a batch
  with one row per key changes nothing.
* Differential: random histories and batches (late rows, repeated values,
  NULL attributes, timestamps equal to existing starts) through ``apply_scd2``
  and through the DuckDB statement sequence of ``duck_oracle/sql.py``, for the three
  modes.
"""

import datetime as dt
from dataclasses import replace

import duckdb
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from chronodim import DimSpec, apply_scd2
from duck_oracle.sql import staging_where, steps

S = dt.datetime(2200, 1, 1)
DIM_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
    T.StructField("version", T.IntegerType()), T.StructField("lastversion", T.BooleanType()),
    T.StructField("date_from", T.TimestampNTZType()), T.StructField("date_to", T.TimestampNTZType())])
STG_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType())])
ARROW_DIM = pa.schema([("k", pa.int32()), ("a", pa.string()), ("b", pa.int32()), ("version", pa.int32()),
                       ("lastversion", pa.bool_()), ("date_from", pa.timestamp("us")), ("date_to", pa.timestamp("us"))])
ARROW_STG = pa.schema([("k", pa.int32()), ("a", pa.string()), ("b", pa.int32()), ("ts", pa.timestamp("us"))])

BASE = DimSpec(name="prop", keys=(("k", "k"),), tracked=(("a", "a"), ("b", "b")), ts="ts")
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

value = st.sampled_from(["x", "y", None])
number = st.sampled_from([1, 2, None])


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@st.composite
def histories(draw, late=False, one_staged=False, repeat_new=False, null_key=False):
    """(dimension rows, staged rows) for keys 1..5."""
    dim, stg = [], []
    for k in range(1, 6):
        n_hist = draw(st.integers(0, 3))
        starts = sorted(draw(st.sets(st.integers(0, 30), min_size=n_hist, max_size=n_hist)))
        for i, s0 in enumerate(starts):
            last = i == len(starts) - 1
            dim.append((k, draw(value), draw(number), i + 1, last, day(s0), S if last else day(starts[i + 1])))
        max_staged = 1 if one_staged or (not starts and not repeat_new) else 3
        lo = 0 if late or not starts else starts[-1] + 1
        ts = sorted(draw(st.sets(st.integers(lo, 60), min_size=0, max_size=max_staged)))
        if late and starts and ts and draw(st.booleans()):
            ts[0] = starts[0]                 # a staged time equal to an existing start (J4 match)
            ts = sorted(set(ts))
        for t in ts:
            stg.append((k, draw(value), draw(number), day(t)))
    if null_key and draw(st.booleans()):
        stg.append((None, draw(value), draw(number), day(draw(st.integers(0, 60)))))
    return dim, stg


def _frames(spark, dim, stg):
    return spark.createDataFrame(dim, DIM_SCHEMA), spark.createDataFrame(stg, STG_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "a", "b", "version", "lastversion", "date_from", "date_to")
                   .collect()), key=repr)


# ---- invariants --------------------------------------------------------------------
INV_SPEC = replace(BASE, retire="touched", redate="touched", null_safe=True)


@SETTINGS
@given(data=histories())
def test_upsert_invariants(spark, data):
    dim, stg = data
    out = _rows(apply_scd2(*_frames(spark, dim, stg), INV_SPEC))
    by_key = {}
    for r in out:
        by_key.setdefault(r[0], []).append(r)
    for k, rows in by_key.items():
        rows.sort(key=lambda r: r[3])
        assert [r[3] for r in rows] == list(range(1, len(rows) + 1)), rows
        assert [r[4] for r in rows] == [False] * (len(rows) - 1) + [True], rows
        for a, b in zip(rows, rows[1:]):
            assert a[6] == b[5], rows
        assert rows[-1][6] == S
    kept = {(r[0], r[3]) for r in out}
    assert all((r[0], r[3]) in kept for r in dim)


@SETTINGS
@given(data=histories(one_staged=True))
def test_second_run_changes_nothing(spark, data):
    dim, stg = data
    once = apply_scd2(*_frames(spark, dim, stg), INV_SPEC)
    first = _rows(once)
    again = apply_scd2(spark.createDataFrame(first, DIM_SCHEMA), spark.createDataFrame(stg, STG_SCHEMA), INV_SPEC)
    assert _rows(again) == first


# ---- differential against the statement sequence in DuckDB ----------------------------
BATCH_TS = "2024-01-20 12:00:00"


def _duck(spec, dim, stg, batch_ts):
    con = duckdb.connect()
    con.register("dim_t", pa.Table.from_pylist([dict(zip(ARROW_DIM.names, r)) for r in dim], schema=ARROW_DIM))
    con.register("stg_t", pa.Table.from_pylist([dict(zip(ARROW_STG.names, r)) for r in stg], schema=ARROW_STG))
    ctes = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in steps(spec, batch_ts))
    sql = (f"WITH d0 AS (SELECT * FROM dim_t), s AS (SELECT * FROM stg_t{staging_where(spec)}),\n{ctes}\n"
           f"SELECT * FROM fin")
    return sorted((tuple(r) for r in con.sql(sql).fetchall()), key=repr)


DIFF_CASES = {
    "upsert_batch": (BASE, dict(late=True)),
    "upsert_touched_null_safe": (replace(BASE, redate="touched", retire="touched", null_safe=True), dict(late=True)),
    "upsert_batch_clock": (replace(BASE, start="batch", retire="touched", redate="touched"), dict(one_staged=True)),
    "append_all": (replace(BASE, mode="append_all"), dict(late=True, repeat_new=True)),
    "close_previous": (replace(BASE, mode="close_previous", start="batch"), dict(late=True, one_staged=True)),
    "close_previous_midnight": (replace(BASE, mode="close_previous", start="batch", due="midnight"),
                                dict(one_staged=True)),
    "close_previous_options": (replace(BASE, mode="close_previous", start="batch", reclose="current",
                                       close_numbering="row_number", close_at="batch_ts"), dict(late=True)),
    "upsert_null_keys": (BASE, dict(late=True, null_key=True)),
    "upsert_drop_null_keys": (replace(BASE, null_keys="drop"), dict(late=True, null_key=True)),
    "append_null_keys": (replace(BASE, mode="append_all"), dict(repeat_new=True, null_key=True)),
    "upsert_dedupe": (replace(BASE, dedupe=True), dict(late=True, null_key=True)),
    "append_dedupe": (replace(BASE, mode="append_all", dedupe=True), dict(repeat_new=True, null_key=True)),
}


HOT_CASES = ["upsert_batch", "append_null_keys", "close_previous_options", "upsert_batch_clock", "upsert_dedupe"]


@pytest.mark.parametrize("skew,case", [("auto", c) for c in DIFF_CASES] + [("all", c) for c in HOT_CASES])
def test_against_statement_sequence(spark, skew, case):
    spec, kw = DIFF_CASES[case]

    @SETTINGS
    @given(data=histories(**kw))
    def check(data):
        dim, stg = data
        want = _duck(spec, dim, stg, BATCH_TS)
        got = _rows(apply_scd2(*_frames(spark, dim, stg), spec, BATCH_TS, split="auto", skew=skew))
        assert got == want

    check()
