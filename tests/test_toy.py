"""Toy cases T1 to T10 (FIXTURES.md §3) with exact answers, for append-all (A)
and upsert (B, redate='batch'), through the one-shuffle plan (both split
paths) and the step-wise form."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from chronodim import DimSpec, apply_scd2
from chronodim.plans.stepwise import apply_stepwise

S = dt.datetime(2200, 1, 1)


def d(m, day=1):
    return dt.datetime(2024, m, day)


DIM_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("lastversion", T.BooleanType()),
    T.StructField("date_from", T.TimestampNTZType()), T.StructField("date_to", T.TimestampNTZType())])
STG_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()),
    T.StructField("ts", T.TimestampNTZType())])

SPEC_B = DimSpec(name="toy", keys=(("k", "k"),), tracked=(("a", "a"),), ts="ts")
SPEC_A = DimSpec(name="toy", keys=(("k", "k"),), tracked=(("a", "a"),), ts="ts", mode="append_all")

T1_DIM = [(1, "a", 1, True, d(1), S)]
CASES = {
    # name: (dim, staging, pattern A result, pattern B result)
    "T1": (T1_DIM, [(1, "b", d(2))],
           [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, True, d(2), S)],
           [(1, "a", 1, False, d(1), S), (1, "b", 2, True, d(2), S)]),
    "T2": (T1_DIM, [(1, "a", d(1)), (1, "b", d(2))],
           [(1, "a", 1, False, d(1), d(1)), (1, "a", 2, False, d(1), d(2)), (1, "b", 3, True, d(2), S)],
           [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, True, d(2), S)]),
    "T3": (T1_DIM, [(1, "a", d(2))],
           [(1, "a", 1, False, d(1), d(2)), (1, "a", 2, True, d(2), S)],
           T1_DIM),
    "T5": ([(1, None, 1, True, d(1), S)], [(1, "b", d(2))],
           [(1, None, 1, False, d(1), d(2)), (1, "b", 2, True, d(2), S)],
           [(1, None, 1, True, d(1), S)]),
    "T6": (T1_DIM, [(1, None, d(2))],
           [(1, "a", 1, False, d(1), d(2)), (1, None, 2, True, d(2), S)],
           T1_DIM),
    "T7": (T1_DIM, [(1, "b", d(2)), (1, "a", d(3))],
           [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, False, d(2), d(3)), (1, "a", 3, True, d(3), S)],
           [(1, "a", 1, False, d(1), S), (1, "b", 2, True, d(2), S)]),
    "T8": (T1_DIM, [(1, "b", d(2)), (1, "b", d(3))],
           [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, False, d(2), d(3)), (1, "b", 3, True, d(3), S)],
           [(1, "a", 1, False, d(1), S), (1, "b", 2, False, d(2), d(3)), (1, "b", 3, True, d(3), S)]),
    "T9": ([(1, "a", 1, True, d(5), S)], [(1, "b", d(2))],
           [(1, "a", 1, False, d(5), d(2)), (1, "b", 2, True, d(2), S)],
           [(1, "a", 1, False, d(5), S), (1, "b", 2, True, d(2), S)]),
    "T10": ([], [(None, "a", d(1))],
            [(None, "a", 1, False, d(1), S)],
            [(None, "a", 1, True, d(1), S)]),
    "T4": ([], [(1, "a", d(1)), (1, "b", d(2))],
            [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, True, d(2), S)],
            [(1, "a", 1, False, d(1), d(1)), (1, "b", 1, False, d(2), d(1)),
             (1, "a", 2, False, d(1), d(2)), (1, "b", 3, True, d(2), S)]),
}

RUNNERS = {
    "auto": lambda dim, stg, spec: apply_scd2(dim, stg, spec, split="auto"),
    "never": lambda dim, stg, spec: apply_scd2(dim, stg, spec, split="never"),
    "stepwise": lambda dim, stg, spec: apply_stepwise(dim, stg, spec),
    "hotkeys": lambda dim, stg, spec: apply_scd2(dim, stg, spec, skew="all"),
}


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "a", "version", "lastversion", "date_from", "date_to").collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def _as_key(rows, k):
    """A case's rows under a key of its own; its NULL keys stay."""
    return [(r[0] and k, *r[1:]) for r in rows]


@pytest.mark.parametrize("runner", list(RUNNERS))
@pytest.mark.parametrize("pattern", ["A", "B"])
def test_toy(spark, pattern, runner):
    """All cases in one load, each under its own key (T10 is the one with a NULL key)."""
    dim, stg, want = [], [], {}
    for k, (case, (dim_rows, stg_rows, want_a, want_b)) in enumerate(CASES.items(), 1):
        dim += _as_key(dim_rows, k)
        stg += _as_key(stg_rows, k)
        rows = _as_key(want_a if pattern == "A" else want_b, k)
        want[rows[0][0]] = (case, sorted(rows, key=repr))
    got = _rows(RUNNERS[runner](spark.createDataFrame(dim, DIM_SCHEMA), spark.createDataFrame(stg, STG_SCHEMA),
                                SPEC_A if pattern == "A" else SPEC_B))
    assert {r[0] for r in got} == set(want) and len(want) == len(CASES)
    for k, (case, rows) in want.items():
        assert sorted((r for r in got if r[0] == k), key=repr) == rows, case


def test_t4_new_key_numbered(spark):
    """A new key staged twice: new_keys='number' gives versions 1..n instead of the
    statements' own 1,1,2,3 (case T4)."""
    from dataclasses import replace
    dim = spark.createDataFrame([], DIM_SCHEMA)
    stg = spark.createDataFrame([(1, "a", d(1)), (1, "b", d(2))], STG_SCHEMA)
    got = _rows(apply_scd2(dim, stg, replace(SPEC_B, new_keys="number")))
    assert got == [(1, "a", 1, False, d(1), d(2)), (1, "b", 2, True, d(2), S)]


def test_t10_null_key_inserted_every_run(spark):
    dim = spark.createDataFrame([], DIM_SCHEMA)
    stg = spark.createDataFrame([(None, "a", d(1))], STG_SCHEMA)
    once = apply_scd2(dim, stg, SPEC_B)
    twice = apply_scd2(spark.createDataFrame(once.collect(), DIM_SCHEMA), stg, SPEC_B)
    assert _rows(twice) == [(None, "a", 1, True, d(1), S)] * 2


def test_b_is_idempotent_for_one_row_per_key(spark):
    """Q9: re-running B on its own output with the same batch adds nothing."""
    dim = spark.createDataFrame(T1_DIM + [(2, "x", 1, True, d(1), S)], DIM_SCHEMA)
    stg = spark.createDataFrame([(1, "b", d(2)), (3, "c", d(2))], STG_SCHEMA)
    once = apply_scd2(dim, stg, SPEC_B)
    twice = apply_scd2(spark.createDataFrame(once.collect(), DIM_SCHEMA), stg, SPEC_B)
    assert _rows(once) == _rows(twice)


def test_dedupe_same_change_twice(spark):
    """Q3 option: with dedupe the same change staged twice makes one version."""
    from dataclasses import replace
    dim = spark.createDataFrame(T1_DIM, DIM_SCHEMA)
    stg = spark.createDataFrame([(1, "b", d(2)), (1, "b", d(3))], STG_SCHEMA)
    got = _rows(apply_scd2(dim, stg, replace(SPEC_B, dedupe=True)))
    assert got == [(1, "a", 1, False, d(1), S), (1, "b", 2, True, d(2), S)]
