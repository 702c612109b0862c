"""The loads as a composition of the step-wise operators, one per statement.

This is the literal form (each INSERT / UPDATE a DataFrame step reading the
previous step's result).  ``apply_scd2`` computes the same rows in one shuffle;
the tests check the two against each other.  Each step joins on the key, so
this form costs a shuffle per step: use it to inspect a load step by step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import key_ok, named
from ..operators import flags as fl
from ..operators import versions as vs
from ..spec import VERSION, DimSpec


def _start(spec: DimSpec, batch_ts):
    return None if spec.mode == "append_all" or spec.start == "staging" else batch_ts


def insert_new(d: DataFrame, s: DataFrame, spec: DimSpec, batch_ts=None) -> DataFrame:
    """Step 1 of upsert / close-previous: d ∪ new keys at version 1, current."""
    new = vs.open_row(vs.new_rows(s, d, spec), spec, 1, True, _start(spec, batch_ts))
    return vs.append_versions(d, new, spec)


def insert_changed(d1: DataFrame, s: DataFrame, spec: DimSpec, batch_ts=None) -> DataFrame:
    """Step 2: d1 ∪ staged rows that differ from the current version of d1."""
    chg = vs.changed_rows(s, d1, spec)
    if spec.mode == "close_previous" and spec.close_numbering == "plus_one":
        chg = vs.next_version_plus_one(chg)
    else:
        chg = vs.number_versions(chg, spec, "cur_version")
    new = vs.open_row(chg, spec, F.col(VERSION), True, _start(spec, batch_ts))
    return vs.append_versions(d1, new, spec)


def insert_all(d: DataFrame, s: DataFrame, spec: DimSpec) -> DataFrame:
    """Append-all step 1: every staged row at max version + row number, not current."""
    rows = vs.number_versions(vs.with_max_version(s, d, spec.key_cols), spec, "max_version")
    if spec.carry:
        cur = vs.current(d).select(*spec.key_cols, *[F.col(c).alias("_c_" + c) for c in spec.carry_cols])
        rows = rows.join(cur, list(spec.key_cols), "left")
        for c in spec.carry_cols:
            rows = rows.withColumn(c, F.coalesce(F.col("_c_" + c), F.col(c)))
    new = vs.open_row(rows, spec, F.col(VERSION), False)
    return vs.append_versions(d, new, spec)


def apply_stepwise(dim: DataFrame, staging: DataFrame, spec: DimSpec, batch_ts=None) -> DataFrame:
    if names := spec.plain_names(dim.columns):
        users = {n: c for c, n in names.items()}
        out = apply_stepwise(dim.select(*[named(c).alias(names.get(c, c)) for c in dim.columns]), staging, spec.renamed(names), batch_ts)
        return out.select(*[F.col(c).alias(users.get(c, c)) for c in out.columns])
    s = vs.map_columns(staging, spec)
    if spec.null_keys == "drop":
        s = s.where(key_ok(spec.key_cols))
    if spec.dedupe:
        s = vs.dedupe_batch(s, spec)
    d = dim.select(*spec.dim_cols)
    K = spec.key_cols
    if spec.mode == "append_all":
        d1 = insert_all(d, s, spec)
        d2 = fl.flag_on_latest(fl.flag_off_touched(d1, s, K), s, K)
        return fl.redate(d2, s, K, "touched")
    d2 = insert_changed(insert_new(d, s, spec, batch_ts), s, spec, batch_ts)
    if spec.mode == "close_previous":
        return fl.close_previous(d2, s, K, batch_ts, spec.due, spec.close_at, spec.reclose)
    d3 = fl.retire_older(d2, s, K, spec.retire)
    return fl.redate(d3, s, K, spec.redate)
