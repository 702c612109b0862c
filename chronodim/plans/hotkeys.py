"""The load for hot keys: the same rows as the window stage of ``scd2``, with no
step that gathers one key into one task.

* per-key facts (current version, has history, touched, base, close time,
  highest version in scope) are aggregates — partial aggregation collapses a
  hot key's rows before the shuffle — stored, and joined back by broadcast when
  their measured bytes fit the bound;
* the batch match of J4 is an equi-join on ``(key, timestamp)``;
* ``row_number`` and ``lead`` use ``operators.ordered`` (windows over slices of a
  key's order), so a hot key's versions spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import due, ts_literal
from ..operators.ordered import lead_within, rank_within, stored
from ..operators.partitioning import checked_broadcast
from ..operators.versions import _SEEN, TS, staged_values
from ..spec import CURRENT, DATE_FROM, DATE_TO, VERSION, DimSpec
from .scd2 import _CURV, _KIND, _STG, CHG, DIM, NEW, SEEN, compared_with, row_kind


def _facts_join(u: DataFrame, facts: DataFrame, keys) -> DataFrame:
    """Join one-row-per-key facts back.  They are stored (one row per hot key), so their real
    bytes are measured without a second aggregate; broadcast when these fit the bound."""
    facts, _, _ = checked_broadcast(stored(facts))
    return u.join(facts, list(keys), "left")


def versioned_hot(u: DataFrame, spec: DimSpec, batch_ts, again: bool = False) -> DataFrame:
    """``u``: touched versions + staged rows of hot keys, in the layout of ``scd2.union_rows``;
    ``again``: rows that ``repeated_changes`` gave are among them."""
    K, P = list(spec.key_cols), list(spec.partition_cols)
    tracked, carry = list(spec.tracked_cols), list(spec.carry_cols)
    mode = spec.mode
    stg, ver, cur_flag, start_col = F.col(_STG), F.col(VERSION), F.col(CURRENT), F.col(DATE_FROM)

    # (1) per-key facts as one aggregate
    is_cur = ~stg & F.coalesce(cur_flag, F.lit(False))
    aggs = [F.max(F.when(is_cur, F.struct(ver.alias("v"), *[F.col(c) for c in tracked + carry]))).alias(_CURV),
            (F.max((~stg).cast("int")) == 1).alias("_has_dim"),
            (F.max(stg.cast("int")) == 1).alias("_touched")]
    if mode == "append_all":
        aggs.append(F.coalesce(F.max(F.when(~stg, ver)), F.lit(0)).alias("_base"))
    if mode == "close_previous" and spec.close_at == "staging":
        aggs.append(F.max(F.col(TS)).alias("_close"))
    u = _facts_join(u, u.groupBy(*K).agg(*aggs), K)

    # J4 batch match: an equi-join on (key, staged timestamp)
    if mode == "upsert" and "batch" in (spec.retire, spec.redate):
        marks = u.where(stg).select(*K, F.col(TS).alias("_at")).distinct().withColumn("_mark", F.lit(True))
        u = (u.withColumn("_at", F.when(stg, F.col(TS)).otherwise(start_col))
              .join(marks, K + ["_at"], "left")
              .withColumn("_inb", F.coalesce(F.col("_mark"), F.lit(False)))
              .drop("_mark", "_at"))

    # (2) row kinds
    u = u.withColumn(_KIND, row_kind(spec, again)).where(F.col(_KIND) != SEEN)
    # The rows of hot keys feed several branches below (ranked / not ranked,
    # flag aggregate, chained / not chained); cut the lineage once so none of
    # them re-reads the dimension.
    u = stored(u)
    kd = F.col(_KIND)
    repeats = mode != "append_all" and spec.new_keys == "one"

    # (3) numbering: ranks of staged rows within the version partition
    cur_version, cur_carry = compared_with(spec, again)
    order = staged_values(u, spec, last=spec.carry_cols)
    changed_order = order if mode == "append_all" else staged_values(u, spec, first=tuple(cur_carry.values()))
    numbered = mode in ("append_all", "upsert") or spec.close_numbering == "row_number"
    if numbered:
        ranked = rank_within(u.where(kd == CHG), P, changed_order, "_rn")
        u = ranked.unionByName(u.where(kd != CHG).withColumn("_rn", F.lit(None).cast("int")))
    if spec.new_keys == "number":
        ranked = rank_within(u.where(kd == NEW), K, order, "_rn_new")
        u = ranked.unionByName(u.where(kd != NEW).withColumn("_rn_new", F.lit(None).cast("int")))
        new_version = F.col("_rn_new")
    else:
        new_version = F.lit(1)
    if mode == "append_all":
        version = F.col("_base") + F.col("_rn")
    elif numbered:
        version = cur_version + F.col("_rn")
    else:
        version = cur_version + F.lit(1)
    u = u.withColumn(VERSION, F.when(kd == DIM, ver).when(kd == NEW, new_version)
                                .when(kd == CHG, version).cast("int"))
    u = u.withColumn(CURRENT, F.when(kd == DIM, cur_flag).otherwise(F.lit(mode != "append_all")))
    for c in carry:
        carried = F.coalesce(cur_carry[c], F.col(c)) if mode == "append_all" else cur_carry[c]
        u = u.withColumn(c, F.when(kd == CHG, carried).otherwise(F.col(c)))

    touched = F.col("_touched")
    if mode == "append_all":
        top = u.groupBy(*K).agg(F.max(ver).alias("_top"))
        u = _facts_join(u, top, K)
        u = u.withColumn(CURRENT, F.when(touched, ver == F.col("_top")).otherwise(cur_flag))
        scope = touched
    elif mode == "upsert":
        in_scope = F.col("_inb") if spec.retire == "batch" else touched
        top = u.groupBy(*K).agg(F.max(F.when(in_scope, ver)).alias("_top"))
        u = _facts_join(u, top, K)
        u = u.withColumn(CURRENT, F.when(ver < F.col("_top"), F.lit(False)).otherwise(cur_flag))
        scope = F.col("_inb") if spec.redate == "batch" else touched
    else:
        scope = None

    if scope is not None:
        u = u.withColumn("_scope", F.coalesce(scope, F.lit(False)))
        chained = lead_within(u.where(F.col("_scope")), K, [ver, start_col],
                              DATE_FROM, "_next")
        u = chained.unionByName(u.where(~F.col("_scope")).withColumn("_next", F.lit(None).cast("timestamp_ntz")))
        if repeats:            # rows of a new key share version 1, by which the update matches
            first = u.where(kd == NEW).groupBy(*K).agg(F.min("_next").alias("_first"))
            u = _facts_join(u, first, K)
            u = u.withColumn("_next", F.when(kd == NEW, F.col("_first")).otherwise(F.col("_next")))
        u = u.withColumn(DATE_TO, F.when(F.col("_next").isNotNull(), F.col("_next")).otherwise(F.col(DATE_TO)))
    else:
        # every row with the version number of the second row (Q13): the highest version if two
        # rows have it, else the next one
        u = _facts_join(u, u.where(touched).groupBy(*K).agg(F.max(ver).alias("_highest")), K)
        top = F.col("_highest")
        second = F.when(F.count(F.when(ver == top, 1)) > 1, F.max(top)).otherwise(F.max(F.when(ver < top, ver)))
        u = _facts_join(u, u.where(touched).groupBy(*K).agg(second.alias("_second")), K)
        hit = touched & (ver == F.col("_second")) & due(start_col, batch_ts, spec.due)
        if spec.reclose == "current":
            hit = hit & cur_flag
        hit = F.coalesce(hit, F.lit(False))
        close_at = F.col("_close") if spec.close_at == "staging" else ts_literal(batch_ts)
        u = u.withColumn("_hit", hit)
        u = (u.withColumn(DATE_TO, F.when(F.col("_hit"), close_at).otherwise(F.col(DATE_TO)))
              .withColumn(CURRENT, F.when(F.col("_hit"), F.lit(False)).otherwise(cur_flag)))

    return u.select(*spec.dim_cols)
