"""Step-wise operators that move the current flag and close validity intervals
(the UPDATE side of a load).  Each takes the dimension ``d`` and the mapped
staging batch ``s`` (see ``versions.map_columns``) and returns the rewritten
dimension, or the derived table the UPDATE reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import due as due_expr
from ..functions.columns import ts_literal
from ..spec import CURRENT, DATE_FROM, DATE_TO, VERSION
from .ordered import has_hot_group, lead_within
from .update import update_from
from .versions import TS, hot_key_rows, max_version


def staged_keys(s: DataFrame, keys) -> DataFrame:
    return s.select(*keys).distinct()


def touched_rows(d: DataFrame, s: DataFrame, keys) -> DataFrame:
    """All versions of keys present in the batch (left semi join;
    ``IN``, tuple ``IN`` and an inner join followed by MAX are all this)."""
    return d.join(s.select(*keys), list(keys), "left_semi")


def batch_rows(d: DataFrame, s: DataFrame, keys) -> DataFrame:
    """Versions whose ``date_from`` equals a staged timestamp of their key.
    A semi join, so a repeated ``(key, ts)`` in staging does not fan out."""
    marks = s.select(*keys, F.col(TS).alias(DATE_FROM))
    return d.join(marks, list(keys) + [DATE_FROM], "left_semi")


def flag_off_touched(d: DataFrame, s: DataFrame, keys) -> DataFrame:
    """Current flag off for every version of a key in the batch."""
    return update_from(d, staged_keys(s, keys), keys, {CURRENT: F.lit(False)},
                       where=F.col(CURRENT) == F.lit(True))


def flag_on_latest(d: DataFrame, s: DataFrame, keys) -> DataFrame:
    """Current flag on for the highest version of each touched key."""
    latest = max_version(touched_rows(d, s, keys), keys)
    return update_from(d, latest, keys, {CURRENT: F.lit(True)},
                       where=F.col(VERSION) == F.col("max_version"))


def retire_older(d: DataFrame, s: DataFrame, keys, scope: str = "batch") -> DataFrame:
    """Flag off below the max version of the batch's rows (``batch``)
    or of all versions of touched keys (``touched``)."""
    src = batch_rows(d, s, keys) if scope == "batch" else touched_rows(d, s, keys)
    return update_from(d, max_version(src, keys), keys, {CURRENT: F.lit(False)},
                       where=F.col(VERSION) < F.col("max_version"))


def next_start(d: DataFrame, s: DataFrame, keys, scope: str = "touched", skewed: bool | None = None) -> DataFrame:
    """``LEAD(date_from) OVER (PARTITION BY key ORDER BY version)`` over
    all versions of touched keys or over the batch's rows.  ``skewed``: chain
    slices of the order instead of whole keys (default: if a key has more rows than the
    hot-key limit)."""
    src = batch_rows(d, s, keys) if scope == "batch" else touched_rows(d, s, keys)
    if skewed is None:
        skewed = has_hot_group(src.select(*keys), keys, hot_key_rows(src))
    if skewed:
        return lead_within(src.select(*keys, VERSION, DATE_FROM), list(keys), [VERSION, DATE_FROM], DATE_FROM,
                           "next_date_from").select(*keys, VERSION, "next_date_from")
    w = Window.partitionBy(*keys).orderBy(F.col(VERSION).asc_nulls_last(), F.col(DATE_FROM).asc_nulls_last())
    return src.select(*keys, VERSION, F.lead(DATE_FROM).over(w).alias("next_date_from"))


def redate(d: DataFrame, s: DataFrame, keys, scope: str = "touched", skewed: bool | None = None) -> DataFrame:
    """``date_to := next version's date_from`` where there is one."""
    nxt = next_start(d, s, keys, scope, skewed).where(F.col("next_date_from").isNotNull())
    return update_from(d, nxt, list(keys) + [VERSION], {DATE_TO: F.col("next_date_from")})


def second_latest(d: DataFrame, keys) -> DataFrame:
    """The second-highest version of each key (``rn = 2``); Catalyst
    plans it with a per-partition group limit."""
    w = Window.partitionBy(*keys).orderBy(F.col(VERSION).desc_nulls_last(), F.col(DATE_FROM).desc_nulls_last())
    return d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 2).drop("_rn")


def close_previous(d: DataFrame, s: DataFrame, keys, batch_ts, due: str = "date",
                   close_at: str = "staging", reclose: str = "always") -> DataFrame:
    """The second-latest version of each touched key whose ``date_from`` is
    due gets ``date_to`` = the staged timestamp (or the batch clock) and loses
    the current flag.  Per key, as the statement intends (the uncorrelated
    scalar subquery of the source fails once two keys qualify)."""
    prev = second_latest(touched_rows(d, s, keys), keys).select(*keys, VERSION)
    if close_at == "staging":
        at = s.groupBy(*keys).agg(F.max(TS).alias("_close_at"))
        prev = prev.join(at, list(keys), "inner")
    else:
        prev = prev.withColumn("_close_at", ts_literal(batch_ts))
    where = due_expr(F.col(DATE_FROM), batch_ts, due)
    if reclose == "current":            # Q12 option: only a version still flagged current
        where = where & (F.col(CURRENT) == F.lit(True))
    return update_from(d, prev, list(keys) + [VERSION],
                       {DATE_TO: F.col("_close_at"), CURRENT: F.lit(False)}, where=where)
