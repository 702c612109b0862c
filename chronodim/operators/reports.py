"""
Q10, and the long-history check of §7): each is one DataFrame, computed on
the cluster, for the caller to write or inspect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import key_ok
from ..spec import DATE_FROM, VERSION, DimSpec
from .versions import TS, current


def late_rows(s: DataFrame, d: DataFrame, spec: DimSpec) -> DataFrame:
    """Q7: staged rows older than the current version of their key (a load
    gives them the highest version anyway)."""
    cur = current(d).select(*spec.key_cols, F.col(DATE_FROM).alias("current_from"))
    return (s.join(cur, list(spec.key_cols), "inner").where(F.col(TS) < F.col("current_from"))
             .select(*spec.key_cols, *spec.attr_cols, F.col(TS).alias("staged_ts"), "current_from"))


def null_key_rows(s: DataFrame, spec: DimSpec) -> DataFrame:
    """Q10: staged rows with a NULL key component (inserted anew at every load
    unless ``null_keys='drop'``)."""
    return s.where(~key_ok(spec.key_cols)).select(*spec.key_cols, *spec.attr_cols,
                                                   F.col(TS).alias("staged_ts"))


def long_histories(d: DataFrame, spec: DimSpec, min_versions: int) -> DataFrame:
    """Keys with at least ``min_versions`` versions (candidates for the hot-key
    path); a partial + final aggregate, no window."""
    return (d.groupBy(*spec.key_cols)
             .agg(F.count(F.lit(1)).alias("versions"), F.max(VERSION).cast("int").alias("max_version"))
             .where(F.col("versions") >= min_versions))
