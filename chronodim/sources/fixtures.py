"""Test fixtures FX1 to FX4: a dimension with history and a staging batch, each
derived from the driver's TPC-H-like tables with DataFrame operations.

Every fixture reads its source table whole; the dimension / batch split is a
rule on the data (a time cut, a rank, or a residue of the key that decides
whether a customer has history), never a sample or a row cap.  ``keep`` is given what
took a shuffle to make: a load, which reads its inputs several times, keeps it as a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import open_end, ts_literal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


Keep = Callable[[DataFrame], DataFrame]


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _history(log: DataFrame, keys, order, cols) -> DataFrame:
    """Rows of a log as the versions of a dimension: numbered, chained, the last one current."""
    w = Window.partitionBy(*keys).orderBy(*order)
    nxt = F.lead("ts").over(w)
    return log.select(*keys, *cols, F.row_number().over(w).cast("int").alias("version"),
                      nxt.isNull().alias("lastversion"), F.col("ts").alias("date_from"),
                      F.coalesce(nxt, open_end()).alias("date_to"))


# ---- FX1: one-column key (customer) -------------------------------------------------
def fx1(spark: SparkSession, sf_dir: str, keep: Keep = _as_it_is) -> tuple[DataFrame, DataFrame]:
    """dim (k, seg, nat, configuration_date, version, lastversion, date_from, date_to),
    staging (src_k, src_seg, src_nat, crtupd_dt)."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"))
    k = F.col("k")
    t97, t98 = ts_literal("1997-01-01 00:00:00"), ts_literal("1998-01-01 00:00:00")
    has_hist = (k % 5) != 0
    two_versions = (k % 3) == 0
    v1 = c.where(has_hist).select(
        "k", "seg", "nat", t97.alias("configuration_date"), F.lit(1).alias("version"),
        (~two_versions).alias("lastversion"), t97.alias("date_from"),
        F.when(two_versions, t98).otherwise(open_end()).alias("date_to"))
    v2 = c.where(has_hist & two_versions).select(
        "k", F.lit("OLD").alias("seg"), "nat", t97.alias("configuration_date"), F.lit(2).alias("version"),
        F.lit(True).alias("lastversion"), t98.alias("date_from"), open_end().alias("date_to"))
    dim = v1.unionByName(v2)
    seg = (F.when((k % 4) == 0, F.lit("MACHINERY"))
            .when((k % 14) == 0, F.lit(None).cast("string"))
            .otherwise(F.col("seg")))
    s1 = c.where(((k % 2) == 0) | ~has_hist).select(
        k.alias("src_k"), seg.alias("src_seg"), F.col("nat").alias("src_nat"),
        ts_literal("1999-06-01 00:00:00").alias("crtupd_dt"))
    s2 = c.where(((k % 8) == 0) & has_hist).select(
        k.alias("src_k"), F.col("seg").alias("src_seg"), F.col("nat").alias("src_nat"),
        ts_literal("1999-07-01 00:00:00").alias("crtupd_dt"))
    return dim, s1.unionByName(s2)


# ---- FX2: two-column key, real order history ----------------------------------------
def _ord_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k1"), F.col("o_orderpriority").alias("k2"),
        F.col("o_orderstatus").alias("st"), F.col("o_totalprice").alias("amt"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("id"))


CUT_1999 = "1999-01-01 00:00:00"


def fx2(spark: SparkSession, sf_dir: str, keep: Keep = _as_it_is) -> tuple[DataFrame, DataFrame]:
    """dim (k1, k2, st, amt, version, lastversion, date_from, date_to),
    staging (src_k1, src_k2, src_st, src_amt, src_created_on)."""
    log = _ord_log(spark, sf_dir)
    cut = ts_literal(CUT_1999)
    dim = keep(_history(log.where(F.col("ts") < cut), ["k1", "k2"], ["ts", "id"], ["st", "amt"]))
    stg = log.where(F.col("ts") >= cut).select(
        F.col("k1").alias("src_k1"), F.col("k2").alias("src_k2"), F.col("st").alias("src_st"),
        F.col("amt").alias("src_amt"), F.col("ts").alias("src_created_on"))
    return dim, stg


# ---- FX3 and FX4: one log, dealt out by a rule on keys and on each key's last row -----
def _dealt(log: DataFrame, keys, order, whole: Column, last: Column) -> DataFrame:
    """A log (with ``ts``) marked ``staged`` or not: all rows of a key with ``whole``, the last one of a
    key with ``last``; and its versions as ``_history`` would number and chain the rows that
    aren't staged.  Of a key these are all rows or all but the last, so that one window gives both;
    rows for which the rule is NULL are on neither side."""
    w = Window.partitionBy(*keys).orderBy(*order)
    d = log.select("*", F.row_number().over(w).cast("int").alias("version"), F.lead("ts").over(w).alias("_next"),
                   F.lead(F.lit(True)).over(w).isNull().alias("_end"), F.lead(F.lit(True), 2).over(w).isNull().alias("_near_end"))
    d = d.withColumn("staged", whole | (F.col("_end") & last)).where(F.col("staged").isNotNull())
    nxt = F.when(~(F.coalesce(last, F.lit(False)) & F.col("_near_end")), F.col("_next"))
    return d.withColumn("_next", nxt).select(
        *log.columns, "version", F.col("_next").isNull().alias("lastversion"),
        F.coalesce("_next", open_end()).alias("date_to"), "staged")


def fx3(spark: SparkSession, sf_dir: str, keep: Keep = _as_it_is) -> tuple[DataFrame, DataFrame]:
    """dim (k1, k2, k3, ls, qty, version, lastversion, date_from, date_to),
    staging (k1, k2, k3, ls, qty, crtupd_dt)."""
    li = table(spark, sf_dir, "lineitem")
    log = li.select(F.col("l_suppkey").alias("k1"), (F.col("l_partkey") % 20).alias("k2"), F.col("l_returnflag").alias("k3"),
                    F.col("l_shipdate").alias("ts"), F.col("l_linestatus").alias("ls"), F.col("l_quantity").alias("qty"),
                    F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"))
    cols = ["k1", "k2", "k3", "ls", "qty"]
    dealt = keep(_dealt(log, cols[:3], ["ts", "id", "line"], ((F.col("k1") + F.col("k2")) % 7) == 0, F.lit(True)).drop("id", "line"))
    dim = dealt.where(~F.col("staged")).select(*cols, "version", "lastversion", F.col("ts").alias("date_from"), "date_to")
    return dim, dealt.where("staged").select(*cols, F.col("ts").alias("crtupd_dt"))


def fx4(spark: SparkSession, sf_dir: str, keep: Keep = _as_it_is) -> tuple[DataFrame, DataFrame]:
    """dim (kpi_name, mon, yr, category, target, version, lastversion, date_from, date_to),
    staging (src_kpi_name, src_month, src_year, src_category, src_target, src_created_on)."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kpi_name"), F.month("ts").cast("int").alias("mon"),
        F.year("ts").cast("int").alias("yr"), F.col("user_id").alias("category"),
        F.floor(F.col("value") / 25).cast("int").alias("target"), "ts", "event_id")
    keys = ["kpi_name", "mon", "yr", "category"]
    dealt = keep(_dealt(ev, keys, ["ts", "event_id"], (F.col("category") % 4) == 0, (F.col("category") % 3) != 0).drop("event_id"))
    dim = dealt.where(~F.col("staged")).select(*keys, "target", "version", "lastversion", F.col("ts").alias("date_from"), "date_to")
    stg = dealt.where("staged").select(
        F.col("kpi_name").alias("src_kpi_name"), F.col("mon").alias("src_month"), F.col("yr").alias("src_year"),
        F.col("category").alias("src_category"), F.col("target").alias("src_target"),
        F.col("ts").alias("src_created_on"))
    return dim, stg


FIXTURES = {"fx1": fx1, "fx2": fx2, "fx3": fx3, "fx4": fx4}
