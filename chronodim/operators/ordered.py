"""Skew-proof ``row_number`` and ``lead`` within a group.

A window partitioned by a group runs each group in one task.  For a group
that holds a large share of the rows (a hot key) these helpers spread it:

1. Bounds.  A sample of the order's keys (rows by a hash of the key, so a rerun takes the same
   ones) gives each group its quantiles: an array of keys, stored once and broadcast
   after its bytes are measured.
2. The slice of a row is the number of its group's bounds that are not above its key: a
   function of the row, found by binary search.  No row ids, so no wide rows need to be
   stored and nothing can be renumbered.
3. Windows run over (group, slice).  A summary per slice (row count, first value) gives
   each slice the number of rows before it and the first value of the next one.

The order is ascending, nulls last, over plain columns; a hash of the row is its last key, so
that it is total up to identical rows.  Equal keys are in one slice.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SLICE_ROWS = 250_000
_SLICE_CONF = "chronodim.skew.sliceRows"
MAX_SLICES = 4096           # of all groups together, about; beyond, slices grow
SAMPLE = 16                 # sampled keys for each slice
_KEY, _SLICE = "_seq_key", "_seq_slice"


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.  Where it is
    unset a cluster raises; a local session gets a folder of its own."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="chronodim-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def can_store(spark: SparkSession) -> bool:
    """Whether there is a shared folder to store rows in (a local session makes one)."""
    sc = spark.sparkContext
    return bool(spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()) or sc.master.startswith("local")


def stored(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder, so that every later branch reads the same rows."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def kept_table(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder (removed when the session ends), so that later
    steps scan the columns they need; as it is where there is no shared folder."""
    spark = df.sparkSession
    if not can_store(spark):
        return df
    path = f"{shared_root(spark)}/kept-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def slice_rows(df: DataFrame) -> int:
    """Rows of a group that one task orders."""
    return int(df.sparkSession.conf.get(_SLICE_CONF, None) or DEFAULT_SLICE_ROWS)


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return _hashable(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))


def _key(df: DataFrame, order) -> Column:
    """One value that compares as the order does (nulls last)."""
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    row_hash = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if _hashable(f.dataType)])
    return F.struct(*[x.alias(f"k{i}") for i, x in enumerate([y for c in cols for y in (c.isNull(), c)] + [row_hash])])


def _by_group(df: DataFrame, facts: DataFrame, group, more=()) -> DataFrame:
    """Attach facts of a group (and of ``more`` columns): broadcast where their measured bytes
    allow; group values may be NULL."""
    from .partitioning import checked_broadcast
    facts, _, _ = checked_broadcast(facts)
    on = [*group, *more]
    facts = facts.select(*[F.col(c).alias("_sl_" + c) for c in on], *[c for c in facts.columns if c not in on])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col("_sl_" + c)) for c in on])
    return df.join(facts, same, "left").drop(*["_sl_" + c for c in on])


def _sliced(df: DataFrame, group, order, rows: int) -> DataFrame:
    """``df`` with its order's key and slice."""
    keyed = df.withColumn(_KEY, _key(df, order))
    every = max(1, rows // SAMPLE)
    sample = keyed.where(F.pmod(F.xxhash64(_KEY), F.lit(every)) == 0)
    bounds = sample.groupBy(*group).agg(F.sort_array(F.collect_list(_KEY)).alias("_all"))      # bounded by the sample
    step = max(1, rows // every)
    bounds = stored(bounds.select(*group, F.filter("_all", lambda x, i: i % step == step - 1).alias("_bounds")))
    most = bounds.agg(F.coalesce(F.max(F.size("_bounds")), F.lit(0))).first()[0]
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, int(most).bit_length())))])
    n = F.coalesce(F.size("_bounds"), F.lit(0))
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when(
        (p + s <= n) & (F.get("_bounds", F.least(p + s, n) - 1) <= F.col(_KEY)), p + s).otherwise(p))
    return _by_group(keyed, bounds, group).withColumn(_SLICE, at).drop("_bounds")


def _ordered(df: DataFrame, group, order, value: str | None = None) -> tuple[DataFrame, Window]:
    """``df`` with ``_seq_before`` (rows of earlier slices) and the values beside its slice: ``_seq_next``,
    the first of the next one, and ``_seq_last``, the last of the one before; and the window of a slice."""
    group = list(group)
    n = df.count()
    rows = max(slice_rows(df), n // MAX_SLICES)
    if n <= rows:                               # one slice holds everything
        keyed = df.withColumn(_KEY, _key(df, order)).withColumn(_SLICE, F.lit(0))
        out = keyed.withColumn("_seq_before", F.lit(0).cast("long"))
        if value is not None:
            none = F.lit(None).cast(df.schema[value].dataType)
            out = out.withColumn("_seq_next", none).withColumn("_seq_last", none)
        return out, Window.partitionBy(*group).orderBy(_KEY)
    d = _sliced(df, group, order, rows)
    pair = None if value is None else F.struct(F.col(_KEY).alias("k"), F.col(value).alias("v"))
    ends = [] if value is None else [F.min(pair).alias("_low"), F.max(pair).alias("_high")]
    slices = d.groupBy(*group, _SLICE).agg(F.count(F.lit(1)).alias("_n"), *ends)
    w = Window.partitionBy(*group).orderBy(_SLICE)          # groups times slices: the bounds' size
    slices = slices.withColumn("_seq_before", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if value is not None:
        slices = slices.withColumn("_seq_next", F.lead(F.col("_low")["v"]).over(w)).withColumn("_seq_last", F.lag(F.col("_high")["v"]).over(w))
    slices = stored(slices.drop("_n", "_low", "_high"))
    return _by_group(d, slices, group, [_SLICE]), Window.partitionBy(*group, _SLICE).orderBy(_KEY)


def rank_within(df: DataFrame, group, order, name: str) -> DataFrame:
    """``df`` plus ``name`` = ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)."""
    d, w = _ordered(df, group, order)
    return d.withColumn(name, (F.col("_seq_before") + F.row_number().over(w)).cast("int")).drop("_seq_before", _KEY, _SLICE)


def _beside(df: DataFrame, group, order, value: str, name: str, step: int, edge: str) -> DataFrame:
    d, w = _ordered(df, group, order, value)
    d = d.withColumn("_seq_beside", F.lead(F.struct(F.col(value).alias("v")), step).over(w))
    return d.withColumn(name, F.when(F.col("_seq_beside").isNotNull(), F.col("_seq_beside")["v"]).otherwise(F.col(edge))) \
            .drop("_seq_beside", "_seq_next", "_seq_last", "_seq_before", _KEY, _SLICE)


def lead_within(df: DataFrame, group, order, value: str, name: str) -> DataFrame:
    """``df`` plus ``name`` = LEAD(value) OVER (PARTITION BY group ORDER BY order)."""
    return _beside(df, group, order, value, name, 1, "_seq_next")


def lag_within(df: DataFrame, group, order, value: str, name: str) -> DataFrame:
    """``df`` plus ``name`` = LAG(value) OVER (PARTITION BY group ORDER BY order)."""
    return _beside(df, group, order, value, name, -1, "_seq_last")


def has_hot_group(rows: DataFrame, group, limit: int) -> bool:
    """Whether a group has more than ``limit`` rows; groups are counted only where all rows together do."""
    if rows.count() <= limit:
        return False
    return not rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).isEmpty()
