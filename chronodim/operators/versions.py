"""Step-wise operators that build new versions (insert side of a load).

Each function takes and returns DataFrames; the staging batch is first mapped
to dimension column names with ``map_columns`` (its change timestamp becomes
``_ts``).  Joins are equi-joins on the key; a NULL key never matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import changed, named, open_end, ts_literal
from ..spec import CURRENT, DATE_FROM, DATE_TO, VERSION, DimSpec

DEFAULT_HOT_KEY_ROWS = 5_000_000
_HOT_CONF = "chronodim.skew.hotKeyRows"


def hot_key_rows(df: DataFrame) -> int:
    """Rows of one key above which it is ordered in slices."""
    conf = df.sparkSession.conf.get(_HOT_CONF, None)
    return int(conf) if conf else DEFAULT_HOT_KEY_ROWS


TS = "_ts"          # staged change timestamp after map_columns
CUR = "cur_"        # prefix of columns taken from the current version


def map_columns(s: DataFrame, spec: DimSpec) -> DataFrame:
    """Staging → dimension names (one source column may feed several
    targets); carry columns hold the value a new key starts with."""
    cols = [named(src).alias(dst) for dst, src in spec.keys + spec.tracked + spec.payload + spec.carry]
    return s.select(*cols, named(spec.ts).cast("timestamp_ntz").alias(TS))


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def staged_values(rows: DataFrame, spec: DimSpec, first: tuple[Column, ...] = (), last: tuple[str, ...] = ()) -> list[Column]:
    """The columns that order staged rows: timestamp, ``tiebreak``, the carried columns (``first`` or
    ``last``), and the values of all others.  It is the same in every form of a load."""
    return [F.col(TS), *[F.col(c) for c in spec.tiebreak], *first,
            *[F.col(c) for c in spec.order_cols + last if _orderable(rows.schema[c].dataType)]]


def staged_order(rows: DataFrame, spec: DimSpec, first: tuple[Column, ...] = (), last: tuple[str, ...] = ()) -> list[Column]:
    """``staged_values`` as a window's order."""
    return [c.asc_nulls_last() for c in staged_values(rows, spec, first, last)]


def current(d: DataFrame) -> DataFrame:
    """S3: the current versions (``lastversion = true``; NULL is not current)."""
    return d.where(F.col(CURRENT) == F.lit(True))


def new_rows(s: DataFrame, d: DataFrame, spec: DimSpec) -> DataFrame:
    """Staged rows whose key is absent from the dimension (anti join)."""
    return s.join(d.select(*spec.key_cols), list(spec.key_cols), "left_anti")


def open_row(rows: DataFrame, spec: DimSpec, version=1, is_current=True,
             date_from=None) -> DataFrame:
    """Give staged rows the bookkeeping columns of a fresh version.

    ``version``/``is_current`` are literals or Columns; ``date_from`` defaults to
    the staged timestamp (pass a batch clock for ``start='batch'``)."""
    v = version if not isinstance(version, int) else F.lit(version)
    c = is_current if not isinstance(is_current, bool) else F.lit(is_current)
    start = F.col(TS) if date_from is None else ts_literal(date_from)
    return rows.select(
        *[F.col(c_) for c_ in spec.key_cols + spec.attr_cols + spec.carry_cols],
        v.cast("int").alias(VERSION), c.cast("boolean").alias(CURRENT),
        start.alias(DATE_FROM), open_end().alias(DATE_TO),
    )


def append_versions(d: DataFrame, new: DataFrame, spec: DimSpec) -> DataFrame:
    """``INSERT INTO d SELECT …`` as a union by name in the dimension's order."""
    cols = list(spec.dim_cols)
    return d.select(*cols).unionByName(new.select(*cols))


def changed_rows(s: DataFrame, d: DataFrame, spec: DimSpec, cols=None,
                 null_safe: bool | None = None) -> DataFrame:
    """Staged rows joined to the current version of their key
    that differ in a tracked column.  Adds ``cur_version`` and the carried
    columns taken from the current version."""
    cols = tuple(cols) if cols is not None else spec.tracked_cols
    null_safe = spec.null_safe if null_safe is None else null_safe
    cur = current(d).select(
        *spec.key_cols,
        *[F.col(c).alias(CUR + c) for c in cols],
        *[F.col(c).alias(CUR + c) for c in spec.carry_cols if c not in cols],
        F.col(VERSION).alias(CUR + VERSION),
    )
    joined = s.join(cur, list(spec.key_cols), "inner")
    test = changed([(F.col(CUR + c), F.col(c)) for c in cols], null_safe)
    out = joined.where(test)
    for c in spec.carry_cols:           # P7: carry from the current version
        out = out.withColumn(c, F.col(CUR + c))
    return out.select(*s.columns, F.col(CUR + VERSION).alias("cur_version"))


def max_version(d: DataFrame, keys) -> DataFrame:
    """A1: ``SELECT K, MAX(version) … GROUP BY K`` (partial + final aggregate)."""
    return d.groupBy(*keys).agg(F.max(VERSION).cast("int").alias("max_version"))


def with_max_version(s: DataFrame, d: DataFrame, keys) -> DataFrame:
    """Left join staged rows to the pre-aggregated per-key max version."""
    return s.join(max_version(d, keys), list(keys), "left")


def number_versions(rows: DataFrame, spec: DimSpec, base: str = "cur_version",
                    skewed: bool | None = None) -> DataFrame:
    """``base + ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts)``.

    ``base`` is a column (``cur_version`` after ``changed_rows``,
    ``max_version`` after ``with_max_version``); NULL counts as 0 (P9).
    ``skewed``: number slices of the order instead of whole groups (default: if a
    group has more rows than the hot-key limit)."""
    if base == "cur_version":                   # carried columns are the current version's here
        order = staged_values(rows, spec, first=tuple(F.col(c) for c in spec.carry_cols))
    else:
        order = staged_values(rows, spec, last=spec.carry_cols)
    from .ordered import has_hot_group, rank_within
    if skewed is None:
        skewed = has_hot_group(rows.select(*spec.partition_cols), spec.partition_cols, hot_key_rows(rows))
    if skewed:
        rows = rank_within(rows, list(spec.partition_cols), order, "_rn")
        rn = F.col("_rn")
    else:
        rn = F.row_number().over(Window.partitionBy(*spec.partition_cols).orderBy(*[c.asc_nulls_last() for c in order]))
    out = rows.withColumn(VERSION, (F.coalesce(F.col(base), F.lit(0)) + rn).cast("int"))
    return out.drop("_rn") if skewed else out


def dedupe_batch(s: DataFrame, spec: DimSpec, hot: bool = False) -> DataFrame:
    """Q3 option: drop staged rows equal in every tracked column (NULL-safe) to
    the staged row before them of the same key (by timestamp, then tiebreak).
    ``hot``: take the previous row with the skew-proof ordered helper instead of
    a window over the key."""
    order = staged_order(s, spec, last=spec.carry_cols)
    prev_struct = F.struct(*[F.col(c) for c in spec.tracked_cols])
    if hot:
        from .ordered import lag_within
        values = staged_values(s, spec, last=spec.carry_cols)
        s = lag_within(s.withColumn("_cmp", prev_struct), list(spec.key_cols), values, "_cmp", "_prev").drop("_cmp")
    else:
        s = s.withColumn("_prev", F.lag(prev_struct).over(Window.partitionBy(*spec.key_cols).orderBy(*order)))
    same = F.lit(True)
    for c in spec.tracked_cols:
        same = same & F.col("_prev")[c].eqNullSafe(F.col(c))
    return s.where(F.col("_prev").isNull() | ~same).drop("_prev")


REPEATS_IN_TASK = 2_000     # staged rows of a new key that are compared with each other in its task
_REPEATS_CONF = "chronodim.repeats.inTask"
_SEEN = "_seen"     # carried values of the version-1 row that a repeated new row is compared with


def repeats_in_task(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(_REPEATS_CONF, None)
    return int(conf) if conf else REPEATS_IN_TASK


def seen_values(spec: DimSpec) -> Column:
    """What a changed row takes over from the version-1 row that it differs from."""
    return F.struct(F.lit(1).alias("v"), *spec.carry_cols)


def repeated_new_keys(s: DataFrame, d: DataFrame, keys) -> DataFrame:
    """Keys that are staged more than once and absent from the dimension, and how often (``_n``)."""
    often = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return often.join(d.select(*keys), list(keys), "left_anti")


def repeated_changes(s: DataFrame, repeated: DataFrame, spec: DimSpec) -> DataFrame:
    """Step 2 on step 1's rows (Q4): a new key staged more than once (``repeated``) gives a changed
    row for each pair of its staged rows that differ.  ``s``'s columns and ``_seen``, the other
    row's carried values.

    Rows are compared by classes of equal tracked values, of which the ones that differ are
    joined; a class's rows count by their carried values.  So equal rows cost a count, and
    the work beyond that is the result's rows."""
    K = list(spec.key_cols)
    new = s.join(repeated.select(*K), K, "left_semi").withColumn("_class", F.struct(*spec.tracked_cols))
    seen = seen_values(spec).alias(_SEEN)
    counts = new.groupBy(*K, "_class", seen).agg(F.count(F.lit(1)).alias("_n"))
    mine = counts.select(*K, "_class").distinct()
    other = counts.withColumnRenamed("_class", "_other")
    test = changed([(F.col("_other")[c], F.col("_class")[c]) for c in spec.tracked_cols], spec.null_safe)
    pairs = mine.join(other, K).where(test).drop("_other")
    rows = new.join(pairs, [*K, "_class"])
    block = 10_000                              # copies given out by one array
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block))))
    inside = F.sequence(F.lit(1).cast("long"), F.least(F.lit(block).cast("long"), F.col("_n") - F.col("_block") * block))
    return rows.withColumn("_copy", F.explode(inside)).select(*s.columns, _SEEN)


def next_version_plus_one(rows: DataFrame) -> DataFrame:
    """P8 (close-previous form): ``version + 1`` for every changed row."""
    return rows.withColumn(VERSION, (F.col("cur_version") + F.lit(1)).cast("int"))

