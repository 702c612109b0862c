"""``apply_scd2``: one load of a versioned dimension as a single lazy plan.

Plan shape (any mode):

0. Counts.  One job counts the dimension and the staged rows (a global
   aggregate over column-less scans).
1. Split.  When the staged keys fit the broadcast bound, the dimension is
   split by broadcast semi / anti joins into the versions of touched keys and
   the untouched rest; above the bound, by the set of touched key-hash buckets
   (at most B ints).  The rest goes to the output without a shuffle.  Without
   a split the whole dimension takes step 2.
2. Hot keys.  Keys above ``chronodim.skew.hotKeyRows`` rows (touched versions
   + staged rows; found by one aggregate, skipped when all rows together do not
   pass the limit) leave the window stage for ``hotkeys.versioned_hot``.
3. One shuffle.  Touched versions and staged rows (mapped to dimension names)
   are unioned and hash-partitioned once on the key (on ``version_partition``
   when the version numbering is coarser than the key).  Every later step is a
   window whose partition columns contain that key, so no further exchange is
   planned, ordered so that consecutive windows share sorts.  Its partitions follow
   the rows that are known to come (``ROWS_A_TASK``), those of repeated new keys too:
     * the batch match (J4) and the current version of each key (one
       ``max(struct)``), the change test against it, the pairs of a repeated new
       key's rows (made here, after the shuffle), ``row_number`` for new versions;
     * ``date_to`` chained with ``lead``, flags moved with ``max``, or the
       second-latest version closed with ``row_number`` descending.
4. Staged rows with a NULL key component never match a dimension row; they
   are appended without entering any window over a real key.

The statement order of the source (inserts, then updates that see them) is
kept: step 3 computes each statement's effect on the rows the statement
would see.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import changed, due, key_ok, named, open_end, ts_literal
from ..operators.ordered import can_store, stored
from ..operators.partitioning import checked_broadcast, measured_bytes
from ..operators.versions import (_SEEN, TS, dedupe_batch, hot_key_rows, map_columns, repeated_changes, repeated_new_keys, repeats_in_task,
                                  seen_values, staged_order, staged_values)
from ..spec import CURRENT, DATE_FROM, DATE_TO, FILL, VERSION, DimSpec

# row kinds inside the load
DIM, NEW, CHG, SEEN = 0, 1, 2, 3      # SEEN: staged row that makes no version
_STG, _KIND, _CURV = "_stg", "_kind", "_cur"
ROWS_A_TASK = 250_000                 # of the load's windows


def _start(spec: DimSpec, batch_ts) -> Column:
    if spec.mode == "append_all" or spec.start == "staging":
        return F.col(TS)
    if batch_ts is None:
        raise ValueError(f"{spec.name}: start='batch' needs batch_ts")
    return ts_literal(batch_ts)


_TYPES = {VERSION: "int", CURRENT: "boolean", DATE_FROM: "timestamp_ntz", DATE_TO: "timestamp_ntz"}


def _bookkeeping_types(df: DataFrame, cols=None) -> DataFrame:
    cols = df.columns if cols is None else cols
    return df.select(*[F.col(c).cast(_TYPES[c]).alias(c) if c in _TYPES else F.col(c) for c in cols])


def _set(df: DataFrame, _keep=None, _drop=(), **cols: Column) -> DataFrame:
    """One projection that replaces / adds columns (one analyzer pass, unlike
    a chain of ``withColumn``); ``_keep`` limits the output to those columns,
    ``_drop`` removes some."""
    names = list(_keep) if _keep is not None else [c for c in df.columns if c not in _drop]
    out = [cols.pop(c).alias(c) if c in cols else F.col(c) for c in names]
    if _keep is None:
        out += [e.alias(c) for c, e in cols.items()]
    return df.select(*out)


def union_rows(d: DataFrame, s: DataFrame, spec: DimSpec, batch_ts) -> DataFrame:
    """Versions of touched keys and staged rows in one layout: dimension
    columns, ``_stg`` (staged row?), ``_ts`` (staged timestamp) and ``_seen`` (of a row that
    ``repeated_changes`` gave)."""
    body = list(spec.key_cols + spec.attr_cols + spec.carry_cols)
    seen = s.schema[_SEEN].dataType if _SEEN in s.columns else "int"
    dpart = d.select(*body, F.col(VERSION).cast("int").alias(VERSION), F.col(CURRENT).cast("boolean").alias(CURRENT),
                     F.col(DATE_FROM).cast("timestamp_ntz").alias(DATE_FROM),
                     F.col(DATE_TO).cast("timestamp_ntz").alias(DATE_TO),
                     F.lit(False).alias(_STG), F.lit(None).cast("timestamp_ntz").alias(TS), F.lit(None).cast(seen).alias(_SEEN))
    spart = s.select(
        *body, F.lit(None).cast("int").alias(VERSION), F.lit(None).cast("boolean").alias(CURRENT),
        _start(spec, batch_ts).alias(DATE_FROM), open_end().alias(DATE_TO),
        F.lit(True).alias(_STG), F.col(TS), F.col(_SEEN) if _SEEN in s.columns else F.lit(None).cast(seen).alias(_SEEN))
    return dpart.unionByName(spart)


def row_kind(spec: DimSpec, again: bool) -> Column:
    """What each row is: an old version, a new key, a changed row, or a staged row that makes none."""
    stg, curv = F.col(_STG), F.col(_CURV)
    if spec.mode == "append_all":
        return F.when(stg, F.lit(CHG)).otherwise(F.lit(DIM))
    test = changed([(curv[c], F.col(c)) for c in spec.tracked_cols], spec.null_safe)
    kind = F.when(~stg, F.lit(DIM))
    if again:
        kind = kind.when(F.col(_SEEN).isNotNull(), F.lit(CHG))
    return (kind.when(~F.col("_has_dim"), F.lit(NEW))
                .when(curv.isNotNull() & test, F.lit(CHG)).otherwise(F.lit(SEEN)))


def compared_with(spec: DimSpec, again: bool) -> tuple[Column, dict[str, Column]]:
    """Version and carried columns of the version that a changed row follows: the current one,
    or for a repeated new row the version-1 row that it differs from."""
    curv, seen = F.col(_CURV), F.col(_SEEN)

    def of(c: str) -> Column:
        return F.when(seen.isNotNull(), seen[c]).otherwise(curv[c]) if again else curv[c]
    return of("v"), {c: of(c) for c in spec.carry_cols}


def _with_repeats_in_task(u: DataFrame, spec: DimSpec, most: int) -> DataFrame:
    """``repeated_changes`` of new keys with ``most`` staged rows at most, inside the windows' tasks:
    each staged row is followed by a copy for every row of its key that differs from it."""
    wk = Window.partitionBy(*spec.key_cols)
    tracked = list(spec.tracked_cols)
    n = F.count(F.when(F.col(_STG) & F.col(_SEEN).isNull(), 1)).over(wk)
    u = _set(u, _staged_rows=n)
    mine = F.col(_STG) & ~F.col("_has_dim") & F.col(_SEEN).isNull() & F.col("_staged_rows").between(2, most)
    row = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(tracked)], seen_values(spec).alias("seen"))
    u = _set(u, _others=F.collect_list(F.when(mine, row)).over(wk))
    itself = F.lit(None).cast(u.schema["_others"].dataType.elementType)
    u = u.select(*[c for c in u.columns if c not in ("_others", "_staged_rows")],
                 F.explode(F.concat(F.array(itself), F.col("_others"))).alias("_other"))
    other = F.col("_other")
    u = u.where(other.isNull() | changed([(other[f"t{i}"], F.col(c)) for i, c in enumerate(tracked)], spec.null_safe))
    seen = u.schema[_SEEN].dataType
    return _set(u, _drop=("_other",), **{_SEEN: F.coalesce(other["seen"].cast(seen), F.col(_SEEN))})


def _versioned(d: DataFrame, s: DataFrame, spec: DimSpec, batch_ts, rows: int | None = None, in_task: int = 0) -> DataFrame:
    """Step 2 of the module doc: versions of touched keys + staged rows with
    non-NULL keys → the new state of those keys.  ``rows``: how many there will be at most;
    ``in_task``: new keys that are staged so many times at most are compared here."""
    K, P = list(spec.key_cols), list(spec.partition_cols)
    carry, tracked = list(spec.carry_cols), list(spec.tracked_cols)
    mode, again = spec.mode, _SEEN in s.columns or in_task > 1
    if in_task > 1 and _SEEN not in s.columns:
        s = s.withColumn(_SEEN, F.lit(None).cast(s.select(seen_values(spec).alias(_SEEN)).schema[_SEEN].dataType))

    # the load's only shuffle: every window below partitions by a superset of P
    u = union_rows(d, s, spec, batch_ts)
    n = -(-(rows or 0) // ROWS_A_TASK)
    u = u.repartition(n, *P) if n > u.sparkSession.sparkContext.defaultParallelism else u.repartition(*P)

    stg, ver, cur_flag, start_col = F.col(_STG), F.col(VERSION), F.col(CURRENT), F.col(DATE_FROM)
    wk = Window.partitionBy(*K)

    # (1) per-key facts, one Window node: the current version as one struct
    # (version first: deterministic even if a history holds two current rows),
    # whether the key has history, whether the batch touches it
    is_cur = ~stg & F.coalesce(cur_flag, F.lit(False))
    facts = {
        _CURV: F.max(F.when(is_cur, F.struct(ver.alias("v"), *[F.col(c) for c in tracked + carry]))).over(wk),
        "_has_dim": F.max((~stg).cast("int")).over(wk) == 1,
        "_touched": F.max(stg.cast("int")).over(wk) == 1,
    }
    if mode == "append_all":
        facts["_base"] = F.coalesce(F.max(F.when(~stg, ver)).over(wk), F.lit(0))
    if mode == "close_previous" and spec.close_at == "staging":
        facts["_close"] = F.max(F.col(TS)).over(wk)
    if mode == "upsert" and "batch" in (spec.retire, spec.redate):
        # A version is a batch row when a staged row of its key carries its
        # date_from; every staged row counts, also the ones that make no version.
        # Sorted by (key, at), this window also serves the per-key window next.
        at = F.when(stg, F.col(TS)).otherwise(start_col)
        u = _set(u, _inb=(F.max(stg.cast("int")).over(Window.partitionBy(*K, at)) == 1) & at.isNotNull())
    u = _set(u, **facts)

    if in_task > 1:
        u = _with_repeats_in_task(u, spec, in_task)

    # (2) what each staged row becomes: new key, changed, or nothing (SEEN); of the current
    # version, what changed rows take over stays
    left = F.struct(*[F.col(_CURV)[c].alias(c) for c in ("v", *carry)])
    u = _set(u, **{_KIND: row_kind(spec, again), _CURV: left})
    kd = F.col(_KIND)
    cur_version, cur_carry = compared_with(spec, again)
    repeats = mode != "append_all" and spec.new_keys == "one"
    # (3) number the new versions (W1) and fill the inserted rows
    order = staged_order(u, spec, last=spec.carry_cols)
    changed_order = order if mode == "append_all" else staged_order(u, spec, first=tuple(cur_carry.values()))
    rn_part = F.row_number().over(Window.partitionBy(*P, _KIND).orderBy(*changed_order))
    if mode == "append_all":
        version = F.col("_base") + rn_part
    elif mode == "upsert" or spec.close_numbering == "row_number":
        version = cur_version + rn_part
    else:
        version = cur_version + F.lit(1)
    new_version = (F.row_number().over(Window.partitionBy(*K, _KIND).orderBy(*order))
                   if spec.new_keys == "number" else F.lit(1))
    fill = {
        VERSION: F.when(kd == DIM, ver).when(kd == NEW, new_version).when(kd == CHG, version).cast("int"),
        CURRENT: F.when(kd == DIM, cur_flag).otherwise(F.lit(mode != "append_all")),
    }
    for c in carry:                        # P7: carry from the current version
        carried = F.coalesce(cur_carry[c], F.col(c)) if mode == "append_all" else cur_carry[c]
        fill[c] = F.when(kd == CHG, carried).otherwise(F.col(c))
    u = _set(u, _drop=(_CURV, _SEEN), **fill).where(kd != SEEN)   # SEEN rows have served J4 and the change test

    real_touched = F.col("_touched")
    if mode == "close_previous":
        # The second-latest version of a touched, due key is closed: every row
        # with the version number of the second row (Q13: there may be several)
        rn = F.row_number().over(Window.partitionBy(*K, real_touched).orderBy(
            ver.desc_nulls_last(), start_col.desc_nulls_last()))
        u = _set(u, _rn=rn)
        second = F.max(F.when(F.col("_rn") == 2, ver)).over(Window.partitionBy(*K, real_touched))
        hit = real_touched & (ver == second) & due(start_col, batch_ts, spec.due)
        if spec.reclose == "current":
            hit = hit & cur_flag
        hit = F.coalesce(hit, F.lit(False))
        close_at = F.col("_close") if spec.close_at == "staging" else ts_literal(batch_ts)
        u = _set(u, _hit=hit)
        return _set(u, _keep=spec.dim_cols,
                    **{DATE_TO: F.when(F.col("_hit"), close_at).otherwise(F.col(DATE_TO)),
                       CURRENT: F.when(F.col("_hit"), F.lit(False)).otherwise(cur_flag)})

    # date_to := next version's date_from within the scope.
    # Sorted by (key, scope, version), this window also serves the flag window.
    if mode == "append_all":
        scope = real_touched
    else:
        scope = F.col("_inb") if spec.redate == "batch" else real_touched
    nxt = F.lead(DATE_FROM).over(Window.partitionBy(*K, scope).orderBy(
        ver.asc_nulls_last(), start_col.asc_nulls_last()))
    u = _set(u, _nxt=F.when(scope, nxt))
    nxt = F.col("_nxt")
    if repeats:
        # rows of a new key share version 1, by which the update matches: all take the earliest
        nxt = F.when(kd == NEW, F.min(F.when(kd == NEW, nxt)).over(wk)).otherwise(nxt)
    date_to = F.coalesce(nxt, F.col(DATE_TO))

    if mode == "append_all":
        # U1 + U2: a touched key's current version is its highest
        flag = F.when(real_touched, ver == F.max(ver).over(wk)).otherwise(cur_flag)
    else:
        # Flag off below the highest version in scope (batch rows or touched key)
        in_scope = F.col("_inb") if spec.retire == "batch" else real_touched
        flag = F.when(ver < F.max(F.when(in_scope, ver)).over(wk), F.lit(False)).otherwise(cur_flag)
    return _set(u, _keep=spec.dim_cols, **{CURRENT: flag, DATE_TO: date_to})


def _null_key_rows(s: DataFrame, spec: DimSpec, batch_ts, skew: str = "auto") -> DataFrame:
    """Staged rows with a NULL key component: inserted as new every time (the
    anti join cannot match them); append-all numbers them like any key, which
    groups all of them under one NULL key (a hot group when they are many)."""
    order = staged_order(s, spec, last=spec.carry_cols)
    numbered = spec.mode == "append_all" or spec.new_keys == "number"
    if numbered and skew != "off" and s.count() > (0 if skew == "all" else hot_key_rows(s)):
        from ..operators.ordered import rank_within
        s = rank_within(s, list(spec.partition_cols), staged_values(s, spec, last=spec.carry_cols), "_rn")
        version = F.col("_rn")
    elif numbered:
        version = F.row_number().over(Window.partitionBy(*spec.partition_cols).orderBy(*order))
    else:
        version = F.lit(1)
    made = {VERSION: version.cast("int"), CURRENT: F.lit(spec.mode != "append_all"),
            DATE_FROM: _start(spec, batch_ts), DATE_TO: open_end()}
    return s.select(*[made[c].alias(c) if c in made else F.col(c) for c in spec.dim_cols])


def row_counts(d: DataFrame, s: DataFrame, keys) -> tuple[int, int, int]:
    """Exact row counts of the dimension and the (non-NULL-key) batch, and the measured bytes
    of the staged keys, in one job: a global aggregate over a scan of the staged keys (the
    dimension's scan reads no column: Parquet row counts)."""
    staged = s.select(*keys)
    tagged = d.select(F.lit(0).alias("_t"), F.lit(0).cast("long").alias("_b")).unionByName(
        staged.select(F.lit(1).alias("_t"), measured_bytes(staged).alias("_b")))
    r = tagged.agg(F.count(F.when(F.col("_t") == 0, 1)).alias("d"), F.count(F.when(F.col("_t") == 1, 1)).alias("s"),
                   F.coalesce(F.sum("_b"), F.lit(0)).alias("b")).first()
    return int(r["d"]), int(r["s"]), int(r["b"])


def hot_keys(touched: DataFrame, s: DataFrame, spec: DimSpec, skew: str, total: int | None = None, repeats: DataFrame | None = None):
    """Version partitions (the key itself, or the columns that numbering runs over) whose
    touched versions + staged rows exceed ``hot_key_rows``: values of partition_cols (broadcast
    when their bytes allow) or ``None``.  A partition is never divided between the two paths.  One aggregation over the key columns (partial counts
    combine before the shuffle).  ``repeats``: keys and ``_more``, the rows that they get beside their own."""
    K, P = list(spec.key_cols), list(spec.partition_cols)
    rows = touched.select(*K).unionByName(s.select(*K))
    if repeats is not None:
        rows = rows.withColumn("_more", F.lit(1).cast("long")).unionByName(repeats.select(*K, "_more"))
    if skew == "all":
        hot = s.select(*P).distinct()
    else:
        limit = hot_key_rows(s)
        # exact necessary condition first: no key can pass the limit when all
        # rows together do not (the load's row counts, or a one-stage count)
        n_rows = F.count(F.lit(1)) if repeats is None else F.sum("_more")
        if (total if total is not None else rows.agg(n_rows).first()[0] or 0) <= limit:
            return None
        # one pass over the key columns; partial counts combine before the shuffle
        hot = rows.groupBy(*P).agg(n_rows.alias("_n")).where(F.col("_n") > limit).select(*P)
    # four joins read the set: stored once where the shared folder is named (the hot path
    # needs it anyway), counted first where a local session would have to make one
    named = s.sparkSession.sparkContext.getCheckpointDir()
    hot, n, _ = checked_broadcast(stored(hot) if named else hot)
    return hot if n else None


DEFAULT_SPLIT_BUCKETS = 1 << 23
_BUCKETS_CONF = "chronodim.split.buckets"
MAX_BUCKET_SHARE = 0.5


def _split(d: DataFrame, s: DataFrame, spec: DimSpec, how: str = "auto", n_staged: int | None = None,
           key_bytes: int | None = None):
    """(versions that may be touched, versions surely untouched or None).

    1. Staged keys within the broadcast bound: broadcast semi / anti join on the key.
    2. Too many keys: broadcast the set of touched hash buckets of the key
       (``pmod(xxhash64(key), B)`` as int; at most B values whatever the batch
       size, and counted against the same byte bound).  Versions in untouched
       buckets are surely untouched and skip the shuffle; the others take the
       load's path, which leaves untouched keys as they are.  With B = 2^23
       and a 64 MiB bound this covers batches of up to about 3.5 million keys
       while routing at most a third of the history to the shuffle.
    3. Otherwise (or more than half the buckets touched): no split; the whole
       dimension takes the load's one shuffle."""
    K = list(spec.key_cols)
    if how == "auto":
        # the staged keys, no distinct: semi / anti joins only test existence
        keys, _, small = checked_broadcast(s.select(*K), n_staged, key_bytes)
        if small:
            return d.join(keys, K, "left_semi"), d.join(keys, K, "left_anti")
    conf = d.sparkSession.conf.get(_BUCKETS_CONF, None)
    n_buckets = int(conf) if conf else DEFAULT_SPLIT_BUCKETS
    bucket = F.pmod(F.xxhash64(*K), F.lit(n_buckets)).cast("int").alias("_bucket")
    buckets, n, small = checked_broadcast(s.select(bucket).distinct())
    if not small or n > MAX_BUCKET_SHARE * n_buckets:
        return d, None
    db = d.withColumn("_bucket", bucket)
    return (db.join(buckets, "_bucket", "left_semi").drop("_bucket"),
            db.join(buckets, "_bucket", "left_anti").drop("_bucket"))


def _repeats(s: DataFrame, d: DataFrame, spec: DimSpec) -> tuple[DataFrame | None, int, int, int]:
    """The new keys that are staged more than once, with ``_n`` and ``_more``, the rows that
    comparing them (Q4) makes at most; how many such rows there are, how many of them the
    windows' tasks make, and the largest ``_n``."""
    n = F.col("_n")
    more = F.when(n < 1 << 18, n * (n - 1)).otherwise(F.lit(1 << 36))       # beyond any limit, and sums fit
    keys = repeated_new_keys(s, d, spec.key_cols).withColumn("_more", more)
    if can_store(s.sparkSession):               # steps below read them again
        keys = stored(keys)
    in_windows = F.when(n <= repeats_in_task(s), F.col("_more")).otherwise(F.lit(0))
    r = keys.agg(F.sum("_more").alias("more"), F.sum(in_windows).alias("tasks"), F.max("_n").alias("most")).first()
    return (None, 0, 0, 0) if r["most"] is None else (keys, int(r["more"]), int(r["tasks"]), int(r["most"]))


def _with_repeats(s: DataFrame, repeats: DataFrame, spec: DimSpec) -> DataFrame:
    """The staged rows and those that ``repeated_changes`` adds for the given keys."""
    repeats, _, _ = checked_broadcast(repeats)
    again = repeated_changes(s, repeats, spec)
    if can_store(s.sparkSession):
        again = stored(again)
    return s.withColumn(_SEEN, F.lit(None).cast(again.schema[_SEEN].dataType)).unionByName(again)


def _with_other_columns(dim: DataFrame, staging: DataFrame, spec: DimSpec, more: list[str]):
    """The load's inputs with the dimension's other columns as staged NULLs."""
    if not more:
        return staging, spec
    none = {c: f"{FILL}{'_' * max(map(len, spec.staging_cols))}{i}" for i, c in enumerate(more)}
    staging = staging.select(*[named(c) for c in spec.staging_cols], *[F.lit(None).cast(dim.schema[c].dataType).alias(n) for c, n in none.items()])
    columns = None if spec.columns is None else spec.columns + tuple(more)
    return staging, replace(spec, payload=spec.payload + tuple(none.items()), columns=columns)


def apply_scd2(dim: DataFrame, staging: DataFrame, spec: DimSpec, batch_ts=None,
               split: str = "auto", skew: str = "auto") -> DataFrame:
    """The next state of ``dim`` after loading ``staging`` (both DataFrames).

    ``split``: ``auto`` (broadcast split on the staged keys when they are
    proven small, else on their hash buckets; see ``_split``), ``buckets``
    (the bucket split only), ``never`` (the single-shuffle path over the
    whole dimension).  Columns of ``dim`` that the spec does not name stay with their
    versions and are NULL in new ones.
    ``skew``: ``auto`` (keys above ``chronodim.skew.hotKeyRows`` rows take the
    hot-key path), ``off``, ``all`` (every touched key takes it; for tests)."""
    if names := spec.plain_names(dim.columns):
        plain = dim.select(*[named(c).alias(names.get(c, c)) for c in dim.columns])
        users = {n: c for c, n in names.items()}
        out = apply_scd2(plain, staging, spec.renamed(names), batch_ts, split, skew)
        return out.select(*[F.col(c).alias(users.get(c, c)) for c in out.columns])
    own = spec.dim_cols
    more = [c for c in dim.columns if c not in own]
    staging, spec = _with_other_columns(dim, staging, spec, more)
    s = map_columns(staging, spec)
    ok = key_ok(spec.key_cols)
    s_ok, s_null = s.where(ok), s.where(~ok)
    d = dim.select(*spec.dim_cols)

    n_dim = n_staged = key_bytes = None
    if split == "auto" or skew == "auto":
        n_dim, n_staged, key_bytes = row_counts(d, s_ok, spec.key_cols)
    touched, rest = d, None
    if split in ("auto", "buckets"):
        touched, rest = _split(d, s_ok, spec, split, n_staged, key_bytes)

    P = list(spec.partition_cols)
    total = None if n_dim is None else n_dim + n_staged

    def hot_of(staged, repeats=None):
        return hot_keys(touched, staged, spec, skew, total, repeats) if skew != "off" else None

    if spec.dedupe:
        hot = hot_of(s_ok)
        s_ok = dedupe_batch(s_ok, spec) if hot is None else \
            dedupe_batch(s_ok.join(hot, P, "left_anti"), spec).unionByName(dedupe_batch(s_ok.join(hot, P, "left_semi"), spec, True))
        s_null = dedupe_batch(s_null, spec, skew == "all")
    repeats, most, rows = None, 0, total
    if spec.mode != "append_all" and spec.new_keys == "one":
        repeats, n_again, n_made, most = _repeats(s_ok, touched, spec)
        rows = None if total is None else total + n_made
        total = None if total is None else total + n_again
    hot = hot_of(s_ok, repeats)
    # new keys that are staged often, and all repeated ones of hot partitions, take joins of classes
    in_task = min(most, repeats_in_task(s_ok))
    often = None if most <= in_task else repeats.where(F.col("_n") > in_task)
    cool_d, cool_s = touched, s_ok
    if hot is not None:
        cool_d, cool_s = touched.join(hot, P, "left_anti"), s_ok.join(hot, P, "left_anti")
        often = None if often is None else often.join(hot, P, "left_anti")
    if often is not None and not often.isEmpty():
        cool_s = _with_repeats(cool_s, often, spec)
    out = _versioned(cool_d, cool_s, spec, batch_ts, rows, in_task)
    if hot is not None:
        from .hotkeys import versioned_hot
        hot_s = s_ok.join(hot, P, "left_semi")
        if repeats is not None:
            hot_s = _with_repeats(hot_s, repeats.join(hot, P, "left_semi"), spec)
        heavy = union_rows(touched.join(hot, P, "left_semi"), hot_s, spec, batch_ts)
        out = out.unionByName(versioned_hot(heavy, spec, batch_ts, _SEEN in hot_s.columns))

    if spec.null_keys == "insert":
        out = out.unionByName(_null_key_rows(s_null, spec, batch_ts, skew))
    if rest is not None:
        out = out.unionByName(_bookkeeping_types(rest))
    return out.select(*own, *more) if more else out
