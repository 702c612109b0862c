"""S6 for large dimensions: a load reads and writes only the buckets that its batch touches.

A bucketed table is a root folder with

* ``_load=<id>/_bucket=<b>/``: the rows of some key-hash buckets, written by one load;
* ``manifest=<id>.json``: for every bucket the id of the data folder that holds it, and the
  stream batches that the state holds (``origins.py``).

The bucket of a row is ``pmod(xxhash64(by), buckets)`` with ``by`` within the columns that
number versions, so a numbering group is never divided.  A load collects the touched buckets
(at most ``buckets`` ints), reads only their folders, writes their next state into a new
data folder, and commits by creating the next manifest; the folders of all other buckets are
neither read nor copied.  A crash before that leaves data that no manifest names; a manifest
that was not written to its end doesn't parse and is passed over.  One writer per table: a
second one that commits under the same id gets an error.

With ``closed_keys`` (the table's key) versions whose flag is false lie apart from the others:

* ``_load=<id>/_closed=<0|1>/_bucket=<b>/``; the manifest's ``data`` names the folders of open
  versions, ``closed`` for every bucket the folders of closed ones.

An upsert whose updates reach the batch's own versions only (``retire`` and ``redate`` are
``batch``) then reads the open versions of the touched buckets and writes them again; versions
that it closes become one more closed folder, and those closed before are not opened.  They
matter to such a load in three cases, and then the bucket is read and written whole: a staged
row has the key and timestamp of a closed version (one narrow scan of keys and ``date_from``
within the batch's time range finds these), some key has closed versions only (``whole`` in
the manifest, kept by each load for its buckets), or the bucket has ``MAX_FOLDERS`` closed
folders.  Other loads read their buckets whole.

``buckets`` should be some times the rows of a usual batch's keys for that to save much (at
65,536 buckets 10,000 keys touch 14 % of them at most).  The manifest grows with it, not with the data.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named
from ..spec import CURRENT, DATE_FROM, DimSpec
from .io import _fs, create_text, read_staging, read_text
from .origins import Origin, with_origin

DEFAULT_BUCKETS = 4096
_BUCKET = "_bucket"
_LOAD = "_load"
_CLOSED = "_closed"
MAX_FOLDERS = 32            # closed folders of a bucket, before they become one
_ENTRY = re.compile(r"^(_load|manifest)=(\d+)(?:\.json)?$")


def _ids(spark: SparkSession, root: str, kind: str | None = None) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    found = [_ENTRY.match(st.getPath().getName()) for st in fs.listStatus(p)]
    return sorted(int(m[2]) for m in found if m and kind in (None, m[1]))


def manifest_path(root: str, table_id: int) -> str:
    return f"{root.rstrip('/')}/manifest={table_id:012d}.json"


def data_path(root: str, table_id: int) -> str:
    return f"{root.rstrip('/')}/{_LOAD}={table_id:012d}"


def _read_manifest(spark: SparkSession, root: str, table_id: int) -> dict | None:
    text = read_text(spark, manifest_path(root, table_id)) or ""
    try:
        return json.loads(text) | {"id": table_id}
    except ValueError:
        return None


def latest_manifest(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest that was written to its end, or None."""
    for table_id in reversed(_ids(spark, root, "manifest")):
        if m := _read_manifest(spark, root, table_id):
            return m
    return None


def _commit(spark: SparkSession, root: str, table_id: int, manifest: dict) -> None:
    create_text(spark, manifest_path(root, table_id), json.dumps(manifest))     # fails where another load has this id


def _bucket(types: dict[str, T.DataType], cols: dict[str, str], n: int) -> Column:
    """Bucket of a row; ``cols``: column by name in the table, cast to the table's type."""
    return F.pmod(F.xxhash64(*[named(c).cast(types[d]) for d, c in cols.items()]), F.lit(n)).cast("int")


def _is_closed() -> Column:
    return F.coalesce(~F.col(CURRENT).cast("boolean"), F.lit(False))


def _write(df: DataFrame, root: str, table_id: int, bucket: Column, split: bool = False) -> tuple[list[int], list[int]]:
    """Write a data folder; return its buckets, and those with closed versions where these lie
    apart (``split``).  The rebalance hint gives files by bucket, and lets AQE split a large bucket
    over tasks and merge small ones."""
    spark = df.sparkSession
    path = data_path(root, table_id)
    parts = [_CLOSED, _BUCKET] if split else [_BUCKET]
    more = [_is_closed().cast("int").alias(_CLOSED)] if split else []
    df.select("*", *more, bucket.alias(_BUCKET)).hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)

    def found(folder: str) -> list[int]:
        fs, p = _fs(spark, folder)
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return [int(x.split("=")[1]) for x in names if x.startswith(_BUCKET + "=")]

    return (found(f"{path}/{_CLOSED}=0"), found(f"{path}/{_CLOSED}=1")) if split else (found(path), [])


def _rows(spark: SparkSession, root: str, m: dict, folders: Iterable[tuple[int, int, int]], keep: bool = False) -> DataFrame:
    """The rows of ``folders`` (load, closed, bucket); ``keep``: with their bucket."""
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    by_load: dict[tuple[int, int], list[int]] = {}
    for load, closed, b in folders:
        by_load.setdefault((load, closed), []).append(b)
    own = [T.StructField(_BUCKET, T.IntegerType())]
    if not by_load:
        return spark.createDataFrame([], T.StructType([*schema.fields, *own]) if keep else schema)
    # one scan over the folders in use; the filter is on folder names, so other buckets aren't opened
    split = "closed" in m
    names = [T.StructField(_LOAD, T.LongType()), *[T.StructField(_CLOSED, T.IntegerType())] * split, *own]
    paths = [data_path(root, i) + f"/{_CLOSED}={c}" * split for i, c in sorted(by_load)]
    rows = spark.read.schema(T.StructType([*schema.fields, *names])).option("basePath", root).parquet(*paths)
    held = reduce(or_, [(F.col(_LOAD) == i) & (F.col(_CLOSED) == c if split else F.lit(True)) & F.col(_BUCKET).isin(b)
                        for (i, c), b in by_load.items()])
    return rows.where(held).drop(*[f.name for f in names if not (keep and f.name == _BUCKET)])


def _open_folders(m: dict, buckets=None) -> list[tuple[int, int, int]]:
    return [(i, 0, int(b)) for b, i in m["data"].items() if buckets is None or int(b) in buckets]


def _closed_folders(m: dict, buckets=None) -> list[tuple[int, int, int]]:
    return [(i, 1, int(b)) for b, ids in m.get("closed", {}).items() if buckets is None or int(b) in buckets for i in ids]


def _without_open(spark: SparkSession, root: str, m: dict, table_id: int, opened: list[int], closed: list[int]) -> set[int]:
    """Buckets of the load ``table_id`` where a key has closed versions and no other (at most all buckets)."""
    keys = [named(k).alias(f"k{i}") for i, k in enumerate(m["keys"])]
    k = [f"k{i}" for i in range(len(keys))]
    gone = _rows(spark, root, m, [(table_id, 1, b) for b in closed], keep=True).select(*keys, _BUCKET).dropna(subset=k)
    held = _rows(spark, root, m, [(table_id, 0, b) for b in opened]).select(*keys)
    return {r[0] for r in gone.join(held, k, "left_anti").select(_BUCKET).distinct().collect()}


def create_table(df: DataFrame, root: str, by, n_buckets: int = DEFAULT_BUCKETS, closed_keys=None) -> int:
    """Write ``df`` as a bucketed table by the columns ``by``; return its id.  ``closed_keys``: the
    key of the table's versions; those with a false flag then lie apart."""
    spark = df.sparkSession
    if taken := {_LOAD, _BUCKET, _CLOSED} & {c.lower() for c in df.columns}:
        raise ValueError(f"column names of bucketed tables: {sorted(taken)}")
    split = closed_keys is not None
    if split and not set(by) <= set(closed_keys):
        raise ValueError(f"buckets by {list(by)} would divide versions of the key {list(closed_keys)}")
    table_id = max(_ids(spark, root), default=0) + 1
    types = {f.name: f.dataType for f in df.schema.fields}
    opened, closed = _write(df, root, table_id, _bucket(types, {c: c for c in by}, n_buckets), split)
    m = {"buckets": n_buckets, "by": list(by), "schema": df.schema.json(), "data": {str(b): table_id for b in opened}}
    if split:
        m |= {"keys": list(closed_keys), "closed": {str(b): [table_id] for b in closed}}
        m["whole"] = sorted(_without_open(spark, root, m, table_id, opened, closed))
    _commit(spark, root, table_id, m)
    return table_id


def read_table(spark: SparkSession, root: str, buckets=None, manifest: dict | None = None) -> DataFrame:
    """The newest committed state, or only some of its buckets."""
    m = manifest or latest_manifest(spark, root)
    if m is None:
        raise FileNotFoundError(f"no committed manifest under {root}")
    buckets = None if buckets is None else set(buckets)
    return _rows(spark, root, m, [*_open_folders(m, buckets), *_closed_folders(m, buckets)])


def read_open(spark: SparkSession, root: str, manifest: dict | None = None) -> DataFrame:
    """S3 on a table with closed versions apart: the others (flag true or NULL); closed folders aren't listed."""
    m = manifest or latest_manifest(spark, root)
    if m is None or "closed" not in m:
        raise ValueError(f"no table with closed versions apart under {root}")
    return _rows(spark, root, m, _open_folders(m))


def _staged_on_closed(spark: SparkSession, root: str, m: dict, staging: DataFrame, spec: DimSpec,
                      times: dict[int, tuple]) -> set[int]:
    """Touched buckets in which a staged row has key and timestamp of a closed version.
    ``times``: by touched bucket the first and last staged timestamp."""
    known = [t for t in times.values() if t[0] is not None]
    if not known:
        return set()
    at = F.col(DATE_FROM).cast("timestamp_ntz")
    pairs = list(enumerate(spec.keys))
    closed = _rows(spark, root, m, _closed_folders(m, set(times)), keep=True) \
        .where(at.between(F.lit(min(t[0] for t in known)).cast("timestamp_ntz"), F.lit(max(t[1] for t in known)).cast("timestamp_ntz"))) \
        .select(*[named(d).alias(f"k{i}") for i, (d, _) in pairs], at.alias("at"), _BUCKET)
    staged = staging.select(*[named(c).alias(f"k{i}") for i, (_, c) in pairs], named(spec.ts).cast("timestamp_ntz").alias("at"))
    hit = closed.join(staged, [*[f"k{i}" for i, _ in pairs], "at"], "left_semi")
    return {r[0] for r in hit.select(_BUCKET).distinct().collect()}          # touched buckets at most


def load_table(spark: SparkSession, root: str, staging, spec: DimSpec, batch_ts=None, fmt: str = "parquet",
               origin: Origin | None = None) -> int:
    """One load of a bucketed table; returns the id of its state afterwards (the same one
    where the batch is empty).  Columns that the spec does not name stay.  ``origin``: the stream
    and epoch of the batch, committed with it."""
    from ..plans.scd2 import apply_scd2
    m = latest_manifest(spark, root)
    if m is None:
        raise FileNotFoundError(f"no committed manifest under {root}")
    if not set(m["by"]) <= set(spec.partition_cols):
        raise ValueError(f"{spec.name}: buckets by {m['by']} would divide versions numbered by {spec.partition_cols}")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    types = {f.name: f.dataType for f in schema.fields}
    s = read_staging(spark, staging, spec, fmt)
    staged, at = dict(spec.keys), named(spec.ts).cast("timestamp_ntz")
    hit = s.groupBy(_bucket(types, {c: staged[c] for c in m["by"]}, m["buckets"]).alias("b")).agg(F.min(at), F.max(at))
    times = {r[0]: (r[1], r[2]) for r in hit.collect()}      # at most m["buckets"] rows
    if not times:
        return m["id"]
    split, touched = "closed" in m, set(times)
    whole = touched
    if split and spec.mode == "upsert" and spec.retire == spec.redate == "batch" and set(spec.key_cols) <= set(m["keys"]):
        whole = touched & ({*m["whole"]} | {int(b) for b, ids in m["closed"].items() if len(ids) >= MAX_FOLDERS})
        whole |= _staged_on_closed(spark, root, m, s, spec, {b: t for b, t in times.items() if b not in whole})
    before = _rows(spark, root, m, [*_open_folders(m, touched), *_closed_folders(m, whole)])
    nxt = apply_scd2(before, s, spec, batch_ts)
    nxt = nxt.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    table_id = max(_ids(spark, root), default=0) + 1
    opened, closed = _write(nxt, root, table_id, _bucket(types, {c: c for c in m["by"]}, m["buckets"]), split)
    nxt_m = {k: m[k] for k in ("buckets", "by", "schema", "keys") if k in m}
    nxt_m["data"] = {b: i for b, i in m["data"].items() if int(b) not in touched} | {str(b): table_id for b in opened}
    if split:
        nxt_m["closed"] = {b: ids for b, ids in m["closed"].items() if int(b) not in whole}
        for b in map(str, closed):
            nxt_m["closed"][b] = [*nxt_m["closed"].get(b, []), table_id]
        nxt_m["whole"] = sorted({*m["whole"]} - touched | _without_open(spark, root, nxt_m, table_id, opened, closed))
    _commit(spark, root, table_id, nxt_m | {"loaded": with_origin(m.get("loaded", {}), origin)})
    return table_id
