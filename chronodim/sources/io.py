"""Sources and the snapshot sink.

S1/S2 read a staging batch / a dimension with only the spec's columns, so the
Parquet scan prunes columns.  S6 replaces ``BEGIN … COMMIT``: each load writes
one new snapshot directory under the dimension's root; the write job's commit
protocol drops ``_SUCCESS`` last, and readers only ever pick the newest
snapshot that has it.  A crashed or half-written load is therefore invisible,
and the previous snapshot stays the table.  A snapshot's folder begins with the record of
the stream batches that it holds (``origins.py``), so that a batch and the note of it
are committed by the same ``_SUCCESS``.  All listing goes through the
Hadoop FileSystem of the path, so the same code runs on HDFS / object stores.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import named
from ..spec import CURRENT, DATE_FROM, DATE_TO, VERSION, DimSpec
from .origins import Loaded, Origin, with_origin

_BOOK_TYPES = {VERSION: "int", CURRENT: "boolean", DATE_FROM: "timestamp_ntz", DATE_TO: "timestamp_ntz"}

SNAPSHOT = "snapshot="
RECORD = "_loaded.json"
_SNAP_RE = re.compile(r"^snapshot=(\d+)$")


def _read(spark: SparkSession, source, fmt: str) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if fmt == "table":
        return spark.table(source)
    return spark.read.format(fmt).load(source)


def read_staging(spark: SparkSession, source, spec: DimSpec, fmt: str = "parquet") -> DataFrame:
    """The whole staging batch, pruned to the columns the spec uses."""
    return _read(spark, source, fmt).select(*[named(c) for c in spec.staging_cols])


def read_dim(spark: SparkSession, source, spec: DimSpec, fmt: str = "parquet", other_columns: bool = False) -> DataFrame:
    """The full history of the dimension, pruned to the spec's columns; a load that
    publishes the table again takes its ``other_columns`` along.  ``source`` may be a snapshot root (the newest committed snapshot is read)."""
    if isinstance(source, str) and fmt == "parquet" and snapshots(spark, source):
        df = read_latest(spark, source)
    else:
        df = _read(spark, source, fmt)
    # a snapshot partitioned by the flag reads it back as a directory value
    return df.select(*[F.col(c).cast(_BOOK_TYPES[c]).alias(c) if c in _BOOK_TYPES else named(c)
                       for c in [*spec.dim_cols, *[c for c in df.columns if other_columns and c not in spec.dim_cols]]])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an error where there is one already."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def snapshots(spark: SparkSession, root: str) -> list[int]:
    """Committed snapshot ids under ``root`` (directories holding ``_SUCCESS``)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    ids = []
    for st in fs.listStatus(p):
        m = _SNAP_RE.match(st.getPath().getName())
        if st.isDirectory() and m and fs.exists(st.getPath().suffix("/_SUCCESS")):
            ids.append(int(m.group(1)))
    return sorted(ids)


def _all_ids(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(int(m.group(1)) for st in fs.listStatus(p)
                  if (m := _SNAP_RE.match(st.getPath().getName())))


def next_id(spark: SparkSession, root: str) -> int:
    """One past every id present, committed or not."""
    ids = _all_ids(spark, root)
    return (ids[-1] + 1) if ids else 1


def snapshot_path(root: str, snap_id: int) -> str:
    return f"{root.rstrip('/')}/{SNAPSHOT}{snap_id:012d}"


def claim(spark: SparkSession, root: str, snap_id: int, loaded: Loaded) -> str:
    """Begin a snapshot with the record of the stream batches that it will hold; return its path.
    An id that another load has begun gives an error."""
    path = snapshot_path(root, snap_id)
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(f"{path} is there already")
    create_text(spark, f"{path}/{RECORD}", json.dumps(loaded))
    return path


def loaded_batches(spark: SparkSession, root: str) -> Loaded:
    """The stream batches in the newest committed snapshot.  Snapshots that another writer made
    hold no record; the one before them counts."""
    for snap_id in reversed(snapshots(spark, root)):
        text = read_text(spark, f"{snapshot_path(root, snap_id)}/{RECORD}")
        if text is not None:
            return json.loads(text)
    return {}


def publish(df: DataFrame, root: str, snap_id: int | None = None,
            partition_by=None, origin: Origin | None = None) -> str:
    """Write ``df`` as the next snapshot of ``root``; return its path.

    The id defaults to one past every id present (committed or not), so a
    retried load never writes into a half-written directory.  ``partition_by``
    (e.g. ``["lastversion"]``) lets current-version scans prune files.  ``origin``: the
    stream and epoch of the batch, which the snapshot then holds beside the batches before it."""
    spark = df.sparkSession
    if snap_id is None:
        snap_id = next_id(spark, root)
    path = claim(spark, root, snap_id, with_origin(loaded_batches(spark, root), origin))
    writer = df.write.mode("append")                    # into the folder that holds the record
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed snapshot of ``root``."""
    ids = snapshots(spark, root)
    if not ids:
        raise FileNotFoundError(f"no committed snapshot under {root}")
    return spark.read.parquet(snapshot_path(root, ids[-1]))
