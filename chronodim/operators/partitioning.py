"""Size-checked broadcast: broadcast a side only when its bytes are proven small.

The check is one exact aggregate over the side (callers pass a narrow projection, so the
scan reads only those columns; partial sums need no shuffle): its row count, and the real
bytes of its strings and other values without a fixed width.  A ``limit(n).count()`` would
stop earlier per task but funnels up to ``n`` rows of every task into one partition, which
is worse on a wide cluster.  A side over the bound is joined by shuffle instead (sort-merge
with AQE skew handling).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 64 * 1024 * 1024
_MAX_BYTES_CONF = "chronodim.broadcast.maxBytes"


# Bytes by type; values of other types are measured.
_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
          T.DecimalType: 16, T.NullType: 0}


def _row_bytes(df: DataFrame) -> int:
    # per-field width plus the 8-byte field slot of a row, without the measured values
    return 8 + sum(8 + _WIDTH.get(type(f.dataType), 0) for f in df.schema.fields)


def measured_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values without a fixed width, rounded up to 8 each (long; 0 when all are fixed)."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        if type(f.dataType) in _WIDTH:
            continue
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, (T.StringType, T.BinaryType)):
            c = F.to_json(F.struct(c))
        total = total + F.coalesce(F.octet_length(c).cast("long") + 8, F.lit(0).cast("long"))
    return total


def max_broadcast_bytes(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(_MAX_BYTES_CONF, None)
    return int(conf) if conf else DEFAULT_MAX_BYTES


def checked_broadcast(df: DataFrame, rows: int | None = None, measured: int | None = None) -> tuple[DataFrame, int, bool]:
    """Measure ``df`` once (or take its exact row count and ``measured_bytes`` sum when both
    are known); return ``(side, rows, small)`` where ``side`` is ``F.broadcast(df)`` when the
    whole side is within ``chronodim.broadcast.maxBytes``."""
    if rows is None or measured is None:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(measured_bytes(df)), F.lit(0)).alias("b")).first()
        rows, measured = int(r["n"]), int(r["b"])
    limit, width = max_broadcast_bytes(df), _row_bytes(df)
    small = width <= limit and rows * width + measured <= limit
    return (F.broadcast(df) if small else df), rows, small
