"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import OPEN_END


def named(column: str) -> Column:
    """The column of exactly this name (dots and backticks are part of it)."""
    return F.col("`" + column.replace("`", "``") + "`")


def open_end() -> Column:
    """The open-end sentinel as TIMESTAMP_NTZ (the parquet timestamps load as NTZ)."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def ts_literal(value) -> Column:
    """A batch clock literal as TIMESTAMP_NTZ; one value for the whole load."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def batch_date(batch_ts) -> Column:
    return ts_literal(batch_ts).cast("date")


def key_ok(cols) -> Column:
    """True when no key column is NULL (a NULL key never matches with ``=``)."""
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def differs(left: Column, right: Column, null_safe: bool = False) -> Column:
    """``left <> right`` (NULL on either side is no change) or its null-safe form."""
    return ~left.eqNullSafe(right) if null_safe else left != right


def changed(pairs, null_safe: bool = False) -> Column:
    """OR of per-column differences, NULL folded to false (three-valued ``<>``)."""
    return F.coalesce(reduce(or_, [differs(a, b, null_safe) for a, b in pairs]), F.lit(False))


def due(date_from: Column, batch_ts, how: str = "date") -> Column:
    """Close-previous filter: ``date_from::date <= CURRENT_DATE`` (``date``) or
    ``date_from <= CURRENT_DATE`` compared as a timestamp at midnight (``midnight``)."""
    day = batch_date(batch_ts)
    if how == "date":
        return F.to_date(date_from) <= day
    if how == "midnight":
        return date_from <= day.cast("timestamp_ntz")
    raise ValueError(how)
