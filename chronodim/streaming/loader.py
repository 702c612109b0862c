"""Run dimension loads from a stream of staging batches.

Each micro-batch of the staging stream is one load.  The table is either a root of snapshots
(``apply_scd2`` against the newest one, published under the next free id) or a bucketed
table (``load_table``: only the batch's buckets are read and written).  The stream (the id
that its checkpoint gives it) and the epoch are part of what the load commits, and every
later state takes them over.  So a re-delivered epoch (after a driver or executor failure) is
skipped exactly when the table holds it, whatever other loads did in between; after a
half-written load it is loaded again under a new id.  A new stream starts with epoch 0 of
its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.scd2 import apply_scd2
from ..sources.buckets import latest_manifest, load_table, manifest_path
from ..sources.io import loaded_batches, publish, read_dim, read_staging
from ..sources.origins import holds
from ..spec import DimSpec

QUERY_ID = "sql.streaming.queryId"      # set by Spark within a micro-batch


def load_batch(batch: DataFrame, epoch_id: int, dim_root: str, spec: DimSpec,
               batch_ts: Callable[[int], object] | None = None, partition_by=None) -> str | None:
    """One micro-batch → one state of the table, as the path of its snapshot or manifest
    (None where the table holds the batch already)."""
    spark = batch.sparkSession
    origin = (spark.sparkContext.getLocalProperty(QUERY_ID) or "manual", epoch_id)
    ts = batch_ts(epoch_id) if batch_ts else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if manifest := latest_manifest(spark, dim_root):
        if holds(manifest.get("loaded", {}), origin):
            return None
        return manifest_path(dim_root, load_table(spark, dim_root, batch, spec, ts, origin=origin))
    if holds(loaded_batches(spark, dim_root), origin):
        return None
    nxt = apply_scd2(read_dim(spark, dim_root, spec, other_columns=True), read_staging(spark, batch, spec), spec, ts)
    return publish(nxt, dim_root, partition_by=partition_by, origin=origin)


def start_loads(staging: DataFrame, dim_root: str, spec: DimSpec, checkpoint: str,
                batch_ts: Callable[[int], object] | None = None, available_now: bool = False,
                processing_time: str | None = None, partition_by=None) -> StreamingQuery:
    """Start a streaming query that loads every staging micro-batch into the dimension at
    ``dim_root``, which must hold a committed snapshot or be a bucketed table."""
    writer = (staging.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, epoch: load_batch(df, epoch, dim_root, spec, batch_ts, partition_by)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
