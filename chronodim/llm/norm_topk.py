"""Exact top-k by inner product over norm buckets.

Vectors are grouped by length into buckets of about ``BUCKET_ROWS`` rows (quantiles of the
squared norm; a bucket made larger by ties is salted by id).  The longest vectors give each
query a first bound on its k-th best score.  With that bound a bucket has a local cosine
threshold for each query, ``bound / (|q| * longest in the bucket)``: above 1 the bucket is
skipped; where it is high, rows are pruned by coordinate (a unit vector within that cosine of
the query has each coordinate in a known interval); else rows are pruned by length (a shorter
row can't reach the bound).  What is left is verified by exact integer products.

Queries go through the buckets in blocks: a task holds one block and one bucket.  A task
keeps k rows per query, and rows below the bound are dropped there.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no
part; vectors of different lengths are compared over their common coordinates; ties go to the
smaller id; rows that repeat an id are candidates each, and a query leaves out all rows of
its own id; rows without an id take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 20
SCALE = 64
BUCKET_ROWS = 1024
QUERY_ROWS = 2048
MAX_RANGES = 1024           # norm ranges; beyond, ranges are salted
COORDINATE_COSINE = 0.6     # local thresholds from which coordinates are used
FOCUS = 3                   # coordinates looked at: the query's largest
RESULT = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long) and norm2 of the vectors that take part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(vec, lambda x: F.floor(x.cast("double") * scale))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)))


def bucketed(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, max_ranges: int = MAX_RANGES) -> tuple[DataFrame, list]:
    """Add ``bucket`` (norm range) and ``salt`` (for ranges of more than two buckets' rows); also
    (bucket, salts, largest norm2) of each range, ``max_ranges`` at most."""
    n = rows.count()
    ranges = max(1, min(max_ranges, -(-n // bucket_rows)))
    if ranges > 1:
        cuts = rows.agg(F.percentile_approx("norm2", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
        bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))])
        rows = rows.withColumn("bucket", F.size(F.filter(bounds, lambda c: c < F.col("norm2"))))
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    info = [tuple(r) for r in rows.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / (2 * bucket_rows)).cast("int"), F.max("norm2")).collect()]
    salts = F.create_map(*[F.lit(x) for b, s, _ in info for x in (b, s)]) if info else F.create_map(F.lit(0), F.lit(1))
    return rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), salts[F.col("bucket")]).cast("int")), info


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v[:width]
    return out


def _widest(*frames: pd.DataFrame) -> int:
    return max((len(v) for f in frames for v in f["v"]), default=0)


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products: as doubles where no partial sum can pass 2 ** 53."""
    most = np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * q.shape[1]
    if most < 2 ** 53:
        return (q @ p.T).astype(np.int64)
    return q.astype(np.int64) @ p.astype(np.int64).T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.nonzero(scores >= cut)[0]
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search_bucket(queries: pd.DataFrame, bucket: pd.DataFrame, k: int) -> pd.DataFrame:
    """The rows of one bucket that may be among the k best of each query: columns vec_id, v
    and norm2, for queries also ``bound`` (NaN: none yet)."""
    width = _widest(queries, bucket)
    bucket = bucket.sort_values("norm2", ascending=False, kind="stable")
    p, q = _matrix(bucket["v"].to_numpy(), width), _matrix(queries["v"].to_numpy(), width)
    p_len = np.sqrt(bucket["norm2"].to_numpy(float))
    q_len = np.sqrt(queries["norm2"].to_numpy(float))
    ids, own = bucket["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    bound = queries["bound"].to_numpy(float)
    unit = p / np.maximum(p_len, 1e-300)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = bound / (q_len * p_len[0])
    local[np.isnan(bound) | (bound <= 0)] = -1.0      # no bound that lengths or cosines could miss
    out_q, out_p, out_s = [], [], []

    def keep(i: int, rows: np.ndarray, s: np.ndarray) -> None:
        fit = ids[rows] != own[i]
        if bound[i] == bound[i]:
            fit &= s >= bound[i]
        rows, s = rows[fit], s[fit]
        at = _best(ids[rows], s, k)
        out_q.append(np.full(len(at), own[i])), out_p.append(ids[rows[at]]), out_s.append(s[at])

    slack = 1e-9
    by_coordinate = (local >= COORDINATE_COSINE) & (local <= 1 + slack)
    for i in np.nonzero(by_coordinate)[0]:
        t, u = min(1.0, local[i] - slack), q[i] / q_len[i]
        rows = np.arange(int(np.searchsorted(-p_len, -(bound[i] / q_len[i]) * (1 - slack), side="right")))
        for f in np.argsort(-np.abs(u))[:FOCUS]:
            half = np.sqrt(max(0.0, 1 - u[f] * u[f])) * np.sqrt(max(0.0, 1 - t * t)) + slack
            x = unit[rows, f]
            rows = rows[(x >= u[f] * t - half) & ((x <= u[f] * t + half) | (u[f] >= t))] if u[f] >= 0 else \
                rows[(x <= u[f] * t + half) & ((x >= u[f] * t - half) | (-u[f] >= t))]
        if len(rows):
            keep(i, rows, _products(q[i:i + 1], p[rows])[0])
    by_length = np.nonzero(local < COORDINATE_COSINE)[0]
    for s in range(0, len(by_length), 512):
        some = by_length[s:s + 512]
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(local[some] > 0, bound[some] / q_len[some], 0.0) * (1 - slack)
        n = np.searchsorted(-p_len, -least, side="right")
        scores = _products(q[some], p[:int(n.max(initial=0))])
        for j, i in enumerate(some):
            if n[j]:
                keep(i, np.arange(n[j]), scores[j, :n[j]])
    none = [np.zeros(0, np.int64)]
    return pd.DataFrame({"query_id": np.concatenate(out_q + none).astype(np.int64),
                         "vec_id": np.concatenate(out_p + none).astype(np.int64),
                         "score": np.concatenate(out_s + none).astype(np.int64)})


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vec: str = "embedding",
          bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row where ``is_query`` holds
    (a condition on vec_id), exactly."""
    spark = vectors.sparkSession
    rows, info = bucketed(written(scaled(vectors, vec), "vectors"), bucket_rows)
    rows = written(rows, "buckets")
    # the longest vectors: bucket_rows at most, whatever the input
    longest = rows.orderBy(F.desc("norm2"), "vec_id").limit(bucket_rows).select("vec_id", "v", "norm2").toPandas()
    seed = spark.sparkContext.broadcast(longest)

    def first_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            d = rb.to_pandas()
            d["bound"] = np.nan
            got = search_bucket(d, seed.value, k) if len(d) and len(seed.value) else None
            if got is not None:
                full = got.groupby("query_id")["score"].agg(["min", "size"])
                full = full[full["size"] >= k]["min"]
                d["bound"] = d["vec_id"].map(full).astype(float)
            yield pa.RecordBatch.from_pandas(d, schema=_QUERY, preserve_index=False)

    queries = rows.where(is_query).select("vec_id", "v", "norm2").distinct()
    queries = written(queries.mapInArrow(first_bound, "vec_id long, v array<long>, norm2 long, bound double"), "queries")
    blocks = max(1, -(-queries.count() // query_rows))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # a bucket is dealt to every block of queries, a query to the buckets whose longest vector can reach its bound
    ranges = F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(n).alias("salts"), F.lit(m).cast("double").alias("most"))
                       for b, n, m in info]) if info else F.array().cast("array<struct<bucket:int,salts:int,most:double>>")
    left = left.withColumn("range", F.explode(ranges))
    out_of_reach = (F.col("bound") > 0) & (F.col("bound") * F.col("bound") > F.col("norm2") * F.col("range.most") * (1 + 1e-9))
    left = left.where(F.isnan("bound") | F.col("bound").isNull() | ~out_of_reach) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("range.salts") - 1))) \
        .select("block", "range.bucket", "salt", "vec_id", "v", "norm2", "bound")
    right = rows.withColumn("block", every).select("block", "bucket", "salt", "vec_id", "v", "norm2")

    def pair(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="int64")})
        return search_bucket(q, p, k)

    on = ["block", "bucket", "salt"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(pair, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


_QUERY = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("norm2", pa.int64()), ("bound", pa.float64())])
