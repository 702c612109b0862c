"""Helpers shared by the operators: the shared folder, written tables, word splitting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java / Python character class.
WS = r"[\x20\x09-\x0D]"
#: One word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a local session gets a folder of its own; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="chronodim-llm-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one table of this session; removed when the session's JVM ends normally."""
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: the lineage ends
    there, so a lost executor only repeats tasks of one step."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = 2_000          # rows of a batch that are Python objects at once


def in_batches(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow`` over slices of the batches.  A worker stays for the tasks of later
    stages, so Arrow's unused memory is given back when a task's rows have ended."""
    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, BATCH_ROWS):
                yield b.slice(s, BATCH_ROWS)

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(sliced(batches))
        pa.default_memory_pool().release_unused()

    return every


def whole_text(col: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text."""
    return F.array_remove(F.split(text, WS + "+"), "")


def id_crc32(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; null ids count as 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0).cast("long"))


def named(column: str) -> Column:
    """The column of exactly this name (dots and backticks are part of it)."""
    return F.col("`" + column.replace("`", "``") + "`")


def as_struct(columns: list[str], name: str = "doc") -> Column:
    """The columns held in one by their places, so that beside it names are free."""
    return F.struct(F.lit(0).alias("none"), *[named(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias(name)


def held(columns: list[str], column: str, name: str = "doc") -> Column:
    """A column of ``as_struct(columns)``."""
    return F.col(name).getField(f"c{columns.index(column)}")


def from_struct(columns: list[str], new: dict[str, Column], name: str = "doc") -> list[Column]:
    """The columns of ``as_struct(columns)`` again, some of them with new values."""
    return [(new[c] if c in new else held(columns, c, name)).alias(c) for c in columns]


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of the text followed by a hash of all columns: rows of one digest are equal."""
    cols = [named(c) for c in df.columns]
    rest = F.xxhash64(*cols, *[c.isNull() for c in cols])
    return F.unhex(F.concat(F.sha2(whole_text("text").cast("binary"), 256), F.lpad(F.hex(rest), 16, "0")))


def hashed_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The ``n`` rows with the smallest hashes of ``key``.  Hashes are cut first, so that a
    task gives the driver its share of the sample and not ``n`` whole rows."""
    h = F.xxhash64(*key)
    last = df.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return (df.limit(0) if last is None else df.where(h <= last)).orderBy(h).limit(n)
