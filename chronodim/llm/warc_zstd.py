"""WARC archives with one Zstandard dictionary per file.

An archive is a sequence of Zstandard frames: first a skippable frame that holds the
dictionary, then one frame per record, compressed with it.  Of equal payloads one record is
a response and the others are revisits of it.  Files are written by Spark's own writer and
commit protocol (each row is the bytes of one frame and the line separator is an empty
skippable frame, which every decoder passes over), so they can go to any storage that Spark
reaches and a lost task leaves nothing behind.  Files keep the names that the writer gives
them (``part-*``).

A file's dictionary is trained by the task that writes it, on the file's own records: whole
ones, from the first on until they have ``TRAIN_BYTES`` together, which is all of them in a
file of the planned size.

Defined cases: a null html is an empty payload; of equal payloads of ``DEDUP_BYTES`` or more
all rows with the largest page_id are responses (also repeated rows), a null id is less than
any other; an empty table gives no records; other columns aren't read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder

DEDUP_BYTES = 1000
DICTIONARY_BYTES = 65_536
LEVEL = 3
FILE_BYTES = 32 << 20       # payload bytes that a file is planned for
TRAIN_BYTES = 40 << 20      # records of a file that its dictionary is trained on

#: Frame magic of the skippable frame that holds a dictionary, and an empty skippable frame
#: (fixed values of the formats).
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
ID_PREFIX = "urn:page:"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the samples' own bytes where there are too few to train on."""
    if sum(map(len, samples)) >= 10 * 1024 and len(samples) >= 8:
        try:
            return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, k=200, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size]


def dictionary_frame(content: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content


def archive(records: Iterator[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The frames of one file: the dictionary of its records, then a frame for each of them."""
    ahead, size = [], 0
    for r in records:
        ahead.append(r)
        size += len(r)
        if size >= TRAIN_BYTES:
            break
    if not ahead:
        return
    content = dictionary(ahead)
    yield dictionary_frame(content)
    frames = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True)
    for r in chain(ahead, records):
        yield frames.compress(r)


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID_PREFIX}{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head.insert(3, f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>")
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_references(pages: DataFrame, partitions: int, min_bytes: int = DEDUP_BYTES) -> DataFrame:
    """page_id, url, html, refers_to (the response's id for revisits, else null).

    Copies are counted by digest first; only ids of revisits are joined back to the pages.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    raw = F.col("html").cast("binary")
    same = ["digest", "n_bytes", "check"]
    d = p.where(F.octet_length("html") >= min_bytes).select(
        "page_id", F.sha1(raw).alias("digest"), F.octet_length("html").alias("n_bytes"), F.xxhash64("html").alias("check"))
    groups = d.groupBy(*same).agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"),
                                  F.count("page_id").alias("ids"), F.count(F.lit(1)).alias("n"))
    groups = groups.where((F.col("n") > 1) & ((F.col("first") < F.col("last")) | (F.col("ids") < F.col("n")))) \
                   .select(*same, "last")
    revisits = d.join(groups, same).where(F.col("last").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("last")))) \
        .groupBy("page_id", "digest", "n_bytes", "check").agg(F.max("last").alias("refers_to")).alias("r")
    # dealt out once, by the join's own keys: the pages are written as they lie here
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key")
    r = revisits.select(key, *same, "refers_to")
    p = p.select("page_id", "url", "html", key, F.when(F.octet_length("html") >= min_bytes, F.sha1(raw)).alias("digest"),
                 F.octet_length("html").alias("n_bytes"), F.xxhash64("html").alias("check"))
    return p.repartition(partitions, "key", *same).join(r, ["key", *same], "left").select("page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, path: str, min_bytes: int = DEDUP_BYTES, level: int = LEVEL,
                   file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) to ``path`` as archives."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                for page_id, url, html, refers_to in zip(*(b.column(i).slice(s, 256).to_pylist() for i in range(4))):
                    yield _record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to, refers_to is not None)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = archive(records(batches), level)
        while out := list(islice(frames, 256)):
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = with_references(pages, max(2, -(-total // file_bytes)), min_bytes)
    frames = rows.mapInArrow(compress, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", EMPTY_FRAME.decode("latin-1")).text(path)


def read_frames(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive's bytes."""
    at, plain = 0, zstandard.ZstdDecompressor()
    while at < len(raw):
        magic, size = struct.unpack_from("<II", raw, at) if len(raw) - at >= 8 else (0, 0)
        if magic == DICTIONARY_MAGIC:
            plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[at + 8:at + 8 + size]))
        if magic == DICTIONARY_MAGIC or 0x184D2A50 <= magic <= 0x184D2A5F:      # skippable frames
            at += 8 + size
            continue
        frame, parts, step = plain.decompressobj(), [], 8192
        while not frame.eof:
            if at >= len(raw):
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(raw[at:at + step]))
            at, step = min(at + step, len(raw)), min(2 * step, 1 << 20)
        at -= len(frame.unused_data)
        record = b"".join(parts)
        top, _, rest = record.partition(b"\r\n\r\n")
        version, *lines = top.decode("utf-8", "surrogatepass").split("\r\n")
        head = dict(x.partition(": ")[::2] for x in lines)
        n = int(head["Content-Length"])
        if version != "WARC/1.1" or rest[n:] != b"\r\n\r\n":
            raise ValueError(f"not a record: {top[:40]!r}")
        yield head, rest[:n]


def _page(name: str) -> int | None:
    x = name.strip("<>").removeprefix(ID_PREFIX)
    return int(x) if x else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; a
    response's payload is checked against its digest."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for b in batches:
            for raw in b.column(0):
                rows = []
                for head, block in read_frames(raw.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    sha1 = binascii.hexlify(base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))).decode()
                    if head["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1):
                        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                    rows.append((_page(head["WARC-Record-ID"]), size, sha1, head["WARC-Type"],
                                 _page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared folder and read the archives back."""
    path = new_folder(pages.sparkSession, "archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
