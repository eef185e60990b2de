"""Binary files of token ids in Simple-8b words, written and read by Spark."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import simple8b
from millrace.llm.base import query, slices, tokenizer_file
from millrace.llm.encoding import ID
from millrace.llm.ranked_bytes import ranked_id_bytes
from millrace.session import load, scratch_folder, written

MAGIC = b"S8BT"
#: A segment is closed when it holds so many ids; a file holds so many segments.
SEGMENT_IDS = 1 << 18
FILE_SEGMENTS = 64
# magic, documents, ids before the segment in its partition, ids, blocks, words, escapes
_HEAD = struct.Struct("<4sIQQIII")
_END = b"\n"


def _segment(keys: list[int | None], ids: list[bytes], before: int) -> bytes:
    values = np.frombuffer(b"".join(ids), dtype=ID)
    words, first, escapes = simple8b.encode(values)
    return b"".join(
        [
            _HEAD.pack(
                MAGIC, len(keys), before, len(values), len(first), len(words), len(escapes)
            ),
            np.array([key is None for key in keys], dtype="u1").tobytes(),
            np.array([key or 0 for key in keys], dtype="<i8").tobytes(),
            np.array([len(x) // ID.itemsize for x in ids], dtype="<u8").tobytes(),
            first.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            escapes.astype("<u8").tobytes(),
        ]
    )


def parse_segments(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, int, np.ndarray]]:
    """Keys, lengths, ids before and ids of each segment of a file."""
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, dtype=kind, count=count, offset=at)
        at += found.nbytes
        return found

    while at < len(content):
        magic, docs, before, n, blocks, words, escapes = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += _HEAD.size
        nulls, keys, lengths = take("u1", docs), take("<i8", docs), take("<u8", docs)
        first, packed, rare = take("<u4", blocks), take("<u8", words), take("<u8", escapes)
        if content[at : at + 1] != _END:
            raise ValueError("a segment without its end mark")
        at += 1
        ids = simple8b.decode(packed, first.astype(np.int64), rare, n)
        named = [None if null else key for null, key in zip(nulls, keys.tolist(), strict=True)]
        yield named, lengths.astype(np.int64), before, ids.astype(ID)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Callable[[str], bytes]:
    """The encoder of a Python worker, for all of its tasks."""
    return ranked_id_bytes(path)


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of every text (a null text: none) and ``end_id``, in ascending key order.

    Rows are dealt by ranges of (key, text hash), so that one key with many rows is spread
    too; equal keys follow by text hash, null keys come first. Each partition streams its
    documents into segments, which Spark's text sink appends to ``part-*`` files as bytes.
    No rows write no segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        end = np.array([end_id], dtype=ID).tobytes()
        keys, ids, n, before = [], [], 0, 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_segment(keys, ids, before)])], ["value"])

        for part in slices(batches):
            for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                keys.append(name)
                ids.append(encode(value or "") + end)
                n += len(ids[-1]) // ID.itemsize
                if n >= SEGMENT_IDS:
                    yield segment()
                    keys, ids, n, before = [], [], 0, before + n
        if keys:
            yield segment()

    parts = max(1, docs.rdd.getNumPartitions())
    named = docs.select(
        F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    (
        named.repartitionByRange(parts, "_key", "_hash")
        .sortWithinPartitions("_key", "_hash")
        .select("_key", "_text")
        .mapInArrow(run, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", _END.decode())
        .option("maxRecordsPerFile", FILE_SEGMENTS)
        .text(folder)
    )


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key, part, before, n_tokens, ids`` of each document in the files of ``folder``.

    ``before`` counts the ids before it in its partition ``part``; ``ids`` are unsigned
    32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            (part,), (content,) = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for keys, lengths, before, ids in parse_segments(content):
                ends = np.cumsum(lengths)
                packed = [ids[end - n : end].tobytes() for end, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([part] * len(keys), pa.int64()),
                        pa.array(before + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=[key, "part", "before", "n_tokens", "ids"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    part = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("bigint")
    return files.select(part.alias("part"), "content").mapInArrow(
        run, f"`{key}` bigint, part bigint, before bigint, n_tokens bigint, ids binary"
    )


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before, from ``part``, ``before``, ``n_tokens``."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the writer.
    bases = totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").withColumn("start", F.col("_base") + F.col("before"))


@query("op10_token_files")
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written to files and read back: where each starts, and its CRC."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    files = scratch_folder(spark)
    write_tokens(docs, files, tokenizer_file("byte_bpe_50k.json"), end_id=2)

    rows = read_tokens(spark, files).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(written(rows)).select("doc_id", "start", "n_tokens", "ids_crc32")
