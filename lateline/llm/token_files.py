"""Token ids in files of compressed byte or bit planes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lateline.llm.spans import slices, texts
from lateline.llm.tokenise import encoder, with_end

#: Ids in a block.
BLOCK = 65_536
_LEVEL = 3
_ROW = """part int, block int, first long, n_ids int, bits boolean, planes array<binary>,
docs array<struct<doc_id: long, start: long, n_tokens: long>>"""
_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("bits", pa.bool_()),
    ("planes", pa.list_(pa.binary())),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])))])


def planes_of(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Transpose a block of ids into planes, lowest first, and compress each; planes of zeros at the top are left out."""
    matrix = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        matrix = np.unpackbits(matrix, axis=1, bitorder="little")
    used = np.flatnonzero(matrix.any(axis=0))
    squeeze = zstandard.ZstdCompressor(level=_LEVEL).compress
    rows = np.ascontiguousarray(matrix.T[:used[-1] + 1 if len(used) else 0])
    return [squeeze((np.packbits(x) if bits else x).tobytes()) for x in rows]


def ids_of(planes: list[bytes], n_ids: int, bits: bool = False) -> np.ndarray:
    """The block of ids back from its planes."""
    matrix = np.zeros((32 if bits else 4, n_ids), np.uint8)
    restore = zstandard.ZstdDecompressor().decompress
    for k, plane in enumerate(planes):
        x = np.frombuffer(restore(plane), np.uint8)
        matrix[k] = np.unpackbits(x, count=n_ids) if bits else x
    rows = np.ascontiguousarray(matrix.T)
    return (np.packbits(rows, axis=1, bitorder="little") if bits else rows).view("<u4").reshape(-1)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: bool = False,
                      id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode whole texts and write their ids in ascending order of the identifier.

    The files under ``path`` are Parquet: ``blocks`` has a row for each block of up to
    ``BLOCK`` ids of a part (the planes, and the documents that have ids in it), ``index`` has
    where each block begins among all ids. Parts are ranges of identifiers, blocks of a
    part follow each other, and documents run on from block to block.

    Null text is an empty document, which has the end id alone; null identifiers come
    first; repeated rows are written each. An empty table writes no block.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part = encoder(tokenizer), TaskContext.get().partitionId()
        pending, waiting, first, block, after = [], 0, 0, 0, 0
        open_docs: list[tuple] = []

        def emit(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal first, block, open_docs
            stop = first + len(ids)
            inside = [d for d in open_docs if d[1] < stop]
            open_docs = [d for d in open_docs if d[1] + d[2] > stop]
            row = {"part": part, "block": block, "first": first, "n_ids": len(ids), "bits": bits,
                   "planes": planes_of(ids, bits),
                   "docs": [{"doc_id": d[0], "start": d[1], "n_tokens": d[2]} for d in inside]}
            first, block = stop, block + 1
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            for piece in slices(batch, "text"):
                ids, edges = with_end(*encode_texts(texts(piece.column("text"))), end_id)
                sizes = np.diff(edges).tolist()
                for key, size in zip(piece.column("id").to_pylist(), sizes):
                    open_docs.append((key, after, size))
                    after += size
                pending.append(ids)
                waiting += len(ids)
                if waiting >= BLOCK:
                    ids = np.concatenate(pending)
                    full = waiting // BLOCK * BLOCK
                    for k in range(0, full, BLOCK):
                        yield emit(ids[k:k + BLOCK])
                    pending, waiting = [ids[full:]], waiting - full
        if waiting:
            yield emit(np.concatenate(pending))

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(encode, _ROW).write.option("compression", "none").parquet(f"{path}/blocks")
    blocks = docs.sparkSession.read.schema(_ROW).parquet(f"{path}/blocks")
    starts = part_starts(blocks)
    index = blocks.select("part", "block", "first", "n_ids", F.col("docs")[0]["doc_id"].alias("first_doc"))
    index.join(F.broadcast(starts), "part").select(
        "part", "block", (F.col("before") + F.col("first")).alias("start"), "n_ids", "first_doc",
    ).write.parquet(f"{path}/index")


def part_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each part. One row for each part written, so as many as the writing job had tasks."""
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part")) - F.col("ids")
    return sums.select("part", before.cast("long").alias("before"))


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``doc_id``, ``start`` among all ids, ``n_tokens`` and ``ids_crc32`` of each document.

    Each block is decoded by itself. A document that runs over several blocks has a checksum
    for its piece in each, and these are put together.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, first = ids_of(row["planes"], row["n_ids"], row["bits"]), row["first"]
                out = []
                for d in row["docs"]:
                    piece = ids[max(d["start"] - first, 0):d["start"] + d["n_tokens"] - first]
                    out.append((row["part"], d["doc_id"], d["start"], d["n_tokens"], row["block"],
                                zlib.crc32(np.ascontiguousarray(piece)), 4 * len(piece)))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (
                    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    ["part", "doc_id", "begin", "n_tokens", "block", "crc", "bytes"])

    blocks = spark.read.schema(_ROW).parquet(f"{path}/blocks")
    pieces = blocks.mapInArrow(
        decode, "part int, doc_id long, begin long, n_tokens long, block int, crc long, bytes long")
    whole = pieces.groupBy("part", "begin", "doc_id", "n_tokens").agg(
        F.sort_array(F.collect_list(F.struct("block", "crc", "bytes"))).alias("pieces"))
    return whole.join(F.broadcast(part_starts(blocks)), "part").select(
        "doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens",
        joined_crc32("pieces").alias("ids_crc32"))


def crc32_behind(crc: int, crc_next: int, size_next: int) -> int:
    """Checksum of two byte strings one after the other, from theirs; the step is affine in the state."""
    zeros = bytes(size_next)
    return zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ crc_next


@F.pandas_udf(LongType())
def joined_crc32(pieces: pd.Series) -> pd.Series:
    def join(row) -> int:
        crc = row[0]["crc"]
        for x in row[1:]:
            crc = crc32_behind(crc, x["crc"], x["bytes"])
        return crc
    return pieces.map(join)
