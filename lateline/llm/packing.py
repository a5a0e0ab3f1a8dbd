"""Best-fit packing of documents into sequences of fixed size."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.spans import slices, texts
from lateline.llm.tokenise import encoder, with_end
from lateline.session import stage

#: Pieces of one length that are ranked by one task on average.
RANKED_ROWS = 2_000
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document's ids and end id; only longer documents are cut.

    The first piece of a cut document is the short one. Null text is empty: one piece with the end id.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, edges = with_end(*encode_texts(texts(part.column("text"))), end_id)
                sizes = np.diff(edges)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = sizes[row] - (pieces[row] - 1) * capacity
                start = np.where(number == 0, 0, head + (number - 1) * capacity)
                length = np.where(number == 0, head, capacity)
                first = edges[:-1][row] + start
                ids = np.ascontiguousarray(ids, "<u4")
                crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema=_ARROW)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(cut, _PIECE)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences (lengths in them) and how often each, for ``counts[length]`` pieces.

    Exact complements come first: from the longest piece down, its gap is looked up among
    single lengths, sums of two and sums of three, under what is still available. What no
    combination fills goes by best fit, longest first, into the least gap that holds it.
    The work depends on the capacity alone, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    kinds: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        kinds.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            combination = _complement(left, length, capacity - length)
            if combination is None:
                break
            need = Counter((length, *combination))
            times = int(min(left[n] // k for n, k in need.items()))
            for n, k in need.items():
                left[n] -= k * times
            kinds.append(((length, *combination), times))
    return kinds + _best_fit(left, capacity)


def _complement(left: np.ndarray, length: int, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that add up to the gap, of those available besides one ``length``."""
    free = left.copy()
    free[length] -= 1
    if free[gap]:
        return (gap,)
    pair = _pair(free, gap)
    if pair is not None:
        return pair
    for third in np.flatnonzero(free[:gap - 1])[::-1] if gap > 2 else ():
        free[third] -= 1
        pair = _pair(free, gap - third)
        free[third] += 1
        if pair is not None:
            return (int(third), *pair)
    return None


def _pair(free: np.ndarray, total: int) -> tuple[int, int] | None:
    small = np.arange(1, total // 2 + 1)
    much = np.minimum(free[small], free[total - small])
    if total % 2 == 0 and len(small):
        much[-1] = free[total // 2] // 2
    if not len(much) or not much.any():
        return None
    k = int(np.flatnonzero(much)[0])
    return int(total - small[k]), int(small[k])


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    open_kinds: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    room = np.zeros(capacity + 1, bool)

    def put(kind: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(kind)
        open_kinds[gap].append((kind, times))
        room[gap] = True

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            gaps = np.flatnonzero(room[length:])
            if not len(gaps):
                each = capacity // length
                if count >= each:
                    put((length,) * each, count // each)
                    count %= each
                if count:
                    put((length,) * count, 1)
                break
            gap = length + int(gaps[0])
            kind, times = open_kinds[gap].pop()
            room[gap] = bool(open_kinds[gap])
            used = min(times, count)
            if used < times:
                put(kind, times - used)
            put((*kind, length), used)
            count -= used
    return [x for kinds in open_kinds.values() for x in kinds]


def _places(kinds: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ranks of pieces of a length: where a run of ranks begins, its first sequence and its place in each."""
    key, sequence, offset, given, number = [], [], [], defaultdict(int), 0
    for kind, times in kinds:
        at = 0
        for length in kind:
            key.append((length << 44) + given[length])
            sequence.append(number)
            offset.append(at)
            given[length] += times
            at += length
        number += times
    order = np.argsort(np.array(key, np.int64))
    return np.array(key, np.int64)[order], np.array(sequence, np.int64)[order], np.array(offset, np.int64)[order]


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give each piece a ``sequence_id`` and an ``offset`` in it; sequences are gapless from 0.

    ``pieces`` (``doc_id, piece, length`` and others) is read more than once and must not change:
    pass a written table. Only the number of pieces of each length, ``capacity`` rows at
    most, reaches the driver, where the plan of lengths is made. Pieces of a length are
    then ranked, those of a frequent length in several slices with the counts before each,
    and a piece's rank says which sequence of the plan it fills. Repeated rows are
    interchangeable. An empty table gives an empty result. A length that is null, below 1 or above
    ``capacity`` fits no sequence and is an error.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().orderBy("length").limit(capacity + 2).collect()}
    wrong = sorted((n for n in histogram if n is None or not 1 <= n <= capacity), key=str)
    if wrong:
        raise ValueError(f"pieces must have 1 to {capacity} ids, but some have {wrong[:5]}")
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    key, sequence, offset = _places(plan(counts, capacity))
    shared = spark.sparkContext.broadcast((key, sequence, offset))
    cuts = spark.createDataFrame([(n, -(-c // RANKED_ROWS)) for n, c in histogram.items()], "length long, cuts long")
    rows = pieces.join(F.broadcast(cuts), "length").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "piece"), F.col("cuts"))).drop("cuts")
    before = rows.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("rows")).select(
        "length", "slice",
        (F.sum("rows").over(Window.partitionBy("length").orderBy("slice")) - F.col("rows")).alias("before"))
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "piece")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1).join(before, ["length", "slice"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key, sequence, offset = shared.value
        wanted = (length.to_numpy() << 44) + rank.to_numpy()
        at = np.searchsorted(key, wanted, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + wanted - key[at], "offset": offset[at]})

    placed = ranked.withColumn("place", place("length", F.col("rank") + F.col("before")))
    return placed.select(*pieces.columns, "place.sequence_id", "place.offset")


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents with their places in packed sequences of at most ``capacity`` ids."""
    return pack(stage(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
