"""SimHash fingerprints, and the join of those that differ in few bits by balls that meet halfway."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.components import components, least_connected
from lateline.llm.spans import Texts, as_long, slices, texts, words
from lateline.session import stage

RADIUS, WIDTH, SEED = 3, 3, 42
#: Rows that a bucket gets on average, rows above which it is split, and bits added by a split.
BUCKET_ROWS, SPLIT_ROWS, SPLIT_BITS = 256, 2_048, 6
# Multipliers of the 64-bit hash XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_LANES = np.uint64(0x0101010101010101)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(x: np.ndarray) -> np.ndarray:
    return _turned(x * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each byte span. ``data`` goes on for eight bytes behind the last span."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    at, left = starts.astype(np.int64), lengths.astype(np.int64)
    out = np.full(len(at), seed + int(_P5), np.uint64)
    wide = np.flatnonzero(left >= 32)
    if len(wide):
        offsets = [(int(_P1) + int(_P2)), int(_P2), 0, -int(_P1)]
        begin = np.array([(seed + x) & ((1 << 64) - 1) for x in offsets], np.uint64)
        lanes = np.repeat(begin[:, None], len(wide), axis=1)
        place, rest, live = at[wide], left[wide], np.arange(len(wide))
        while len(live):
            for k in range(4):
                lanes[k, live] = _turned(lanes[k, live] + eight[place[live] + 8 * k] * _P2, 31) * _P1
            place[live] += 32
            rest[live] -= 32
            live = live[rest[live] >= 32]
        total = sum(_turned(lanes[k], by) for k, by in enumerate((1, 7, 12, 18)))
        for k in range(4):
            total = (total ^ _round(lanes[k])) * _P1 + _P4
        out[wide] = total
        at, left = at.copy(), left.copy()
        at[wide], left[wide] = place, rest
    out += lengths.astype(np.uint64)
    live = np.flatnonzero(left >= 8)
    while len(live):
        out[live] = _turned(out[live] ^ _round(eight[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        left[live] -= 8
        live = live[left[live] >= 8]
    live = np.flatnonzero(left >= 4)
    out[live] = _turned(out[live] ^ ((eight[at[live]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[live] += 4
    left[live] -= 4
    for _ in range(3):
        live = np.flatnonzero(left > 0)
        out[live] = _turned(out[live] ^ (data[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        left[live] -= 1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    return out ^ (out >> np.uint64(32))


def _shingle_spans(t: Texts, width: int) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with A-Z in lower case and one blank between words; starts, lengths and row edges of the shingles."""
    data = t.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    w = words(t)
    ends = w.starts + w.lengths
    inside = np.zeros(len(data) + 1, np.int8)
    inside[w.starts] += 1
    inside[ends] -= 1
    keep = np.cumsum(inside[:-1]).astype(bool)
    blanks = ends[:-1][w.rows[1:] == w.rows[:-1]] if len(ends) else ends
    data[blanks] = 0x20
    keep[blanks] = True
    new = np.cumsum(keep)
    starts, stops = new[w.starts] - 1, new[ends - 1]
    counts = np.diff(w.edges)
    number = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    edges = np.concatenate([[0], np.cumsum(number)])
    rows = np.repeat(np.arange(len(counts)), number)
    first = w.edges[:-1][rows] + np.arange(len(rows)) - edges[:-1][rows]
    last = first + np.minimum(counts, width)[rows] - 1
    plain = Texts(np.concatenate([data[keep], np.zeros(8, np.uint8)]), np.zeros(1, np.int64))
    return plain, starts[first], stops[last] - starts[first], edges


def _fingerprints(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A bit of a row's fingerprint is 1 if it is set in over half of the row's hashes; a row without hashes has 0.

    Eight counters of a byte are added up at once, over 255 hashes at most.
    """
    counts = np.diff(edges)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    parts = -(-counts[full] // 255)
    part_edges = np.concatenate([[0], np.cumsum(parts)])
    number = np.arange(part_edges[-1]) - np.repeat(part_edges[:-1], parts)
    starts = np.repeat(edges[:-1][full], parts) + 255 * number
    bits = np.empty((len(full), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, starts)
        each = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
        bits[:, k::8] = np.add.reduceat(each, part_edges[:-1], axis=0, dtype=np.int64)
    over = 2 * bits > counts[full][:, None]
    out[full] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (64 bits as a long) of every row."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                plain, starts, lengths, edges = _shingle_spans(texts(part.column("text")), width)
                print_ = _fingerprints(xxh64(plain.data, starts, lengths), edges)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(as_long(print_))], ["doc_id", "fingerprint"])

    return rows.mapInArrow(describe, "doc_id long, fingerprint long")


def _masks(low: int, high: int, flips: int) -> np.ndarray:
    """Words with exactly ``flips`` bits set among the bits ``low`` to ``high`` - 1."""
    if flips > high - low:
        return np.zeros(0, np.uint64)
    return np.array([sum(1 << b for b in picked) for picked in combinations(range(low, high), flips)], np.uint64)


def _distances(odd: bool, radius: int) -> list[int]:
    """Distances at which a fingerprint of this parity emits variants; all variants have odd parity.

    Two fingerprints of a distance d of at most 2 t + 1 have a variant between them, at t and t + 1
    from them at most; for one of the two parities of variants it also is at distances of these lists.
    """
    return [j for j in range((radius | 1) // 2 + 2) if j % 2 == (not odd)]


def _dealt(radius: int, low: int, high: int, top: int):
    """A function that sends fingerprints to the buckets of their variants.

    A bucket is the value of the bits from ``low`` up. The bits from ``high`` up are dealt already: ``top`` is 64
    on the first round and ``high`` later, when the column ``bucket`` holds them.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = (radius | 1) // 2 + 1
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy().view(np.uint64)
            if top == 64:
                base, used = prints, np.zeros(len(prints), np.int64)
            else:
                above = batch.column("bucket").to_numpy().view(np.uint64) << np.uint64(high)
                base = above | (prints & np.uint64((1 << high) - 1))
                used = np.bitwise_count((base ^ prints)).astype(np.int64)
            odd = np.bitwise_count(prints) % 2 == 1
            for flips in range(most + 1):
                masks = _masks(low, high, flips)
                for own in (False, True):
                    row = np.flatnonzero((odd == own) & (used + flips <= max(_distances(own, radius))))
                    for some in np.array_split(row, max(1, len(row) * len(masks) // 500_000)):
                        if len(some) and len(masks):
                            bucket = (base[some][:, None] ^ masks[None, :]) >> np.uint64(low)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(as_long(bucket.ravel())), pa.array(as_long(np.repeat(prints[some], len(masks))))],
                                ["bucket", "fingerprint"])
    return deal


def _met(prints: np.ndarray, bucket: int, low: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (of rows) that connect what collides on a variant in a bucket and is within the radius."""
    base = np.uint64(bucket << low) | (prints & np.uint64((1 << low) - 1))
    used = np.bitwise_count(base ^ prints).astype(np.int64)
    odd = np.bitwise_count(prints) % 2 == 1
    variants, rows, steps = [], [], []
    for own in (False, True):
        for j in _distances(own, radius):
            for flips in range(j + 1):
                at = np.flatnonzero((odd == own) & (used + flips == j))
                masks = _masks(0, low, flips)
                if len(at) and len(masks):
                    variants.append((base[at][:, None] ^ masks[None, :]).ravel())
                    rows.append(np.repeat(at.astype(np.int32), len(masks)))
                    steps.append(np.full(len(at) * len(masks), j, np.int8))
    none = np.zeros(0, np.int64)
    if not variants:
        return none, none
    variant, row, step = (np.concatenate(x) for x in (variants, rows, steps))
    order = np.argsort(variant)
    sorted_ = variant[order]
    same = sorted_[1:] == sorted_[:-1]
    again = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    picked = order[again]
    picked = picked[np.lexsort((row[picked], step[picked], variant[picked]))]
    variant, row = variant[picked], row[picked]
    new = np.concatenate([[True], variant[1:] != variant[:-1]]) if len(variant) else np.zeros(0, bool)
    # All that a variant links goes to the nearest one: what links two of them links both to it.
    hub = row[np.flatnonzero(new)][np.cumsum(new) - 1] if len(variant) else row
    near = (hub != row) & (np.bitwise_count(prints[hub] ^ prints[row]) <= radius)
    edges = np.unique(hub[near].astype(np.int64) * len(prints) + row[near])
    return edges // len(prints), edges % len(prints)


def _meeting(low: int, radius: int):
    """A function that connects the fingerprints of one bucket."""
    def meet(table: pa.Table) -> pa.Table:
        prints = table.column("fingerprint").to_numpy().view(np.uint64)
        bucket = table.column("bucket")[0].as_py() & ((1 << 64) - 1)
        label = least_connected(len(prints), *_met(prints, bucket, low, radius))
        child = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(as_long(prints[label[child]])), "b": pa.array(as_long(prints[child]))})
    return meet


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` that connect all different fingerprints of at most ``radius`` differing bits.

    Two such fingerprints have a word between them that is at most half the radius, rounded up, from each. Every
    fingerprint emits all its variants within that distance, and those that meet on one are
    compared. The shuffle is by the leading bits of the variants, as many as make buckets of
    ``BUCKET_ROWS`` rows: a row there stands for all variants of a fingerprint that share
    them, and the others are made where they meet. A bucket of more than ``SPLIT_ROWS`` rows
    is dealt out again by more bits. With all bits a bucket is one variant, which no more
    fingerprints have than there are words within that distance, so every bucket ends
    bounded without any being cut.
    """
    # One word between two of them can be chosen with odd parity, so half of the variants suffice (``_distances``).
    if radius < 1:
        return prints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    most = (radius | 1) // 2 + 1
    number, bits = prints.count(), 1
    while bits < 40 and number * sum(math.comb(bits, k) for k in range(most + 1)) > 2 * BUCKET_ROWS << bits:
        bits += 1
    low, high = 64 - bits, 64
    rows, found = prints.select("fingerprint"), None
    while True:
        dealt = rows.mapInArrow(_dealt(radius, low, high, high), "bucket long, fingerprint long")
        hot = None
        if low:
            hot = stage(dealt.groupBy("bucket").count().filter(F.col("count") > SPLIT_ROWS).select("bucket"), "hot")
            hot = None if hot.isEmpty() else hot

        calm = dealt if hot is None else dealt.join(hot, "bucket", "left_anti")
        edges = calm.groupBy("bucket").applyInArrow(_meeting(low, radius), "a long, b long")
        found = edges if found is None else found.union(edges)
        if hot is None:
            return found
        rows = stage(dealt.join(hot, "bucket", "left_semi").select("bucket", "fingerprint"), "dealt")
        high, low = low, max(0, low - SPLIT_BITS)


def simhash_components(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """For every row ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    The fingerprint is the majority of the bits of XXH64 (seed 42) over all shingles of ``width``
    words, repeats included; words are what white space (blank, characters 9 to 13) parts, with
    A-Z in lower case. A shorter text is one shingle of all its words; a null text or one
    without words has the fingerprint zero and is linked like any other. Rows are linked if
    their fingerprints differ in at most ``radius`` bits, and ``component_id`` is the smallest
    identifier of all that links connect.

    Equal fingerprints are one from the start, so copies cost nothing more. Memory follows one slice of
    texts and one bucket. Null identifiers never are the smallest; a component of such rows only has
    a null one. An empty table gives an empty result. Only the two named columns are read.
    """
    rows = stage(fingerprints(docs, width, id_column, text_column), "fingerprints")
    prints = stage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    labels = components(links(prints, radius).distinct())
    of = prints.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("label", "fingerprint").alias("component"))
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least, "component").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
