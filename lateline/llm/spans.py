"""Text columns of Arrow batches as byte arrays; words, their hashes and their shingles.

Everything works on whole batches with numpy. Memory follows the bytes of one
slice of a batch (``slices``), never the size of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
#: The white space that separates words: blank and the control characters 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_GOLDEN, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass
class Texts:
    """Concatenated UTF-8 of some rows, padded by eight zero bytes; row i is ``data[edges[i]:edges[i + 1]]``."""

    data: np.ndarray
    edges: np.ndarray

    def __len__(self) -> int:
        return len(self.edges) - 1

    @property
    def size(self) -> int:
        return int(self.edges[-1])


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """Bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.zeros(int(edges[-1] - edges[0]) + 8, np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(column.buffers()[2], np.uint8)[edges[0]:edges[-1]]
    return Texts(data, edges - edges[0])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def mix_one(x: int) -> int:
    return int(mix(np.array([x & (1 << 64) - 1], np.uint64))[0])


@dataclass
class Words:
    """Words of some rows: byte spans, and for row i the words ``edges[i]`` to ``edges[i + 1]``."""

    starts: np.ndarray
    lengths: np.ndarray
    edges: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))


def words(t: Texts) -> Words:
    """Longest runs without white space; no word reaches over the end of a row."""
    solid = ~_SPACE[t.data[:t.size]]
    apart = np.zeros(t.size + 1, bool)
    apart[t.edges] = True
    before = np.empty(t.size, bool)
    before[:1], before[1:] = False, solid[:-1]
    after = np.empty(t.size, bool)
    after[-1:], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & (~before | apart[:-1]))
    ends = np.flatnonzero(solid & (~after | apart[1:])) + 1
    return Words(starts, ends - starts, np.searchsorted(starts, t.edges))


def span_hashes(t: Texts, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    eight = np.ndarray((len(t.data) - 7,), "<u8", t.data, strides=(1,))
    out = mix(lengths.astype(np.uint64) ^ np.uint64(seed))
    live, at, left = np.arange(len(starts)), starts, lengths
    while len(live):
        out[live] = mix(out[live] ^ (eight[at] & _LOW_BYTES[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


def shingles(hashes: np.ndarray, edges: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` neighbouring words, and their edges by row.

    A row of fewer words has one shingle of all its words; a row without words has none.
    """
    counts = np.diff(edges)
    number = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_edges = np.concatenate([[0], np.cumsum(number)])
    rows = np.repeat(np.arange(len(counts)), number)
    first = edges[:-1][rows] + np.arange(len(rows)) - out_edges[:-1][rows]
    span = np.minimum(counts, width)[rows]
    out = mix(span.astype(np.uint64))
    for k in range(width):
        inside = span > k
        out[inside] = mix(out[inside] ^ hashes[first[inside] + k])
    return out, out_edges


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
