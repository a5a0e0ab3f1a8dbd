"""Token ids of whole texts, with words seen before taken from a table."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from lateline.llm.spans import Texts, span_hashes

#: Bytes of the table of units that one worker remembers; beyond, it keeps those of the batch at hand only.
#: Growing it holds the old and the new table for a moment.
REMEMBERED_BYTES = 24_000_000
#: Bytes of one unit in the table without its ids, and of an id.
_UNIT_BYTES, _ID_BYTES = 32, 4
_JOINED_BYTES = 100_000


class Encoder:
    """Byte-level BPE of a ``tokenizers`` file, the same ids as its ``encode`` of each whole text.

    Its splitting never joins a character that is not white space with white space after
    it. A text can therefore be cut before each blank or line feed that follows such a
    character; the units between the cuts repeat a lot, and each new one is encoded once.
    Two 64-bit hashes tell units apart. Batches with added tokens in their texts, such as an end
    of text, are encoded text by text, because those tokens are cut out before any splitting.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [x.content.encode() for x in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab()
        self._width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self._width[number] = len(token)  # one character of the file's alphabet is one byte
        self._forget()

    def _forget(self) -> None:
        self._hash, self._check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._start, self._count, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __call__(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the edges of the rows."""
        if self._has_added(t.data[:t.size].tobytes()):
            return self._plainly(t)
        starts, lengths, row_edges = _units(t)
        hashes, checks = span_hashes(t, starts, lengths), span_hashes(t, starts, lengths, 1)
        unique, first, inverse = _distinct(hashes)
        at = np.minimum(np.searchsorted(self._hash, unique), max(len(self._hash) - 1, 0))
        known = self._hash[at] == unique if len(self._hash) else np.zeros(len(unique), bool)
        if not known.all():
            self._learn(t, unique[~known], checks[first[~known]], starts[first[~known]], lengths[first[~known]])
            at = np.searchsorted(self._hash, unique)
        if not np.array_equal(self._check[at][inverse], checks):
            return self._plainly(t)
        count = self._count[at][inverse]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._ids[np.repeat(self._start[at][inverse] - ends + count, count) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[row_edges]

    def _has_added(self, data: bytes) -> bool:
        return any(token in data for token in self._added)

    def _learn(self, t: Texts, hashes, checks, starts, lengths) -> None:
        if _UNIT_BYTES * (len(self._hash) + len(hashes)) + _ID_BYTES * len(self._ids) > REMEMBERED_BYTES:
            self._trim(t)
        count = np.zeros(len(hashes), np.int64)
        found: list[np.ndarray] = []
        order: list[np.ndarray] = []
        ends = starts + lengths
        led = (t.data[starts] == 0x20) | (t.data[starts] == 0x0A)
        joinable = led & _solid(t.data, ends - 1)
        batch = np.flatnonzero(joinable)
        parts = np.cumsum(lengths[batch]) // _JOINED_BYTES
        for part in np.split(batch, np.flatnonzero(np.diff(parts)) + 1) if len(batch) else []:
            span, edges = lengths[part], np.cumsum(lengths[part])
            where = np.repeat(starts[part] - edges + span, span) + np.arange(edges[-1])
            text = t.data[where].tobytes()
            if self._has_added(text):  # only the joining made it
                joinable[part] = False
                continue
            ids = self._ids_of([text.decode("utf-8", "surrogateescape")])[0]
            token_ends = np.cumsum(self._width[ids])
            cut = np.searchsorted(token_ends, edges) + 1
            if not np.array_equal(token_ends[cut - 1], edges):
                raise ValueError("a token reaches over the end of a unit; this file is not a byte-level BPE")
            count[part] = np.diff(cut, prepend=0)
            found.append(ids)
            order.append(part)
        rest = np.flatnonzero(~joinable)
        alone = [t.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[rest], ends[rest])]
        for k, ids in zip(rest, self._ids_of(alone)):
            count[k] = len(ids)
            found.append(ids)
            order.append(np.array([k]))
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        sequence = np.concatenate(order) if order else np.zeros(0, np.int64)
        start = np.zeros(len(hashes), np.int64)
        start[sequence] = np.cumsum(count[sequence]) - count[sequence] + len(self._ids)
        self._ids = np.concatenate([self._ids, ids])
        every = np.concatenate([self._hash, hashes])
        rank = np.argsort(every, kind="stable")
        self._hash = every[rank]
        del every
        self._check = np.concatenate([self._check, checks])[rank]
        self._start = np.concatenate([self._start, start])[rank]
        self._count = np.concatenate([self._count, count])[rank]

    def _trim(self, t: Texts) -> None:
        """Forget all but the units of the batch at hand."""
        starts, lengths, _ = _units(t)
        wanted = np.isin(self._hash, span_hashes(t, starts, lengths))
        count = self._count[wanted]
        start = np.cumsum(count) - count
        ids = self._ids[np.repeat(self._start[wanted] - start, count) + np.arange(int(count.sum()))]
        self._hash, self._check, self._start, self._count, self._ids = (
            self._hash[wanted], self._check[wanted], start, count, ids)

    def _ids_of(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _plainly(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids_of([t.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(t.edges, t.edges[1:])])
        edges = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), edges


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that is surely not white space ends at these bytes."""
    byte, before = data[at], data[np.maximum(at - 1, 0)]
    return (byte > 0x20) & (byte < 0x7F) | (byte >= 0x80) & (before == 0xC3)


def _units(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the units, and the edges of the rows in them."""
    data = t.data[:t.size]
    blank = np.flatnonzero((data == 0x20) | (data == 0x0A))
    blank = blank[blank > 0]
    begins = np.zeros(t.size, bool)
    begins[blank[_solid(t.data, blank - 1)]] = True
    begins[t.edges[:-1][np.diff(t.edges) > 0]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(starts, append=t.size)
    return starts, lengths, np.searchsorted(starts, t.edges)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values in order, a place of each, and the number of each value's among them.

    Which of the equal places is open, so the sort need not be stable as in ``np.unique``, which takes most of an encoding.
    """
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[new], order[new], inverse


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker; its table stays within ``REMEMBERED_BYTES``, so later tasks may keep it."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, edges: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Put an end id behind each row."""
    out = np.insert(ids, edges[1:], np.uint32(end))
    return out, edges + np.arange(len(edges))
