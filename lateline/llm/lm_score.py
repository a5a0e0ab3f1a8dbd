"""Stupid-backoff scores of documents against the corpus they come from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.spans import as_long, mix, slices, span_hashes, texts, words

BACKOFF = 0.4
#: About the bytes of text in a chunk of documents, which is counted and scored as one.
CHUNK_BYTES = 16_000_000


def _word_numbers(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each row, and the edges of the rows. 0 is the start of a text, no word."""
    t = texts(part.column("text"))
    w = words(t)
    return as_long(np.maximum(span_hashes(t, w.starts, w.lengths), np.uint64(1))), w.edges


def _before(numbers: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The word before each; the first word of a row follows 0."""
    before = np.concatenate([[0], numbers[:-1]]) if len(numbers) else numbers.copy()
    before[edges[:-1][np.diff(edges) > 0]] = 0
    return before


def _pairs(numbers: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and second words of the different bigrams of each row, how often, and the edges of the rows."""
    before = _before(numbers, edges)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((numbers, before, row))
    row, before, numbers = row[order], before[order], numbers[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (before[1:] != before[:-1]) | (numbers[1:] != numbers[:-1])
    at = np.flatnonzero(new)
    return before[at], numbers[at], np.diff(at, append=len(row)), np.searchsorted(row[at], np.arange(len(edges)))


def _bigram_keys(before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """72 bits for each bigram: a key, and a mark that is never 0, the mark of single words."""
    before, word = before.view(np.uint64), word.view(np.uint64)
    mark = mix(mix(word) ^ before) % np.uint64(255) + np.uint64(1)
    return mix(mix(before) ^ word), mark.astype(np.uint8)


def _added_up(keys: np.ndarray, marks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys and marks in order, the sum of the counts of each, the rows in this order, and where each begins."""
    order = np.argsort(keys)
    ranked, marked = keys[order], marks[order]
    if ((ranked[1:] == ranked[:-1]) & (marked[1:] != marked[:-1])).any():
        order = np.lexsort((marks, keys))
        marked = marks[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | (marked[1:] != marked[:-1])
    at = np.flatnonzero(new)
    return ranked[new], marked[new], np.add.reduceat(counts[order], at, dtype=counts.dtype) if len(at) else counts, order, at


def _own_counts(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, marks and counts of the words and bigrams of a chunk, in order. Word 0 counts the rows that have words."""
    found = ([np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int32)])
    for batch in chunk.to_batches():
        for part in slices(batch, "text"):
            numbers, edges = _word_numbers(part)
            keys, marks = _bigram_keys(_before(numbers, edges), numbers)
            single = np.concatenate([np.zeros((np.diff(edges) > 0).sum(), np.uint64), numbers.view(np.uint64)])
            every = np.concatenate([single, keys])
            added = _added_up(every, np.concatenate([np.zeros(len(single), np.uint8), marks]), np.ones(len(every), np.int32))
            for lists, x in zip(found, added):
                lists.append(x)
    for lists in found:  # one array each from here on
        lists[:] = [np.concatenate(lists)]
    return _added_up(*(x for x, in found))[:3]


def _counts_by_part(chunk: pa.Table, parts: int) -> pa.Table:
    """The counts of a chunk, cut into ranges of keys."""
    keys, marks, counts = _own_counts(chunk)
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    used, starts = np.unique(part, return_index=True)
    offsets = pa.array(np.append(starts, len(keys)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (as_long(keys), marks.view(np.int8), counts)]
    number = chunk.column("chunk")[0].as_py()
    return pa.Table.from_arrays([pa.array(np.full(len(used), number), pa.int32()), pa.array(used), *lists],
                                ["chunk", "part", "keys", "marks", "counts"])


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    """The elements of a column of arrays, one after another."""
    return np.concatenate([np.zeros(0, column.type.value_type.to_pandas_dtype())] + [
        x.flatten().to_numpy() for x in column.chunks])


def _everywhere(counts: pa.Table) -> pa.Table:
    """For a range of keys from all chunks, how often each occurs in all of them."""
    keys, marks = _flat(counts.column("keys")).view(np.uint64), _flat(counts.column("marks")).view(np.uint8)
    _, _, sums, order, at = _added_up(keys, marks, _flat(counts.column("counts")).astype(np.int64))
    everywhere = np.empty(len(keys), np.int64)
    everywhere[order] = np.repeat(sums, np.diff(at, append=len(keys)))
    lengths = np.concatenate([x.value_lengths().to_numpy() for x in counts.column("keys").chunks])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(everywhere))
    return pa.Table.from_arrays([counts.column("chunk"), counts.column("part"), lists], ["chunk", "part", "everywhere"])


def _chunk_scores(chunk: pa.Table, totals: pa.Table) -> pa.Table:
    """Words, seen bigrams and the sum of each row of a chunk, without the share of all words that backing off takes."""
    keys, marks, _ = _own_counts(chunk)
    everywhere = _flat(totals.sort_by("part").column("everywhere"))
    if len(everywhere) != len(keys):
        raise RuntimeError("the documents of a chunk have changed while they were counted")

    def count_of(key: np.ndarray, mark: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, key)
        while (other := marks[at] != mark).any():  # equal keys follow each other by their marks
            at[other] += 1
        return everywhere[at]

    out = []
    for batch in chunk.to_batches():
        for part in slices(batch, "text"):
            numbers, edges = _word_numbers(part)
            before, word, own, starts = _pairs(numbers, edges)
            others = count_of(*_bigram_keys(before, word)) - own
            known = others > 0
            count = count_of(np.where(known, before, word).view(np.uint64), np.zeros(len(word), np.uint8))
            step = np.log(np.where(known, others / count, count))
            rows = len(edges) - 1
            row = np.repeat(np.arange(rows), np.diff(starts))
            seen = np.bincount(row, own * known, rows).astype(np.int64)
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(edges)), pa.array(seen), pa.array(np.bincount(row, own * step, rows).astype(float))],
                ["doc_id", "words", "seen", "sum"]))
    return pa.Table.from_batches(out)


def number_of_words(texts_: DataFrame) -> DataFrame:
    """One row: the ``total`` number of words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array([len(words(texts(part.column("text"))).starts)])], ["total"])

    return texts_.mapInArrow(count, "total long").agg(F.sum("total").alias("total"))


def lm_scores(docs: DataFrame, backoff: float = BACKOFF, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every row: ``words``, ``seen`` (of its bigrams, in other documents) and ``score``.

    The corpus of counts is the table itself, without the document in question: a bigram
    scores log(c(u w) / c(u)) where c(u w) counts other documents, and where no other has it,
    log(backoff x c(w) / all words). The score is the mean over the words. c(u) and
    c(w) count all documents, so neither is 0.

    Documents are dealt out to chunks of about ``CHUNK_BYTES``, the rows of each input partition by their hash. A chunk
    adds up its words and bigrams, so what is frequent is a number for each chunk, and deals them out as ranges of keys;
    each range is added up over all chunks, and the sums go back to the chunks in the same order, without their keys. The
    chunk then scores its documents. The texts and the counts move once, the sums once; nothing is a row for each bigram.
    Words are told apart by 64 bits, bigrams by 72.

    Words are in lower case. A text without words, null or empty, has 0 words and a null score.
    Rows repeated with identifier and text are other documents to each other, with equal scores. An empty table gives an empty result.
    """
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    number = -(-size // CHUNK_BYTES) or 1
    text = F.coalesce(F.col(text_column), F.lit(""))
    # Equal rows of different input partitions are kept apart by the number of theirs.
    place = F.pmod(F.xxhash64(id_column, text_column, F.spark_partition_id()), F.lit(number)).cast("int")
    chunks = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.lower(text).alias("text"), place.alias("chunk"))
    counts = chunks.groupBy("chunk").applyInArrow(
        lambda chunk: _counts_by_part(chunk, number),
        "chunk int, part int, keys array<long>, marks array<tinyint>, counts array<int>")
    totals = counts.groupBy("part").applyInArrow(_everywhere, "chunk int, part int, everywhere array<long>")
    scores = chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(
        _chunk_scores, "doc_id long, words long, seen long, sum double")
    total = number_of_words(docs.select(text.alias("text")))
    # The sum takes log(backoff x c(w)) for each word that backs off; the logarithm of all words is the same for each.
    backed_off = F.col("words") - F.col("seen")
    return scores.crossJoin(F.broadcast(total)).select(
        F.col("doc_id").alias(id_column), "words", "seen",
        F.when(F.col("words") > 0, (F.col("sum") + backed_off * F.log(F.lit(backoff) / F.col("total"))) / F.col("words")).alias("score"))
