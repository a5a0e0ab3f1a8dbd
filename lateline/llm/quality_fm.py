"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.llm.spans import Texts, slices, span_hashes, texts, words

#: Buckets of hashed words, factors of each feature.
WORD_BUCKETS, FACTORS = 1 << 17, 8
#: Labelled rows of each class that the fit takes at most, by hash over all of them.
SAMPLE_ROWS = 4_000
_UPDATES, _ROWS_A_STEP, _RATE, _DECAY = 600, 128, 0.05, 1e-4
#: Length of the vector of words beside that of the statistics, which is 1.
_WORD_SCALE = 0.3
_STEPS = 24
_KINDS = 12
_FEATURES = WORD_BUCKETS + _KINDS * (_STEPS + 1)
_UPPER, _LOWER, _DIGIT, _MARK, _HIGH = range(1, 6)
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[33:48] = _CLASS[58:65] = _CLASS[91:97] = _CLASS[123:127] = _MARK


@dataclass
class Features:
    """Sparse rows: for row i the features ``index[edges[i]:edges[i + 1]]`` with their values."""

    index: np.ndarray
    value: np.ndarray
    edges: np.ndarray


def features(t: Texts, metadata: np.ndarray | None = None) -> Features:
    """Words of each whole text as hashed counts of fixed length, and a bin of each statistic.

    The statistics: words, mean word length, lines, shares of upper-case letters, digits,
    marks and bytes beyond ASCII, share of different words, share of words that end in
    a mark, share of words of upper-case letters and marks alone, words a line, and the
    metadata number (-1 where missing).
    """
    n, w = len(t), words(t)
    row = w.rows
    hashes = span_hashes(t, w.starts, w.lengths)
    combined, times = np.unique(row.astype(np.int64) << 17 | (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64),
                                return_counts=True)
    of_row, bucket = combined >> 17, combined & (WORD_BUCKETS - 1)
    value = _WORD_SCALE * np.log1p(times)
    value /= np.sqrt(np.maximum(np.bincount(of_row, np.log1p(times) ** 2, n), 1e-12))[of_row]

    size = np.maximum(np.diff(t.edges), 1)
    kind = _CLASS[t.data[:t.size]]

    def per_row(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(hit)])
        return total[t.edges[1:]] - total[t.edges[:-1]]

    count = np.diff(w.edges)
    some = np.maximum(count, 1)
    lines = per_row(t.data[:t.size] == 10) + 1
    lower_before = np.concatenate([[0], np.cumsum((kind == _LOWER) | (kind == _HIGH))])
    ends = w.starts + w.lengths
    shouted = (lower_before[ends] == lower_before[w.starts]) & (w.lengths > 2)
    marked = kind[ends - 1] == _MARK
    different = np.bincount(of_row, minlength=n)
    shares = [per_row(kind == k) / size for k in (_UPPER, _DIGIT, _MARK, _HIGH)]
    shares += [1 - different / some, np.bincount(row, marked, n) / some, np.bincount(row, shouted, n) / some]
    extents = [count, np.bincount(row, w.lengths, n) / some, lines, count / lines]
    bins = [np.minimum(_STEPS * np.sqrt(np.clip(s, 0, 1)), _STEPS) for s in shares]
    bins += [np.minimum(2 * np.log2(1 + x), _STEPS) for x in extents]
    number = np.full(n, -1.0) if metadata is None else metadata
    bins.append(np.where(number < 0, 0, 1 + np.minimum(np.log2(1 + np.maximum(number, 0)), _STEPS - 1)))
    statistic = np.stack([WORD_BUCKETS + k * (_STEPS + 1) + b.astype(np.int64) for k, b in enumerate(bins)], axis=1)

    index = np.concatenate([bucket, statistic.reshape(-1)])
    values = np.concatenate([value, np.full(n * len(bins), 1 / np.sqrt(len(bins)))])
    rows = np.concatenate([of_row, np.repeat(np.arange(n), len(bins))])
    order = np.argsort(rows, kind="stable")
    return Features(index[order], values[order].astype(np.float32),
                    np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]))


@dataclass
class Machine:
    """Bias, weight and factors of each feature."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, x: Features) -> np.ndarray:
        """Half the square of the sum less the sum of the squares gives all pairs in linear time."""
        if len(x.edges) < 2:
            return np.zeros(0)
        part = self.factor[x.index] * x.value[:, None]
        starts = x.edges[:-1]
        sums = np.add.reduceat(part, starts, axis=0)
        squares = np.add.reduceat((part ** 2).sum(axis=1), starts)
        line = np.add.reduceat(self.weight[x.index] * x.value, starts)
        return self.bias + line + 0.5 * ((sums ** 2).sum(axis=1) - squares)

    def probabilities(self, x: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int, float]], seed: int = 7) -> Machine:
    """Weighted logistic loss by adaptive gradient steps over the (index, value, label, weight) rows of the sample."""
    random = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(_FEATURES, np.float32),
                      (random.standard_normal((_FEATURES, FACTORS)) * 0.05).astype(np.float32))
    if not rows:
        return machine
    label = np.array([r[2] for r in rows], np.float64)
    weight = np.array([r[3] for r in rows], np.float64)
    weight /= weight.mean()
    share = float(np.clip((label * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    machine.bias = float(np.log(share / (1 - share)))
    past_weight, past_factor = np.full(_FEATURES, 1e-6, np.float32), np.full((_FEATURES, FACTORS), 1e-6, np.float32)
    past_bias = 1e-6
    steps_a_round = -(-len(rows) // _ROWS_A_STEP)
    for _ in range(-(-_UPDATES // steps_a_round)):
        order = random.permutation(len(rows))
        for a in range(0, len(order), _ROWS_A_STEP):
            chosen = order[a:a + _ROWS_A_STEP]
            sizes = [len(rows[i][0]) for i in chosen]
            x = Features(np.concatenate([rows[i][0] for i in chosen]), np.concatenate([rows[i][1] for i in chosen]),
                         np.concatenate([[0], np.cumsum(sizes)]))
            error = ((machine.probabilities(x) - label[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            of_row = np.repeat(np.arange(len(chosen)), sizes)
            own = machine.factor[x.index]
            sums = np.add.reduceat(own * x.value[:, None], x.edges[:-1], axis=0)
            slope = (error[of_row] * x.value)[:, None] * (sums[of_row] - own * x.value[:, None])
            used, at = np.unique(x.index, return_inverse=True)
            line = np.bincount(at, error[of_row] * x.value).astype(np.float32) + _DECAY * machine.weight[used]
            pairs = np.stack([np.bincount(at, slope[:, k]) for k in range(FACTORS)], axis=1).astype(np.float32)
            pairs += _DECAY * machine.factor[used]
            past_weight[used] += line ** 2
            past_factor[used] += pairs ** 2
            machine.weight[used] -= _RATE * line / np.sqrt(past_weight[used])
            machine.factor[used] -= _RATE * pairs / np.sqrt(past_factor[used])
            past_bias += float(error.sum()) ** 2
            machine.bias -= _RATE * float(error.sum()) / past_bias ** 0.5
    return machine


def _inputs(docs: DataFrame, text_column: str, metadata_column: str | None) -> DataFrame:
    number = F.col(metadata_column).cast("double") if metadata_column in docs.columns else F.lit(None).cast("double")
    return docs.withColumns({"__text": F.col(text_column).cast("string"), "__number": F.coalesce(number, F.lit(-1.0))})


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
          text_column: str = "text", metadata_column: str | None = "n_chars") -> Machine:
    """Fit on a bounded sample of the labelled rows, at most ``SAMPLE_ROWS`` of each class by hash.

    Rows are weighted so that the classes keep their shares. Labels other than 0 and 1 and
    null identifiers are left out. Without labelled rows every score is one half.
    """
    marked = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__label")).filter(
        F.col("__id").isNotNull() & F.col("__label").isin(0, 1))
    counts = {r["__label"]: r["count"] for r in marked.groupBy("__label").count().collect()}
    if not counts:
        return fit([])
    share = (F.xxhash64("__id") / F.lit(float(1 << 63)) + 1) / 2
    rate = {k: min(1.0, SAMPLE_ROWS / n) for k, n in counts.items()}
    sample = marked.filter(F.when(F.col("__label") == 1, share <= rate.get(1, 0.0)).otherwise(share <= rate.get(0, 0.0)))
    found = _inputs(docs, text_column, metadata_column).select(F.col(id_column).alias("__id"), "__text", "__number").join(
        F.broadcast(sample), "__id").select("__text", "__number", "__label")  # 2 x SAMPLE_ROWS rows or so

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                x = features(texts(part.column("__text")), part.column("__number").to_numpy())
                lists = [pa.ListArray.from_arrays(pa.array(x.edges, pa.int32()), pa.array(v))
                         for v in (x.index.astype(np.int32), x.value)]
                yield pa.RecordBatch.from_arrays([*lists, part.column("__label")], ["index", "value", "label"])

    rows = found.mapInArrow(measure, "index array<int>, value array<float>, label int").toArrow().combine_chunks()
    out = []
    for batch in rows.to_batches():
        index, value, label = (batch.column(k) for k in range(3))
        edges = index.offsets.to_numpy()
        flat_index, flat_value = index.values.to_numpy(), value.values.to_numpy()
        for a, b, y in zip(edges, edges[1:], label.to_pylist()):
            out.append((flat_index[a:b].astype(np.int64), flat_value[a:b], y, 1 / rate[y]))
    return fit(sorted(out, key=lambda r: (len(r[0]), r[2], r[0].tobytes(), r[1].tobytes())))


def score(docs: DataFrame, machine: Machine, keep: list[str], text_column: str = "text",
          metadata_column: str | None = "n_chars") -> DataFrame:
    """The ``keep`` columns of every row and its ``score`` (0 to 1): how likely its quality label is 1.

    Every row with its whole text is scored, null text as an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    plain = [f"c{k}" for k in range(len(keep))]  # functions over batches can't take every name
    schema = docs.select(*map(quoted, keep)).toDF(*plain).schema.add("score", "double")

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                x = features(texts(part.column("__text")), part.column("__number").to_numpy())
                columns = [part.column(c) for c in plain] + [pa.array(shared.value.probabilities(x))]
                yield pa.RecordBatch.from_arrays(columns, [*plain, "score"])

    inner = _inputs(docs, text_column, metadata_column).select(
        *[quoted(c).alias(n) for c, n in zip(keep, plain)], "__text", "__number")
    return inner.mapInArrow(rate, schema).toDF(*keep, "score")
