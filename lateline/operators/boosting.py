"""Second-order gradient boosting on histograms, grown level by level or best leaf first."""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.session import kept, stage
from lateline.shipping import ship

BLOCK_ROWS, MAX_BINS = 8_192, 255
#: Rows whose quantiles are the bins of values that are many, at most about so many.
SAMPLED_ROWS = 100_000
#: Histogram cells that one pass counts, and trees after which the margins are written.
PASS_CELLS, WRITTEN_EVERY = 2_000_000, 25
#: Values (rows by features) up to which one task grows all trees, with no job a round. Trees are the same.
ONE_TASK_VALUES = 8_000_000
_BLOCK = "block long, rows int, held boolean, codes binary, label binary, weight binary, margin binary"
_EPS = 1e-6


@dataclass
class Settings:
    """Parameters of a fit; ``growth`` is ``level`` (to ``max_depth``) or ``leaf`` (to ``num_leaves``, best first)."""

    n_estimators: int = 100
    learning_rate: float = 0.3
    growth: str = "level"
    max_depth: int = 6
    num_leaves: int = 31
    min_child_weight: float = 1.0
    min_child_samples: int = 1
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    subsample: float = 1.0
    subsample_freq: int = 1
    colsample_bytree: float = 1.0
    max_bins: int = MAX_BINS
    patience: int = 10
    seed: int = 42

    def __post_init__(self) -> None:
        if self.growth not in ("level", "leaf"):
            raise ValueError(f"unknown growth {self.growth!r}")
        if not 2 <= self.max_bins <= MAX_BINS:
            raise ValueError(f"max_bins must be from 2 to {MAX_BINS}")
        if min(self.n_estimators, self.num_leaves, self.patience, self.min_child_samples) < 1 or self.max_depth < 0:
            raise ValueError("counts of trees, leaves, rounds and rows must be positive")
        if not (0 < self.subsample <= 1 and 0 < self.colsample_bytree <= 1):
            raise ValueError("shares of rows and columns must be above 0 and at most 1")
        if min(self.gamma, self.reg_lambda, self.reg_alpha, self.min_child_weight) < 0:
            raise ValueError("penalties must not be negative")


@dataclass
class Node:
    """A node while its tree grows: sums of gradients, hessians and rows, and its best split."""

    depth: int
    sums: tuple[float, float, float]
    gain: float = -math.inf
    feature: int = -1
    bin: int = -1
    children: tuple[int, int] | None = None
    cells: np.ndarray | None = None


def _shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0) if alpha else g


def leaf_weight(g: float, h: float, reg_lambda: float, reg_alpha: float) -> float:
    """The weight that minimises g w + (h + lambda) w^2 / 2 + alpha |w|."""
    return float(-_shrunk(g, reg_alpha) / (h + reg_lambda)) if h + reg_lambda > 0 else 0.0


def best_split(cells: np.ndarray, columns: np.ndarray, settings: Settings) -> tuple[float, int, int]:
    """Gain, feature and bin of the best split of a node; of equal ones the first feature and bin.

    ``cells`` has gradients, hessians and rows by column and bin; rows up to the bin go left.
    """
    left = cells.cumsum(axis=1)
    whole = left[:, -1:, :]
    right = whole - left

    def score(sums: np.ndarray) -> np.ndarray:
        below = sums[..., 1] + settings.reg_lambda
        if settings.reg_lambda > 0:
            return _shrunk(sums[..., 0], settings.reg_alpha) ** 2 / below
        return np.divide(_shrunk(sums[..., 0], settings.reg_alpha) ** 2, below, out=np.zeros_like(below), where=below > 0)

    gain = score(left) + score(right) - score(whole)
    fit = np.ones(gain.shape, bool)
    for side in (left, right):
        fit &= (side[..., 2] >= settings.min_child_samples) & (side[..., 1] >= settings.min_child_weight)
    gain = np.where(fit & (gain > _EPS) & (gain >= settings.gamma), gain, -np.inf)
    at = int(np.argmax(gain))
    column, bin_ = divmod(at, cells.shape[1])
    return float(gain[column, bin_]), int(columns[column]), bin_


def _best_of_groups(cells: np.ndarray, columns: np.ndarray, settings: Settings, sizes: np.ndarray) -> tuple[float, int, int]:
    """``best_split`` of columns by their number of bins, as most columns fill few of the cells."""
    best, low = (-math.inf, int(columns[0]), 0), 0
    _, h, n = cells[0].sum(axis=0)
    if n < 2 * settings.min_child_samples or h < 2 * settings.min_child_weight:
        return best
    for top in (4, 32, MAX_BINS + 1):
        own = np.flatnonzero((sizes[columns] > low) & (sizes[columns] <= top))
        low = top
        if len(own):
            found = best_split(cells[own, :min(top, cells.shape[1])], columns[own], settings)
            if found[0] > best[0] or (found[0] == best[0] and found[1] < best[1]):
                best = found
    return best


def _select(nodes: list[Node], settings: Settings) -> tuple[list[int], list[int]]:
    """Nodes to split as far as is known, and those of them whose children's best splits must be found to go on."""
    chosen, unknown = [], []
    if settings.growth == "level":
        front = [0]
        while front:
            at = front.pop()
            if nodes[at].gain > 0:
                chosen.append(at)
                if nodes[at].children is not None:
                    front += nodes[at].children
                else:
                    unknown.append(at)
        return chosen, [k for k in unknown if nodes[k].depth + 1 < settings.max_depth]
    queue, leaves, open_ = [(-nodes[0].gain, 0)], 1, False
    while queue and leaves < settings.num_leaves:
        gain, at = heapq.heappop(queue)
        if gain >= 0 or math.isinf(gain):
            break
        chosen.append(at)
        leaves += 1
        if nodes[at].children is None:
            if leaves < settings.num_leaves and nodes[at].depth + 1 < settings.max_depth:
                unknown.append(at)
                open_ = True
        else:
            for child in nodes[at].children:
                heapq.heappush(queue, (-nodes[child].gain, child))
    return chosen, unknown if open_ else []


@dataclass
class Tree:
    """Arrays by node; ``feature`` is -1 for leaves. Rows of at most the threshold go left."""

    feature: list[int]
    bin: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    gain: list[float]
    rows: list[float]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.left, np.int32),
                np.array(self.right, np.int32), np.array(self.value))


def _routed(arrays: tuple[np.ndarray, ...], codes: np.ndarray) -> np.ndarray:
    """Node of each row, as far down as the arrays go."""
    feature, bins, left, right = arrays[:4]
    node = np.zeros(len(codes), np.int32)
    live = np.flatnonzero(feature[node] >= 0)
    while len(live):
        at = node[live]
        low = codes[live, feature[at]] <= bins[at]
        node[live] = np.where(low, left[at], right[at])
        live = live[feature[node[live]] >= 0]
    return node


def _finished(nodes: list[Node], chosen: set[int], cuts: list[list[float]], settings: Settings) -> Tree:
    tree = Tree([], [], [], [], [], [], [], [])
    order = [0]
    for at in order:
        if at in chosen:
            order += nodes[at].children
    place = {at: k for k, at in enumerate(order)}
    for at in order:
        node, inner = nodes[at], at in chosen
        tree.feature.append(node.feature if inner else -1)
        tree.bin.append(node.bin if inner else -1)
        tree.threshold.append(float(cuts[node.feature][node.bin]) if inner else 0.0)
        tree.left.append(place[node.children[0]] if inner else -1)
        tree.right.append(place[node.children[1]] if inner else -1)
        tree.value.append(0.0 if inner else settings.learning_rate * leaf_weight(
            node.sums[0], node.sums[1], settings.reg_lambda, settings.reg_alpha))
        tree.gain.append(node.gain if inner else 0.0)
        tree.rows.append(node.sums[2])
    return tree


def _few_values(rows: DataFrame, width: int, limit: int) -> dict[int, list[float]]:
    """All values, ascending, of each place of ``x`` that has at most ``limit`` different ones.

    A task holds at most ``limit`` values of a place, and gives up those that have more.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, many = [np.zeros(0)] * width, np.zeros(width, bool)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for k in np.flatnonzero(~many):
                values, known = x[:, k], seen[k]
                if len(known):
                    values = values[known[np.minimum(np.searchsorted(known, values), len(known) - 1)] != values]
                if len(values):
                    seen[k] = np.unique(np.append(known, values)) + 0.0
                    many[k] = len(seen[k]) > limit
        for k in range(width):
            values = [None] if many[k] else seen[k].tolist()
            yield pa.RecordBatch.from_pydict({"k": pa.array([k] * len(values), pa.int64()), "value": pa.array(values, pa.float64())})

    known = rows.select("x").mapInArrow(find, "k long, value double").distinct().groupBy("k").agg(
        F.sort_array(F.collect_list("value")).alias("values"), F.bool_or(F.col("value").isNull()).alias("many"))
    return {r["k"]: r["values"] for r in known.filter(~F.col("many") & (F.size("values") <= limit)).collect()}


def bin_cuts(rows: DataFrame, width: int, max_bins: int = MAX_BINS, number: int | None = None) -> list[list[float]]:
    """Upper edges of the bins of each value of ``x``: all its values if they are few, else quantiles.

    Few values are told and gathered over all rows. Quantiles are those of a sample of about ``SAMPLED_ROWS``
    rows, all rows if there are no more.
    """
    exact = _few_values(rows, width, int(0.8 * max_bins))
    out: list[list[float]] = [exact[k][:-1] if k in exact else [] for k in range(width)]
    rest = [k for k in range(width) if k not in exact]
    if rest:
        share = SAMPLED_ROWS / max(rows.count() if number is None else number, 1)
        drawn = rows if share >= 1 else rows.sample(share, seed=42)
        values = drawn.select(F.array(*[F.col("x")[k] for k in rest]).alias("x")).toArrow().column("x").combine_chunks()
        matrix = np.sort(values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(rest)), axis=0)
        at = np.maximum(np.ceil(np.arange(1, max_bins) * len(matrix) / max_bins).astype(int) - 1, 0)
        for j, k in enumerate(rest):
            out[k] = np.unique(matrix[at, j]).tolist() if len(matrix) else []
    return out


def _blocks(rows: DataFrame, cuts: list[list[float]], start: float) -> DataFrame:
    """The rows as binned blocks: a byte for each value, next to labels, weights and margins."""
    edges = [np.array(c, float) for c in cuts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                codes = np.stack([np.searchsorted(e, x[:, k], side="left").astype(np.uint8) for k, e in enumerate(edges)], axis=1)
                held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
                for own in (False, True):
                    at = np.flatnonzero(held == own)
                    if len(at):
                        label, weight = (part.column(c).to_numpy(zero_copy_only=False)[at] for c in ("label", "weight"))
                        yield pa.RecordBatch.from_pydict({
                            "block": pa.array([number]), "rows": pa.array([len(at)], pa.int32()), "held": [own],
                            "codes": [codes[at].tobytes()], "label": [label.astype(np.uint8).tobytes()],
                            "weight": [weight.astype(float).tobytes()], "margin": [np.full(len(at), start).tobytes()]})
                        number += 1

    return stage(rows.mapInArrow(pack, _BLOCK), "blocks")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    for row in batch.to_pylist():
        n = row["rows"]
        yield (row["block"], row["held"], np.frombuffer(row["codes"], np.uint8).reshape(n, -1),
               np.frombuffer(row["label"], np.uint8).astype(float), np.frombuffer(row["weight"]), np.frombuffer(row["margin"]))


def _added(tree: Tree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Margins after one more tree."""
    arrays = tree.arrays()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [(margin + arrays[4][_routed(arrays, codes)]).tobytes() for *_, codes, _, _, margin in _unpacked(batch)]
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margins, pa.binary()))
    return add


def _counted(blocks: DataFrame, arrays: tuple[np.ndarray, ...], wanted: list[int], columns: np.ndarray, bins: int,
             settings: Settings, draw: int, scale: float, with_loss: bool) -> tuple[np.ndarray, float]:
    """Gradients, hessians and rows by wanted leaf, column and bin, and the loss of the held-out rows.

    A task adds up its blocks, Spark adds up by (leaf, feature, bin), and the driver gets one row for each
    cell that has rows. Gradients are rounded to whole multiples of 1 / scale, so sums don't depend on their order.
    """
    slot = np.full(len(arrays[0]), -1, np.int64)
    slot[wanted] = np.arange(len(wanted))
    size, width = len(wanted) * len(columns) * bins, len(columns)
    offsets = np.arange(width) * bins

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, loss, tested = np.zeros((3, size)), 0.0, 0.0
        for batch in batches:
            for block, held, codes, label, weight, margin in _unpacked(batch):
                if held:
                    if with_loss:
                        loss += np.rint((np.logaddexp(0, margin) - label * margin) * weight * scale).sum()
                        tested += weight.sum()
                    continue
                at = slot[_routed(arrays, codes)]
                take = at >= 0
                if settings.subsample < 1 and settings.subsample_freq:
                    take &= np.random.default_rng([settings.seed, draw, block]).random(len(at)) < settings.subsample
                own = np.flatnonzero(take)
                p = 1 / (1 + np.exp(-margin[own]))
                g = np.rint((p - label[own]) * weight[own] * scale)
                h = np.rint(np.maximum(p * (1 - p), 1e-16) * weight[own] * scale)
                cell = ((at[own] * (width * bins))[:, None] + offsets + codes[own][:, columns]).ravel()
                for k, values in enumerate((g, h, None)):
                    sums[k] += np.bincount(cell, None if values is None else np.repeat(values, width), size)
        cell = np.flatnonzero(sums[2])
        leaf, rest = np.divmod(cell, width * bins)
        feature, bin_ = np.divmod(rest, bins)
        out = [np.append(x, -1) for x in (leaf, feature, bin_)] + [np.append(sums[0][cell], loss), np.append(
            sums[1][cell], tested), np.append(sums[2][cell], 0.0)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["leaf", "feature", "bin", "g", "h", "n"])

    table = blocks.mapInArrow(count, "leaf long, feature long, bin long, g double, h double, n double").groupBy(
        "leaf", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
    leaf, feature, bin_ = (table.column(c).to_numpy() for c in ("leaf", "feature", "bin"))
    values = np.stack([table.column(c).to_numpy() for c in "ghn"], axis=1) / np.array([scale, scale, 1.0])
    inside = leaf >= 0
    cells = np.zeros((len(wanted), width, bins, 3))
    cells[leaf[inside], feature[inside], bin_[inside]] = values[inside]
    total = values[~inside].sum(axis=0) if (~inside).any() else np.zeros(3)
    return cells, float(total[0] / (total[1] * scale)) if total[1] else math.nan


class _Grower:
    """Grows one tree after the other on blocks whose margins it carries along."""

    def __init__(self, blocks: DataFrame, cuts: list[list[float]], settings: Settings, scale: float) -> None:
        self.blocks, self.cuts, self.settings, self.scale = blocks, cuts, settings, scale
        self.first, self._old = blocks, None
        self.sizes = np.array([len(c) + 1 for c in cuts])
        self.bins = int(self.sizes.max(initial=1))
        self.loss = math.nan

    def _cells(self, nodes: list[Node], wanted: list[int], columns: np.ndarray, draw: int, first: bool) -> Sequence[np.ndarray]:
        arrays = (np.array([n.feature if n.children else -1 for n in nodes], np.int32), np.array([n.bin for n in nodes], np.int32),
                  np.array([n.children[0] if n.children else -1 for n in nodes], np.int32),
                  np.array([n.children[1] if n.children else -1 for n in nodes], np.int32))
        at_once = max(1, PASS_CELLS // (len(columns) * self.bins))
        parts = []
        for a in range(0, len(wanted), at_once):
            part, loss = _counted(self.blocks, arrays, wanted[a:a + at_once], columns, self.bins, self.settings, draw,
                                  self.scale, first)
            parts.append(part)
            if first:
                self.loss = loss
        return np.concatenate(parts)

    def grow(self, number: int) -> Tree:
        """The tree after ``number`` others. ``loss`` then is that of the held-out rows before it."""
        s, width = self.settings, len(self.cuts)
        columns = np.arange(width)
        if s.colsample_bytree < 1:
            picked = np.random.default_rng([s.seed, number]).permutation(width)[:max(1, int(s.colsample_bytree * width))]
            columns = np.sort(picked)
        draw = number // s.subsample_freq if s.subsample_freq else 0
        root = self._cells([Node(0, (0.0, 0.0, 0.0))], [0], columns, draw, True)[0]
        nodes = [Node(0, tuple(root[0].sum(axis=0)), cells=root)]
        if s.max_depth:
            nodes[0].gain, nodes[0].feature, nodes[0].bin = _best_of_groups(root, columns, s, self.sizes)
        while True:
            chosen, unknown = _select(nodes, s)
            if not unknown:
                break
            counted, pairs = [], []
            for at in unknown:
                few, many = self._split(nodes, at, columns)
                counted.append(few)
                pairs.append((at, few, many))
            cells = self._cells(nodes, counted, columns, draw, False)
            for (at, few, many), own in zip(pairs, cells):
                # The larger child is what the smaller one leaves of the parent.
                nodes[few].cells, nodes[many].cells = own, nodes[at].cells - own
                nodes[at].cells = None
                for child in (few, many):
                    node = nodes[child]
                    if node.depth < s.max_depth:
                        node.gain, node.feature, node.bin = _best_of_groups(node.cells, columns, s, self.sizes)
        for at in chosen:
            if nodes[at].children is None:
                self._split(nodes, at, columns)
        return _finished(nodes, set(chosen), self.cuts, s)

    def _split(self, nodes: list[Node], at: int, columns: np.ndarray) -> tuple[int, int]:
        """Give a node its children; the one of fewer rows first."""
        node = nodes[at]
        column = int(np.searchsorted(columns, node.feature))
        left = node.cells[column, :node.bin + 1].sum(axis=0)
        right = np.array(node.sums) - left
        node.children = (len(nodes), len(nodes) + 1)
        nodes += [Node(node.depth + 1, tuple(left)), Node(node.depth + 1, tuple(right))]
        return node.children if left[2] <= right[2] else node.children[::-1]

    def forget(self) -> None:
        """Drop the blocks that were kept before the last ones."""
        if self._old is not None and self._old is not self.first:
            self._old.unpersist()
        self._old = None

    def last_loss(self) -> float:
        """Loss of the held-out rows after all trees."""
        return _counted(self.blocks, (np.array([-1], np.int32),) * 4, [], np.arange(0), 1, self.settings, 0, self.scale, True)[1]

    def advance(self, tree: Tree, number: int) -> None:
        before = self.blocks
        after = before.mapInArrow(_added(tree), _BLOCK)
        if (number + 1) % WRITTEN_EVERY == 0:
            after = stage(after, "margins")
        self.blocks = after.persist()
        self._old = before


class _OneTask(_Grower):
    """Grows the same trees within one process: rows are kept by node, and only a split node's are looked at."""

    def __init__(self, blocks: list[tuple], cuts: list[list[float]], settings: Settings, scale: float) -> None:
        super().__init__(None, cuts, settings, scale)
        # The order of blocks is not that in which they were written; sums don't depend on it, as they are exact.
        self.train, held = ([b for b in blocks if b[1] == own] for own in (False, True))
        self.codes, self.label, self.weight, self.margin = self._joined(self.train)
        self.held_codes, self.held_label, self.held_weight, self.held_margin = self._joined(held)

    def _joined(self, blocks: list[tuple]) -> tuple[np.ndarray, ...]:
        if not blocks:
            return np.zeros((0, len(self.cuts)), np.uint8), np.zeros(0), np.zeros(0), np.zeros(0)
        return tuple(np.concatenate([b[k] for b in blocks]) for k in (2, 3, 4, 5))

    def last_loss(self) -> float:
        if not self.held_weight.sum():
            return math.nan
        loss = np.rint((np.logaddexp(0, self.held_margin) - self.held_label * self.held_margin) * self.held_weight * self.scale).sum()
        return float(loss / (self.held_weight.sum() * self.scale))

    def _start(self, columns: np.ndarray, draw: int) -> None:
        s, own = self.settings, np.arange(len(self.label))
        if s.subsample < 1 and s.subsample_freq:
            own = np.flatnonzero(np.concatenate([np.random.default_rng([s.seed, draw, b[0]]).random(len(b[3])) < s.subsample
                                                 for b in self.train]))
        p = 1 / (1 + np.exp(-self.margin[own]))
        self.g = np.rint((p - self.label[own]) * self.weight[own] * self.scale)
        self.h = np.rint(np.maximum(p * (1 - p), 1e-16) * self.weight[own] * self.scale)
        self.drawn = self.codes[own]
        self.cell = self.drawn[:, columns] + np.arange(len(columns)) * self.bins
        self.rows = {0: np.arange(len(own))}
        self.loss = self.last_loss()

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        width = self.cell.shape[1]
        sums = np.zeros((3, width * self.bins))
        for a in range(0, len(rows), BLOCK_ROWS):
            part = rows[a:a + BLOCK_ROWS]
            cell = self.cell[part].ravel()
            for k, values in enumerate((self.g, self.h, None)):
                sums[k] += np.bincount(cell, None if values is None else np.repeat(values[part], width), sums.shape[1])
        return np.moveaxis(sums.reshape(3, width, self.bins), 0, 2) / np.array([self.scale, self.scale, 1.0])

    def _cells(self, nodes: list[Node], wanted: list[int], columns: np.ndarray, draw: int, first: bool) -> list[np.ndarray]:
        if first:
            self._start(columns, draw)
        return [self._sums(self.rows[k]) for k in wanted]

    def _split(self, nodes: list[Node], at: int, columns: np.ndarray) -> tuple[int, int]:
        out = super()._split(nodes, at, columns)
        rows, (left, right) = self.rows.pop(at), nodes[at].children
        low = self.drawn[rows, nodes[at].feature] <= nodes[at].bin
        self.rows[left], self.rows[right] = rows[low], rows[~low]
        return out

    def advance(self, tree: Tree, number: int) -> None:
        arrays = tree.arrays()
        self.margin = self.margin + arrays[4][_routed(arrays, self.codes)]
        self.held_margin = self.held_margin + arrays[4][_routed(arrays, self.held_codes)]


def rounds_kept(losses: list[float], patience: int) -> int:
    """Trees up to the least loss that ``patience`` further ones don't improve; ``losses[k]`` is that after k trees."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best


@dataclass
class _Fit:
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)


def _rounds(grower: _Grower, settings: Settings, stops: bool) -> _Fit:
    """Trees until their number is reached, or the loss of held-out rows hasn't improved for ``patience`` of them."""
    fit = _Fit()
    for number in range(settings.n_estimators + stops):
        # The last round with held-out rows only measures the loss of the last tree.
        if number == settings.n_estimators:
            fit.losses.append(grower.last_loss())
            break
        tree = grower.grow(number)
        grower.forget()
        if stops:
            fit.losses.append(grower.loss)
            if len(fit.losses) - 1 - rounds_kept(fit.losses, settings.patience) >= settings.patience:
                break
        fit.trees.append(tree)
        grower.advance(tree, number)
    return fit


def _in_one_task(blocks: DataFrame, cuts: list[list[float]], settings: Settings, scale: float, stops: bool) -> _Fit:
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [part for batch in batches for part in _unpacked(batch)]
        if parts:
            fit = _rounds(_OneTask(parts, cuts, settings, scale), settings, stops)
            yield pa.RecordBatch.from_pydict({"fit": [json.dumps([[asdict(t) for t in fit.trees], fit.losses])]})

    trees, losses = json.loads(blocks.coalesce(1).mapInArrow(grow, "fit string").first()["fit"])
    return _Fit([Tree(**t) for t in trees], losses)


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees and a starting margin; adds ``probability`` (a vector) and ``prediction``."""

    featuresCol = Param(Params._dummy(), "featuresCol", "column of features", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "trees, start, feature count, losses and settings", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features")

    @staticmethod
    def of(trees: list[Tree], start: float, width: int, losses: list[float], settings: Settings, features: str) -> BoostedModel:
        model = BoostedModel()
        model._set(featuresCol=features, state=json.dumps({
            "trees": [asdict(t) for t in trees], "start": start, "width": width, "losses": losses, "settings": asdict(settings)}))
        return model

    def _read(self) -> dict:
        text = self.getOrDefault(self.state)
        if getattr(self, "_from", None) != text:
            found = json.loads(text)
            found["trees"] = [Tree(**t) for t in found["trees"]]
            self._from, self._found = text, found
        return self._found

    @property
    def trees(self) -> list[Tree]:
        return self._read()["trees"]

    @property
    def start(self) -> float:
        return self._read()["start"]

    @property
    def losses(self) -> list[float]:
        """Held-out loss before the first tree and after each one grown, those cut off included."""
        return self._read()["losses"]

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gains of all splits."""
        total = np.zeros(self._read()["width"])
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[feature] += gain
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row for each node of each tree."""
        rows = [(k, n, t.feature[n], t.threshold[n], t.left[n], t.right[n], t.value[n], t.gain[n], int(t.rows[n]))
                for k, t in enumerate(self.trees) for n in range(len(t.feature))]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, "
                                           "value double, gain double, rows long")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        start = self.start
        trees = [(np.array(t.feature, np.int32), np.array(t.threshold), np.array(t.left, np.int32), np.array(t.right, np.int32),
                  np.array(t.value)) for t in self.trees]

        @F.pandas_udf("double")
        def margin(x):
            import pandas as pd

            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            out = np.full(len(x), start)
            for arrays in trees:
                out += arrays[4][_routed(arrays, values)]
            return pd.Series(out)

        columns = [quoted(c) for c in dataset.columns if c not in ("probability", "prediction")]
        one = 1 / (1 + F.exp(-F.col("__margin")))
        return dataset.withColumn("__margin", margin(vector_to_array(self.getOrDefault(self.featuresCol)))).select(
            *columns, array_to_vector(F.array(1 - one, one)).alias("probability"),
            (F.col("__margin") > 0).cast("double").alias("prediction"))


def fit_boosting(rows: DataFrame, params: Mapping, features: str = "features", label: str = "label",
                 weight: str = "weight", held_out: str | None = None) -> BoostedModel:
    """Fit on the rows; those that ``held_out`` marks only tell when to stop.

    Features are binned once and rows packed in written blocks, with their margin next to them. A round of a
    tree is one pass: leaves are counted by feature and bin, only the smaller child of a split, as the
    other is what it leaves of the parent. With ``level`` growth a round splits a whole level; with ``leaf``
    growth it finds the children of all leaves that the order of gains reaches so far, and ends when this
    order needs none that is unknown, so the tree is that of one split at a time. Only sums by
    cell reach the driver. Margins are written every ``WRITTEN_EVERY`` trees. Up to ``ONE_TASK_VALUES`` values the
    written blocks go to one task that grows the same trees.

    With held-out rows growth ends when their loss hasn't improved for ``patience`` trees, and
    the trees after the best one are cut off. The start is the log-odds of the weighted labels. A table with one
    class or no rows gives a model of no trees. Equal settings and rows in equal blocks give equal trees.
    """
    known = {f for f in Settings.__dataclass_fields__}
    unknown = set(params) - known
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    settings = Settings(**params)
    ship(rows.sparkSession)
    held = F.col(held_out) if held_out else F.lit(False)
    table = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("label"),
                        F.col(weight).cast("double").alias("weight"), held.alias("held"))
    train = ~F.col("held")
    facts = table.agg(
        F.max(F.when(train, F.size("x"))).alias("width"), F.count(F.when(train, True)).alias("n"), F.max("weight").alias("top"),
        F.sum(F.when(train, F.col("weight"))).alias("all"), F.sum(F.when(train, F.col("weight") * F.col("label"))).alias("ones"),
        F.count(F.when(~train, True)).alias("held")).first()
    width = facts["width"] or 0
    share = (facts["ones"] or 0.0) / facts["all"] if facts["all"] else 0.5
    if not facts["n"] or not width or not 0 < share < 1:
        start = math.log((share + 1e-12) / (1 - share + 1e-12))
        return BoostedModel.of([], start, width, [], settings, features)
    start = math.log(share / (1 - share))
    scale = 2.0 ** math.floor(52 - math.log2(max(facts["n"], facts["held"]) * max(facts["top"], 1.0) * 40))
    cuts = bin_cuts(table.filter(train), width, settings.max_bins, facts["n"])
    blocks, stops = _blocks(table, cuts, start), bool(facts["held"])
    if (facts["n"] + facts["held"]) * width <= ONE_TASK_VALUES:
        fit = _in_one_task(blocks, cuts, settings, scale, stops)
    else:
        with kept(blocks) as blocks:
            grower = _Grower(blocks, cuts, settings, scale)
            try:
                fit = _rounds(grower, settings, stops)
            finally:
                grower.forget()
                if grower.blocks is not blocks:
                    grower.blocks.unpersist()
    keep = rounds_kept(fit.losses, settings.patience) if fit.losses else len(fit.trees)
    return BoostedModel.of(fit.trees[:keep], start, width, fit.losses, settings, features)
