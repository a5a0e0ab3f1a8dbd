"""Similarity join on sets of word n-grams by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.llm.collocations import _frequent_filter, _may_have
from lateline.llm.components import components, least_connected
from lateline.llm.spans import as_long, mix, mix_one, shingles, slices, span_hashes, texts, words
from lateline.session import stage

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.99
#: Buckets of more sets are split further, up to so many levels.
SMALL_BUCKET, LEVELS = 256, 6
#: A large node that keeps such a share of its parent's sets is compared as it is; another split would part little.
UNSHRUNK = 0.9
#: A task compares the sets of one block, or of one block with those of another, in tiles of so many by so many.
BLOCK, TILE = 4_096, 1_024
#: A sketch is one byte of each of so many least hashes. Pairs go on to the exact comparison unless so
#: many standard deviations of the estimate lie between them and the threshold.
SKETCH, DEVIATIONS = 128, 5.0
_TURNS = mix(np.arange(2 * SKETCH, dtype=np.uint64)) | np.uint64(1)
_COLUMNS_AT_ONCE, _CELLS_AT_ONCE = 8_192, 200_000


def _plain(text: Column) -> Column:
    """Words in lower case, without marks."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " ")


def _row_keys(id_column: str, text_column: str) -> list[Column]:
    """128 bits that stand for a row's identifier and text."""
    key, text = quoted(id_column), quoted(text_column)
    return [F.xxhash64(key, text).alias("k1"), F.xxhash64(text, F.lit(1), key).alias("k2")]


def _sets(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different n-gram hashes of each row, ascending, and the edges of the rows."""
    t = texts(part.column("text"))
    w = words(t)
    grams, edges = shingles(span_hashes(t, w.starts, w.lengths), w.edges, width)
    each = [np.unique(grams[a:b]) for a, b in zip(edges, edges[1:])]
    return (np.concatenate(each) if each else grams), np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)


def _set_keys(grams: np.ndarray, edges: np.ndarray) -> list[bytes | None]:
    """128 bits that stand for a set."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(s)))]) for s in (0x51, 0xA7)]
    halves = np.stack([s[edges[1:]] - s[edges[:-1]] for s in sums], axis=1)
    return [halves[i].tobytes() if b > a else None for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def _children(grams: np.ndarray, edges: np.ndarray, parents: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that sets go to from their parent nodes, and their rows.

    A node chooses a gram if its hash there is below 1 / (threshold x size of the set), so that
    two similar sets choose one gram in common on average.
    """
    sizes = np.diff(edges)
    row = np.repeat(np.arange(len(sizes)), sizes)
    bound = np.minimum(2.0 ** 64 / (threshold * np.maximum(sizes, 1)), 2.0 ** 64 - 2048).astype(np.uint64)
    hashes = mix(grams ^ parents[row])
    chosen = hashes <= bound[row]
    return mix(hashes[chosen]), row[chosen]


def _chosen(grams: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that one set goes to from each of some nodes, and the places of these; as ``_children`` chooses."""
    bound = np.uint64(min(2.0 ** 64 / (threshold * max(len(grams), 1)), 2.0 ** 64 - 2048))
    found, places = [], []
    at_once = max(1, _CELLS_AT_ONCE // max(len(grams), 1))
    for begin in range(0, len(nodes), at_once):
        hashes = mix(nodes[begin:begin + at_once, None] ^ grams[None, :])
        place, gram = np.nonzero(hashes <= bound)
        found.append(mix(hashes[place, gram]))
        places.append(place + begin)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def _only(rows: DataFrame, key: Column, bits: np.ndarray) -> DataFrame:
    """Rows whose ``key`` may be one of those that a filter was made of; it is of bounded size and lets some others through."""
    @F.arrow_udf("boolean")
    def may(keys: pa.Array) -> pa.Array:
        return pa.array(_may_have(bits, keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    return rows.filter(may(key))


def _below(sets: DataFrame, roots: np.ndarray, splits: list[pa.Table], threshold: float) -> DataFrame:
    """Where sets go to (``set_key, node``) on the level below ``splits``, and the number of sets of the node ``before``.

    ``splits`` (``node``, ``n``) has the nodes that were split, level by level behind the roots, to which the sets' own
    nodes of the first level come. They have more than ``SMALL_BUCKET`` sets each and go to every task.
    """
    known = []
    for split in splits:
        nodes = split.column("node").to_numpy().view(np.uint64)
        order = np.argsort(nodes)
        known.append((nodes[order], split.column("n").to_numpy()[order]))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for first, grams in zip(batch.column("nodes"), batch.column("grams")):
                first, grams = (x.values.to_numpy().view(np.uint64) for x in (first, grams))
                nodes, place = _chosen(grams, roots, threshold)
                before = None
                for level, (split, n) in enumerate(known):
                    nodes = np.concatenate([nodes, first]) if level == 0 else nodes
                    at = np.minimum(np.searchsorted(split, nodes), len(split) - 1)
                    here = split[at] == nodes
                    parents, before = nodes[here], n[at[here]]
                    nodes, place = _chosen(grams, parents, threshold)
                found.append(as_long(nodes))
                sizes.append(np.zeros(0, np.int64) if before is None else before[place])
            if found:
                keys = batch.column("set_key").take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
                before = pa.array(np.concatenate(sizes)) if known else pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(found)), before], ["set_key", "node", "before"])

    return sets.mapInArrow(descend, "set_key binary, node long, before long")


def runs_for(recall: float, levels: int = 3) -> int:
    """Runs after which a pair at the threshold has met with the target probability.

    A pair meets below a node if it chooses a common gram there and meets below that; each
    node gives it one common gram on average.
    """
    meets = 1.0
    for _ in range(levels):
        meets = 1 - math.exp(-meets)
    return math.ceil(math.log(1 - recall) / math.log(1 - meets))


def _sketches(grams: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Sketches of the sets; that of an empty set means nothing."""
    out = np.zeros((len(edges) - 1, SKETCH), np.uint8)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        for k in range(SKETCH):
            least = np.minimum.reduceat(grams * _TURNS[2 * k] + _TURNS[2 * k + 1], edges[:-1][full])
            out[full, k] = (mix(least) & np.uint64(255)).astype(np.uint8)
    return [x.tobytes() for x in out]


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))


def _stats(members: DataFrame, split_from: int | None = None) -> DataFrame:
    """Nodes of two sets or more; of nodes with the same sets only one, unless they have ``split_from`` sets or more.

    Nodes that are compared as they are give the same pairs if they have the same sets. Nodes that are
    split choose other grams each, which is what makes the runs independent, so all of them stay.
    """
    sums = members.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("set_key") % F.lit(1 << 40)).alias("sum"),
        F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("xor")).filter("n > 1")
    own = F.lit(None) if split_from is None else F.when(F.col("n") >= split_from, F.col("node"))
    return sums.groupBy("n", "sum", "xor", own.cast("long").alias("own")).agg(F.min("node").alias("node")).select("node", "n")


def _tiles(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and other rows to compare: all of one block among themselves, or all of one with all of another."""
    block = table.column("block").to_numpy()
    low, high = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    a = [at for at in np.split(np.flatnonzero(block == low), range(TILE, len(block), TILE)) if len(at)]
    b = a if low == high else [at for at in np.split(np.flatnonzero(block == high), range(TILE, len(block), TILE)) if len(at)]
    for i, rows in enumerate(a):
        for others in b[i:] if low == high else b:
            yield rows, others


def _maybe(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a group that may have a similar one there, by their sketches, and what stands for all that they lead to.

    That is the same for the same sets in any group, so what several groups find is compared once.
    """
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
    bound = SKETCH * (threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / SKETCH))
    found = []
    for a, b in _tiles(table):
        same = np.zeros((len(a), len(b)), np.int16)
        for x, y in zip(np.ascontiguousarray(sketch[a].T), np.ascontiguousarray(sketch[b].T)):
            same += x[:, None] == y[None, :]
        near = same >= bound
        if a is b:
            np.fill_diagonal(near, False)
        found.append(_edges(near, a, b))
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    label = least_connected(len(sketch), a, b)
    low, high = np.frombuffer(b"".join(table.column("set_key").to_pylist()), np.uint64).reshape(-1, 2).T
    sums = np.zeros(len(label), np.uint64)
    np.add.at(sums, label, mix(low ^ mix(high)))
    rows = np.unique(np.concatenate([a, b]))
    return rows, as_long(mix(sums[label[rows]]))


def _linked(table: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, other rows and which of them are similar, by exact Jaccard similarity of all pairs of a group."""
    lists = table.column("grams").combine_chunks()
    edges = lists.offsets.to_numpy()
    _, ids = np.unique(lists.values.to_numpy()[edges[0]:edges[-1]], return_inverse=True)
    edges = edges - edges[0]
    sizes = np.diff(edges)

    def entries(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = sizes[rows]
        row = np.repeat(np.arange(len(rows)), count)
        return row, ids[np.repeat(edges[:-1][rows] - np.cumsum(count) + count, count) + np.arange(count.sum())]

    for a, b in _tiles(table):
        (row_a, id_a), (row_b, id_b) = entries(a), entries(b)
        common = np.zeros((len(a), len(b)), np.float32)
        both = np.intersect1d(id_a, id_b)
        if a is b:
            both = both[np.bincount(id_a, minlength=len(ids) + 1)[both] > 1]
        at_a, at_b = (np.minimum(np.searchsorted(both, x), max(len(both) - 1, 0)) for x in (id_a, id_b))
        in_a, in_b = ((both[at] == x if len(both) else np.zeros(len(x), bool)) for at, x in ((at_a, id_a), (at_b, id_b)))
        for begin in range(0, len(both), _COLUMNS_AT_ONCE):
            parts = []
            for rows, row, at, inside in ((a, row_a, at_a, in_a), (b, row_b, at_b, in_b)):
                own = inside & (at >= begin) & (at < begin + _COLUMNS_AT_ONCE)
                part = np.zeros((len(rows), min(_COLUMNS_AT_ONCE, len(both) - begin)), np.float32)
                part[row[own], at[own] - begin] = 1
                parts.append(part)
            common += parts[0] @ parts[1].T
        near = common * (1 + threshold) >= threshold * (sizes[a][:, None] + sizes[b][None, :]) - 1e-3
        if a is b:
            np.fill_diagonal(near, False)
        yield a, b, near


def _edges(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges enough to connect what a tile links: a breadth-first search between its two sides."""
    roots, members = [], []
    left, right = np.ones(len(a), bool), np.ones(len(b), bool)
    for start in np.flatnonzero(near.any(axis=1)):
        if not left[start]:
            continue
        left[start] = False
        front = [(start, True)]
        while front:
            at, side = front.pop()
            line, fresh, rows = (near[at], right, b) if side else (near[:, at], left, a)
            next_ = np.flatnonzero(line & fresh)
            fresh[next_] = False
            front += [(k, not side) for k in next_]
            roots += [a[start]] * len(next_)
            members += rows[next_].tolist()
    return np.array(roots, np.int64), np.array(members, np.int64)


def _forest(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """One edge for each set of a group that another leads to."""
    found = [_edges(near, a, b) for a, b, near in _linked(table, threshold)]
    a, b = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    label = least_connected(table.num_rows, a, b)
    member = np.flatnonzero(label != np.arange(len(label)))
    return label[member], member


def _block_pairs(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Deal the sets of each group (``node``, ``set_key``) out to pairs of blocks, with what ``sets`` has of them."""
    blocks = F.ceil(F.col("n") / BLOCK)
    sized = groups.select("node", "set_key").join(groups.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "node")
    dealt = sized.select("node", "set_key", (F.col("n") > BLOCK).alias("parted"), F.pmod(F.xxhash64("set_key", F.lit(2)), blocks).alias("block"), F.explode(
        F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    return dealt.select("node", "set_key", "parted", "block", F.least("block", "other").alias("lo"),
                        F.greatest("block", "other").alias("hi")).join(sets, "set_key").groupBy("node", "lo", "hi")


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every row its ``class_id``, its number of ``links``, whether it is ``kept``, and its row keys.

    Documents are sets of hashed n-grams of ``width`` words (lower case, marks left out); a
    shorter text is one n-gram of all its words. Two documents are linked if their sets have
    a Jaccard similarity of at least ``threshold``. A class holds all that links connect, its
    identifier is its smallest one, and the row that has it is kept.

    Equal sets are one set from the start, so copies cost nothing more. Then, from a root for
    each of ``runs_for(recall)`` runs, every set moves along the grams that its node chooses to
    child nodes; nodes of one set end, nodes of more than ``SMALL_BUCKET`` are split again, and the
    others are buckets. A pair that is found only on the last level needs ``runs_for(recall, LEVELS)``
    runs; both its sets are in large nodes then, so only sets of large nodes take the further runs.
    A large node that hardly differs from its parent is a bucket too: splitting doesn't part
    what shares most of its grams. In a bucket, sketches tell which sets may have a similar one there; what
    they connect is compared once, however many buckets find it: all pairs of it exactly, which gives edges
    enough to connect them. At last each class counts its links exactly. A group of more than ``BLOCK`` sets is compared by pairs of blocks, and a task
    goes through its blocks in tiles. Pairs are never rows.

    A text without words is linked to nothing and is a class of its own. Rows repeated with
    identifier and text have equal answers, so all are kept or none. Null identifiers come
    last in the order.
    """
    missing = F.col("doc_id").isNull()
    rows_in = docs.select(quoted(id_column).cast("long").alias("doc_id"), *_row_keys(id_column, text_column),
                          _plain(F.coalesce(quoted(text_column), F.lit(""))).alias("text"))
    roots = [mix_one(0xC0FFEE + r) for r in range(runs_for(recall))]
    further = np.array([mix_one(0xC0FFEE + r) for r in range(len(roots), runs_for(recall, LEVELS))], np.uint64)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                grams, edges = _sets(part, width)
                met = [_children(grams, edges, np.full(len(edges) - 1, r, np.uint64), threshold) for r in roots]
                node, row = (np.concatenate(x) for x in zip(*met))
                order = np.argsort(row, kind="stable")
                starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(edges) - 1))])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "k1", "k2")), pa.array(_set_keys(grams, edges), pa.binary()),
                     pa.array(_sketches(grams, edges), pa.binary()), _lists(as_long(node[order]), starts)],
                    ["doc_id", "k1", "k2", "set_key", "sketch", "nodes"])

    rows = stage(rows_in.mapInArrow(
        describe, "doc_id long, k1 long, k2 long, set_key binary, sketch binary, nodes array<long>"), "sets")
    first = F.struct(missing.alias("missing"), "doc_id", "k1", "k2")
    sets = stage(rows.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.count(F.lit(1)).alias("copies"), F.min(first).alias("first"), F.first("sketch").alias("sketch"),
        F.first("nodes").alias("nodes")), "different")

    def sift(table: pa.Table) -> pa.Table:
        rows, together = _maybe(table, threshold)
        node, key = table.column("node").take(pa.array(rows)), table.column("set_key").take(pa.array(rows))
        # Pairs of blocks see parts of what is connected, so a parted group stays one.
        return pa.table({"node": node if table.column("parted")[0].as_py() else pa.array(together), "set_key": key})

    def sifted(groups: DataFrame, sketches: DataFrame) -> DataFrame:
        return stage(_block_pairs(groups, sketches).applyInArrow(sift, "node long, set_key binary").distinct(), "sifted")

    members = sets.select("set_key", F.explode("nodes").alias("node"))
    met = stage(members.join(_stats(members, SMALL_BUCKET + 1), "node"), "met")
    buckets, large = met.filter(F.col("n") <= SMALL_BUCKET), met.filter(F.col("n") > SMALL_BUCKET)
    compared = sifted(buckets, sets.select("set_key", "sketch"))
    nodes_of = large.groupBy("set_key").agg(F.collect_set("node").alias("nodes"))
    wanted = stage(compared.select("set_key").union(large.select("set_key")).distinct().join(nodes_of, "set_key", "left").join(
        sets.drop("nodes"), "set_key").select("set_key", "sketch", "first.k1", "first.k2", "nodes"), "wanted")
    sketches = wanted.select("set_key", "sketch")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                grams, edges = _sets(part, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_keys(grams, edges), pa.binary()), _lists(as_long(grams), edges), part.column("nodes")],
                    ["set_key", "grams", "nodes"])

    keyed = docs.select(*_row_keys(id_column, text_column), F.coalesce(quoted(text_column), F.lit("")).alias("text"))
    needed = _only(keyed, F.col("k1"), _frequent_filter(wanted.select(F.col("k1").alias("key")), wanted.count()))
    gathered = stage(needed.select("k1", "k2", _plain(F.col("text")).alias("text")).join(
        wanted.select("k1", "k2", "nodes"), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("text", "nodes").mapInArrow(
        gather, "set_key binary, grams array<long>, nodes array<long>"), "grams")
    key = F.xxhash64("set_key")

    def grams_among(sets: DataFrame) -> DataFrame:
        """Of the gathered grams those of some sets, and few others."""
        return _only(gathered, key, _frequent_filter(sets.select(key.alias("key")), sets.count()))

    whole, splits = large.select("set_key", "node").limit(0), []
    for level in range(1, LEVELS + 1):
        if large.isEmpty():
            break
        if level > 1:
            splits.append(large.select("node", "n").distinct().toArrow())
        sets_here = gathered if level < 3 else grams_among(large.select("set_key").distinct())
        children = stage(_below(sets_here.filter("nodes IS NOT NULL"), further, splits, threshold), "below")
        below = stage(children.join(_stats(children, SMALL_BUCKET + 1), "node"), "met")
        compared = compared.union(sifted(below.filter(F.col("n") <= SMALL_BUCKET), sketches))
        unshrunk = F.coalesce(F.col("n") >= UNSHRUNK * F.col("before"), F.lit(False))
        left = below.filter(F.col("n") > SMALL_BUCKET)
        whole = whole.union(left.filter(unshrunk).select("set_key", "node"))
        left = left.filter(~unshrunk).select("set_key", "node", "n")
        large = large.select("set_key", "node", "n").union(left) if level == 1 else left
    whole = whole.union(large.select("set_key", "node"))
    compared = stage(compared.union(sifted(whole.join(_stats(whole), "node"), sketches)).distinct(), "compared")
    grams_of = grams_among(compared.select("set_key").distinct()).drop("nodes")

    def connect(table: pa.Table) -> pa.Table:
        a, b = _forest(table, threshold)
        keys = table.column("set_key")
        return pa.table({"a": keys.take(pa.array(a, pa.int64())), "b": keys.take(pa.array(b, pa.int64()))})

    labels = components(_block_pairs(compared, grams_of).applyInArrow(connect, "a binary, b binary"))
    classes = labels.select(F.col("label").alias("node"), F.col("node").alias("set_key"))
    copies = sets.select("set_key", "copies", "first")

    def count(table: pa.Table) -> pa.Table:
        copies = table.column("copies").to_numpy().astype(float)
        links = np.zeros(len(copies))
        for a, b, near in _linked(table, threshold):
            links[a] += near @ copies[b]
            if a is not b:
                links[b] += near.T @ copies[a]
        return pa.table({"set_key": table.column("set_key"), "links": pa.array(links.astype(np.int64))})

    counted = _block_pairs(classes, grams_of.join(copies.drop("first"), "set_key")).applyInArrow(
        count, "set_key binary, links long").groupBy("set_key").agg(F.sum("links").alias("links"))
    heads = classes.join(copies, "set_key").groupBy("node").agg(F.min("first").alias("head"))
    of_class = classes.join(heads, "node").select("set_key", "head")
    info = copies.join(of_class, "set_key", "left").join(counted, "set_key", "left").select(
        "set_key", F.coalesce("head", "first").alias("head"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    joined = rows.drop("nodes").join(info, "set_key", "left")
    alone = F.col("set_key").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        (alone | ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2")))).alias("kept"), "k1", "k2")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of the input without all but one document of each class, and without repeated rows."""
    kept = similar_documents(docs, threshold, width, recall, id_column, text_column).filter("kept").select("k1", "k2")
    k1, k2 = _row_keys(id_column, text_column)
    keyed = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), k1.alias("k1"), k2.alias("k2"))
    return keyed.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
