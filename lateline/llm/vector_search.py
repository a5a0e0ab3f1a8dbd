"""Approximate nearest neighbours with learned partitions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.session import stage

#: Vectors that the partitions are learned from, at most, and vectors a partition holds on average.
SAMPLE, PART_ITEMS = 6_000, 2_000
#: Sample vectors that a partition has at least.
_SAMPLE_A_PART = 40
#: Queries whose true neighbours say how many partitions to search, and the recall wanted of them.
TRIAL_QUERIES, RECALL = 128, 0.95
#: Items and queries that one task compares at once.
ITEM_BLOCK, QUERY_BLOCK = 4_096, 1_024
_GRAPH, _HIDDEN, _STEPS, _ROWS_A_STEP, _RATE = 10, 96, 400, 512, 0.01


@dataclass
class Router:
    """A classifier with one hidden layer: which partitions hold the neighbours of a vector."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.first + self.first_bias, 0) @ self.second + self.second_bias

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions, the most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def neighbour_graph(x: np.ndarray, k: int = _GRAPH) -> np.ndarray:
    """The k others of largest inner product of each vector, block by block."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1024):
        scores = x[a:a + 1024] @ x.T
        scores[np.arange(len(scores)), a + np.arange(len(scores))] = -np.inf
        out[a:a + 1024] = np.argpartition(-scores, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.05, rounds: int = 8) -> np.ndarray:
    """Cut the graph into parts of about equal size with few edges between them.

    It starts from halves along the direction of most spread, again and again, and then moves
    vertices to the part of most of their neighbours, the largest gain first, while
    there is room.
    """
    part = np.zeros(len(x), np.int64)

    def halve(rows: np.ndarray, first: int, number: int) -> None:
        if number == 1:
            part[rows] = first
            return
        centred = x[rows] - x[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        left = number // 2
        order = rows[np.argsort(centred @ direction, kind="stable")]
        cut = len(rows) * left // number
        halve(order[:cut], first, left)
        halve(order[cut:], first + left, number - left)

    halve(np.arange(len(x)), 0, parts)
    room = int(np.ceil(slack * len(x) / parts))
    near_of = np.concatenate([np.repeat(np.arange(len(x)), graph.shape[1]), graph.reshape(-1)])
    near_to = np.concatenate([graph.reshape(-1), np.repeat(np.arange(len(x)), graph.shape[1])])
    for _ in range(rounds):
        votes = np.bincount(near_of * parts + part[near_to], minlength=len(x) * parts).reshape(len(x), parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < room:
                sizes[part[v]] -= 1
                sizes[best[v]] += 1
                part[v] = best[v]
                moved += 1
        if not moved:
            break
    return part


def learn_router(x: np.ndarray, parts: int, seed: int = 3) -> Router:
    """Learn partitions of the sample's neighbour graph and a classifier of where neighbours lie."""
    random, width = np.random.default_rng(seed), x.shape[1]
    router = Router(random.standard_normal((width, _HIDDEN)).astype(np.float32) * (2 / width) ** 0.5,
                    np.zeros(_HIDDEN, np.float32),
                    random.standard_normal((_HIDDEN, parts)).astype(np.float32) * _HIDDEN ** -0.5, np.zeros(parts, np.float32))
    if parts == 1:
        return router
    graph = neighbour_graph(x)
    part = balanced_partition(x, graph, parts)
    goal = np.zeros((len(x), parts), np.float32)
    for column in (np.arange(len(x)), *graph.T):
        goal[np.arange(len(x)), part[column]] += 1
    goal /= goal.sum(axis=1, keepdims=True)
    weights = [router.first, router.first_bias, router.second, router.second_bias]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, _STEPS + 1):
        rows = random.integers(0, len(x), min(_ROWS_A_STEP, len(x)))
        hidden = np.maximum(x[rows] @ router.first + router.first_bias, 0)
        logits = hidden @ router.second + router.second_bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (chance / chance.sum(axis=1, keepdims=True) - goal[rows]) / len(rows)
        back = (error @ router.second.T) * (hidden > 0)
        slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        for w, m, s, g in zip(weights, mean, square, slopes):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w -= _RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return router


def _matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    edges = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[edges[0]:edges[-1]].astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _sound(vector: Column) -> Column:
    """A vector without null, NaN and infinite components that is not zero."""
    fine = F.forall(vector, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda v: v != 0), F.lit(False))


_LANES = 16
_BEST = "query_id long, lane int, best array<struct<minus: double, vec_id: long>>"


def _top(table_items: pa.Table, table_queries: pa.Table, k: int) -> pa.Table:
    """The k best of a block of items for each of a block of queries, by exact inner products, ties to smaller numbers.

    One row a query; ``lane`` spreads the rows of a query over several merges.
    """
    entry = pa.struct([("minus", pa.float64()), ("vec_id", pa.int64())])
    schema = pa.schema([("query_id", pa.int64()), ("lane", pa.int32()), ("best", pa.list_(entry))])
    if not table_items.num_rows or not table_queries.num_rows:
        return schema.empty_table()
    x, q = _matrix(table_items.column("vector")), _matrix(table_queries.column("vector"))
    holders = table_items.column("ids").combine_chunks()
    edges, ids = holders.offsets.to_numpy(), holders.values.to_numpy()
    out_ids, out_minus = [], []
    scores = q @ x.T
    keep = min(k + 1, len(x))
    bound = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
    numbers = table_queries.column("query_id").to_pylist()
    for row, number in enumerate(numbers):
        # A little below the bound, as sums in another order differ in the last bits.
        at = np.flatnonzero(scores[row] >= bound[row] - 1e-9 * max(1.0, abs(bound[row])))
        exact = (x[at] * q[row]).sum(axis=1)
        each = edges[at + 1] - edges[at]
        found = np.concatenate([ids[edges[a]:edges[a + 1]] for a in at])
        value = np.repeat(exact, each)
        own = found == number
        found, value = found[~own], value[~own]
        best = np.lexsort((found, -value))[:k]
        out_ids.append(found[best])
        out_minus.append(-value[best])
    ends = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in out_ids])]), pa.int32())
    entries = pa.StructArray.from_arrays([pa.array(np.concatenate(out_minus)), pa.array(np.concatenate(out_ids))],
                                         fields=list(entry))
    lane = (31 * table_items.column("part")[0].as_py() + table_items.column("block")[0].as_py()) % _LANES
    return pa.Table.from_arrays([pa.array(numbers, pa.int64()), pa.array([lane] * len(numbers), pa.int32()),
                                 pa.ListArray.from_arrays(ends, entries)], schema=schema)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, recall: float = RECALL, id_column: str = "vec_id",
            vector_column: str = "embedding", sample: int = SAMPLE, part_items: int = PART_ITEMS) -> DataFrame:
    """For each row that ``queries`` holds for, its k nearest among all other rows by inner product.

    A bounded sample of the vectors, at most about ``sample`` by hash, gives a neighbour graph, balanced
    partitions of it and a classifier. The classifier puts every vector into its most probable
    partition and sends each query to the several most probable ones. How many is
    measured, not guessed: ``TRIAL_QUERIES`` queries are compared with all vectors, and the least
    number that reaches ``recall`` for them is taken. All vectors of those partitions are
    compared exactly in double precision and the best stay.

    Equal vectors are one item with its k + 1 smallest identifiers, which are all that a result
    can hold, so a vector that many rows have is no hot spot. Large partitions are cut
    into blocks of items, and queries into blocks as well.

    Result: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; nearest first, ties to the smaller
    identifier. Rows take no part if the identifier is null, or the vector is null, zero, of another
    length than most, or holds a null or non-finite component. Rows that repeat the
    query's identifier are its own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    every = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"),
                           F.coalesce(queries, F.lit(False)).alias("asks")).filter(
        F.col("id").isNotNull() & _sound(F.col("vector")))
    common = every.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = common["width"] if common else 1
    sound = every.filter(F.size("vector") == width).withColumn("vector", F.col("vector").cast("array<float>"))
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    items = sound.select("id", "vector").distinct().withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("id")).alias("ids"))
    items = stage(items.withColumn("hash", F.xxhash64("vector")), "items")
    asked = stage(sound.filter("asks").select(F.col("id").alias("query_id"), "vector").dropDuplicates(["query_id"]), "queries")
    number, asking = items.count(), asked.count()
    if not number or not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    share = (F.col("hash") / F.lit(float(1 << 63)) + 1) / 2
    drawn = items.filter(share <= min(1.0, sample / number)).select("hash", "vector").orderBy("hash").toArrow()
    x = _matrix(drawn.column("vector"), np.float32)
    parts = max(1, min(-(-number // part_items), len(x) // _SAMPLE_A_PART))
    router = learn_router(x / np.maximum(np.abs(x).max(), 1e-30), parts) if parts > 1 else None
    scale = np.maximum(np.abs(x).max(), 1e-30) if len(x) else 1.0
    shared = spark.sparkContext.broadcast((router, scale))

    def ranked(vector: np.ndarray) -> np.ndarray:
        router, scale = shared.value
        return router.ranked((vector / scale).astype(np.float32)) if router else np.zeros((len(vector), 1), np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = ranked(_matrix(batch.column("vector"), np.float32))[:, 0] if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(batch.column(c) for c in (
                "hash", "ids", "vector"))], ["part", "hash", "ids", "vector"])

    index = stage(items.select("hash", "ids", "vector").mapInArrow(
        place, "part int, hash long, ids array<long>, vector array<float>"), "index")
    probes = _probes(index, asked, ranked, parts, k, recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = ranked(_matrix(batch.column("vector"), np.float32))[:, :probes].astype(np.int32)
            edges = pa.array(np.arange(len(lists) + 1) * lists.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vector"), pa.ListArray.from_arrays(
                edges, pa.array(lists.reshape(-1)))], ["query_id", "vector", "parts"])

    sent = asked.mapInArrow(route, "query_id long, vector array<float>, parts array<int>").select(
        "query_id", "vector", F.explode("parts").alias("part"))
    sizes = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ITEM_BLOCK).alias("blocks"))
    loads = sent.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("turns"))
    plan = F.broadcast(sizes.join(loads, "part"))  # one row a partition
    left = index.join(plan, "part").select(
        "part", F.pmod("hash", "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"), "ids", "vector")
    right = sent.join(plan, "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), "turns").alias("turn"), "query_id", "vector")
    group = ["part", "block", "turn"]
    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(lambda a, b: _top(a, b, k), _BEST)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best")
    merged = met.groupBy("query_id", "lane").agg(best).groupBy("query_id").agg(best)
    ranked_ids = merged.select("query_id", F.posexplode("best").alias("place", "x"))
    return ranked_ids.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"),
                             (-F.col("x.minus")).alias("score"))


def _probes(index: DataFrame, asked: DataFrame, ranked, parts: int, k: int, recall: float) -> int:
    """Partitions to search: the least number that holds the wanted share of the trial queries' true neighbours."""
    if parts == 1:
        return 1
    trial = asked.orderBy(F.xxhash64("query_id")).limit(TRIAL_QUERIES).toArrow()
    numbers, q = trial.column("query_id").to_numpy(), _matrix(trial.column("vector"))
    shared = index.sparkSession.sparkContext.broadcast((numbers, q))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, q = shared.value
        for batch in batches:
            x = _matrix(batch.column("vector"))
            if not len(x):
                continue
            part = batch.column("part").to_numpy()
            lists = batch.column("ids")
            first = lists.values.to_numpy()[lists.offsets.to_numpy()[:-1]]
            only = np.diff(lists.offsets.to_numpy()) == 1
            scores = q @ x.T
            scores[(first[None, :] == numbers[:, None]) & only[None, :]] = -np.inf
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            row = np.repeat(np.arange(len(q)), top.shape[1])
            flat = top.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(part[flat]), pa.array(scores[row, flat])],
                                             ["row", "part", "score"])

    order = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score")))
    true = index.select("part", "ids", "vector").mapInArrow(best, "row long, part int, score double").withColumn(
        "r", order).filter(F.col("r") <= k).select("row", "part").toArrow()
    place = np.argsort(ranked(q.astype(np.float32)), axis=1)
    wanted = np.sort(place[true.column("row").to_numpy(), true.column("part").to_numpy()])
    return int(wanted[min(len(wanted) - 1, int(np.ceil(recall * len(wanted))) - 1)]) + 1 if len(wanted) else 1
