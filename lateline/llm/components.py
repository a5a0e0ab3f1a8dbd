"""Connected components of a graph of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.session import stage


def least_connected(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of ``size`` rows is connected to by the edges ``a``, ``b`` of a group."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(after, at, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its ``label``, the least node of its component, for all nodes of the edges ``a``, ``b``.

    Every round takes the least label among the neighbours and then the label of that
    label, so long paths halve. Labels are written after each round; the rounds end when
    none changes. Nothing but the number of changes reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = stage(both.toDF("node", "other"), "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jumped = lower.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select(
            "node", F.least("label", "next").alias("label"), (F.least("label", "next") != F.col("before")).alias("changed"))
        after = stage(jumped, "labels")
        if after.filter("changed").isEmpty():
            return after.drop("changed")
        labels = after.drop("changed")
