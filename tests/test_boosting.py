from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lateline.operators import boosting, training
from lateline.operators.boosting import BoostedModel, Settings, fit_boosting

WIDTH = 5


def sample(seed=1, count=400):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(count, WIDTH)), 1)
    x[:, 3] = x[:, 3] > 0.8
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=count) * 0.5 > 0.3).astype(int)
    weight = np.where(y == 1, 1.5, 1.0)
    return x, y, weight, rng.random(count) < 0.3


def frame(spark, x, y, weight, held):
    rows = [(list(map(float, a)), float(b), float(c), bool(d)) for a, b, c, d in zip(x, y, weight, held)]
    return spark.createDataFrame(rows, "x array<double>, label double, weight double, held boolean").repartition(3).select(
        array_to_vector("x").alias("features"), "label", "weight", "held")


def brute_tree(x, g, h, s):
    """One tree by plain loops, splitting one leaf at a time: nested (feature, threshold, left, right) or a leaf's weight."""
    def shrunk(v):
        return math.copysign(max(abs(v) - s.reg_alpha, 0.0), v)

    def score(at):
        below = h[at].sum() + s.reg_lambda
        return shrunk(g[at].sum()) ** 2 / below if below > 0 else 0.0

    def split(at, depth):
        best = None
        if depth < s.max_depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[:, f])[:-1]:
                    left, right = at[x[at, f] <= v], at[x[at, f] > v]
                    if min(len(left), len(right)) < s.min_child_samples or min(h[left].sum(), h[right].sum()) < s.min_child_weight:
                        continue
                    gain = score(left) + score(right) - score(at)
                    if gain > 1e-6 and gain >= s.gamma and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, v, left, right)
        return best

    root = {"at": np.arange(len(x)), "depth": 0}
    leaves = [root]
    while s.growth == "level" or len(leaves) < s.num_leaves:
        found = [(leaf, split(leaf["at"], leaf["depth"])) for leaf in leaves]
        found = [(leaf, b) for leaf, b in found if b]
        if not found:
            break
        leaf, (_, f, v, left, right) = max(found, key=lambda p: p[1][0])
        leaf["split"] = (f, v, {"at": left, "depth": leaf["depth"] + 1}, {"at": right, "depth": leaf["depth"] + 1})
        leaves = [n for n in leaves if n is not leaf] + list(leaf["split"][2:])

    def plain(node):
        if "split" in node:
            f, v, a, b = node["split"]
            return (int(f), float(v), plain(a), plain(b))
        at = node["at"]
        return round(float(-shrunk(g[at].sum()) / (h[at].sum() + s.reg_lambda) * s.learning_rate), 6)

    return plain(root)


def nested(tree, at=0):
    if tree.feature[at] < 0:
        return round(tree.value[at], 6)
    return (tree.feature[at], tree.threshold[at], nested(tree, tree.left[at]), nested(tree, tree.right[at]))


@pytest.mark.parametrize("params", [
    {"max_depth": 3, "min_child_weight": 3.0, "gamma": 0.1},
    {"max_depth": 4, "reg_lambda": 0.5, "reg_alpha": 2.0, "min_child_samples": 15},
    {"growth": "leaf", "max_depth": 12, "num_leaves": 9, "reg_alpha": 0.1, "reg_lambda": 0.1, "min_child_samples": 10},
    {"growth": "leaf", "max_depth": 3, "num_leaves": 31, "min_child_weight": 1e-3},
    {"growth": "leaf", "max_depth": 12, "num_leaves": 2},
])
def test_trees_equal_one_split_at_a_time(spark, params):
    x, y, weight, _ = sample()
    model = fit_boosting(frame(spark, x, y, weight, np.zeros(len(y), bool)), {"n_estimators": 3, "learning_rate": 0.4, **params})
    settings = Settings(n_estimators=3, learning_rate=0.4, **params)
    share = (weight * y).sum() / weight.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    assert abs(model.start - margin[0]) < 1e-12 and len(model.trees) == 3
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        want = brute_tree(x, (p - y) * weight, p * (1 - p) * weight, settings)
        assert str(nested(tree)) == str(want)
        margin += np.array(tree.value)[boosting._routed(
            (np.array(tree.feature), np.array(tree.threshold), np.array(tree.left), np.array(tree.right)), x)]


@pytest.mark.parametrize("change", [
    {"gamma": 8.0}, {"min_child_weight": 12.0}, {"min_child_samples": 60}, {"reg_lambda": 30.0}, {"reg_alpha": 9.0}, {"subsample": 0.5},
    {"colsample_bytree": 0.4}, {"max_depth": 1}, {"learning_rate": 0.01}, {"growth": "leaf", "num_leaves": 3}, {"max_bins": 4}])
def test_each_parameter_changes_the_model(spark, change):
    data = frame(spark, *sample()[:3], np.zeros(400, bool))
    base = {"n_estimators": 2, "max_depth": 4}
    assert [nested(t) for t in fit_boosting(data, {**base, **change}).trees] != [nested(t) for t in fit_boosting(data, base).trees]


def test_columns_are_drawn_for_a_tree_and_rows_by_frequency(spark):
    data = frame(spark, *sample()[:3], np.zeros(400, bool))
    model = fit_boosting(data, {"n_estimators": 6, "max_depth": 5, "colsample_bytree": 0.4})
    used = [set(t.feature) - {-1} for t in model.trees]
    assert all(len(u) <= 2 for u in used) and len(set(map(frozenset, used))) > 1
    drawn = fit_boosting(data, {"n_estimators": 4, "subsample": 0.5, "max_depth": 0}).trees
    assert len({t.rows[0] for t in drawn}) > 1 and all(100 < t.rows[0] < 300 for t in drawn)
    held = fit_boosting(data, {"n_estimators": 4, "subsample": 0.5, "subsample_freq": 0, "max_depth": 0}).trees
    assert {t.rows[0] for t in held} == {400.0}


def test_patience_keeps_the_rounds_of_a_plain_loop(spark):
    x, y, weight, held = sample()
    params = {"n_estimators": 40, "max_depth": 5, "learning_rate": 0.6, "patience": 4}
    model = fit_boosting(frame(spark, x, y, weight, held), params, held_out="held")
    free = fit_boosting(frame(spark, x[~held], y[~held], weight[~held], held[~held]), {**params, "n_estimators": len(model.losses) - 1})
    margin, losses = np.full(held.sum(), free.start), []
    for k in range(len(free.trees) + 1):
        losses.append(float((np.logaddexp(0, margin) - y[held] * margin) @ weight[held] / weight[held].sum()))
        if k < len(free.trees):
            t = free.trees[k]
            margin = margin + np.array(t.value)[boosting._routed((np.array(t.feature), np.array(t.threshold), np.array(t.left),
                                                                  np.array(t.right)), x[held])]
    assert np.allclose(model.losses, losses, atol=1e-9)
    best, waited = 0, 0
    for k, loss in enumerate(losses):
        best, waited = (k, 0) if loss < losses[best] else (best, waited + (k > 0))
        if waited == 4:
            break
    assert 0 < best < 40 and len(model.trees) == best and k == len(losses) - 1


def test_rounds_kept():
    assert boosting.rounds_kept([1.0, 0.5, 0.6, 0.4, 0.5, 0.5, 0.1], 2) == 3
    assert boosting.rounds_kept([1.0, 1.0, 1.0], 5) == 0
    assert boosting.rounds_kept([3.0, 2.0, 1.0], 1) == 2


def test_scores_and_round_trip(spark, tmp_path):
    x, y, weight, held = sample()
    data = frame(spark, x, y, weight, held)
    model = fit_boosting(data, {"n_estimators": 5, "growth": "leaf", "num_leaves": 6, "min_child_samples": 5})
    margin = np.full(len(y), model.start)
    for t in model.trees:
        margin += np.array(t.value)[boosting._routed((np.array(t.feature), np.array(t.threshold), np.array(t.left), np.array(t.right)), x)]
    got = model.transform(data).select("features", vector_to_array("probability").alias("p"), "prediction").collect()
    want = {tuple(a): 1 / (1 + math.exp(-m)) for a, m in zip(x.tolist(), margin)}
    assert all(abs(r.p[1] - want[tuple(r.features)]) < 1e-12 and r.p[0] + r.p[1] == pytest.approx(1) for r in got)
    assert all(r.prediction == (r.p[1] > 0.5) for r in got)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(again, BoostedModel) and again.trees == model.trees and again.start == model.start
    assert again.featureImportances == model.featureImportances and abs(sum(model.featureImportances) - 1) < 1e-12
    nodes = model.nodes(spark)
    assert nodes.filter("node = 0").agg(F.min("rows"), F.max("rows")).first()[:] == (400, 400)
    inner = nodes.filter("feature >= 0").collect()
    rows = {(r.tree, r.node): r.rows for r in nodes.collect()}
    assert inner and all(rows[(r.tree, r.left)] + rows[(r.tree, r.right)] == r.rows for r in inner)


def test_one_class_no_rows_and_wrong_parameters(spark):
    x, y, weight, held = sample()
    data = frame(spark, x, y, weight, held)
    one = fit_boosting(data.filter("label = 1"), {"n_estimators": 3})
    assert one.trees == [] and {r.prediction for r in one.transform(data).collect()} == {1.0}
    assert fit_boosting(data.filter("label = 9"), {"n_estimators": 3}).trees == []
    for wrong in ({"growth": "up"}, {"max_bins": 300}, {"no_such": 1}, {"subsample": 0.0}, {"gamma": -1.0}, {"num_leaves": 0}):
        with pytest.raises(ValueError):
            fit_boosting(data, wrong)


def test_bins_of_few_values_are_the_values(spark):
    rows = spark.range(2000).select(F.array(F.when(F.col("id") == 7, 1.0).otherwise(0.0), F.col("id") / 1.0, F.lit(3.0)).alias("x"))
    cuts = boosting.bin_cuts(rows, 3, 32)
    assert cuts[0] == [0.0] and cuts[2] == [] and len(cuts[1]) == 31
    assert all(abs(c - 2000 * (k + 1) / 32) < 5 for k, c in enumerate(cuts[1]))


def test_few_values_take_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 300, 1, 3).select(F.array(F.col("id") % 5 / 1.0, F.when(F.col("id") < 9, -0.0).otherwise(F.col("id") % 2 / 1.0)).alias("x"))
    assert boosting.bin_cuts(rows.mapInArrow(count, "x array<double>"), 2, 32) == [[0.0, 1.0, 2.0, 3.0], [0.0]]
    assert seen.value == 300
    # Few in each part, many in all.
    spread = spark.range(0, 90, 1, 9).select(F.array(F.col("id") / 1.0).alias("x"))
    assert len(boosting.bin_cuts(spread, 1, 32)[0]) == 31


def test_large_parts_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(training, "PART_ROWS", 50)
    rows = spark.range(0, 900, 1, 2).select((F.col("id") % 300).alias("id"))
    parts = training.dealt(rows).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(parts) == 18 and max(r["n"] for r in parts) < 100
    assert training.dealt(rows).columns == ["id"] and training.dealt(rows).exceptAll(rows).isEmpty()
    small = spark.range(0, 90, 1, 2)
    assert training.dealt(small) is small and training.dealt(rows.filter("id < 0")).isEmpty()


def test_folds_have_equal_shares_of_each_label(spark):
    rows = [(1.0 if k % 3 == 0 else 0.0, 5) for k in range(100)] + [(None, 5)] * 7
    data = spark.createDataFrame(rows, "label double, same int").repartition(6)
    marked = training.folded(data, 4)
    assert marked.columns == ["label", "same", "fold"] and marked.count() == 107
    sizes = {}
    for r in marked.groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    assert all(len(v) == 4 and max(v) - min(v) <= 1 for v in sizes.values()) and sorted(sizes[None]) == [1, 2, 2, 2]
    with pytest.raises(ValueError):
        training.folded(data, 1)
