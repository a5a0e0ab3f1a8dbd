from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.operators import ensembles, metrics, ranks, risk, selection, splitting, supply, training
from lateline.plans import jobs
from lateline.schema import ORDER_ID, TARGET
from tests.conftest import SCHEMA, order_rows


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(42)
    label = rng.integers(0, 2, 400)
    p = np.clip(np.round(0.3 * label + rng.random(400) * 0.7, 2), 0, 1)
    rows = [(int(a), float(b), "m1") for a, b in zip(label, p)] + [(int(a), float(1 - b), "m2") for a, b in zip(label, p)]
    return spark.createDataFrame(rows, "label int, probability double, model string").cache()


def brute_area(label, p):
    pos, neg = p[label == 1], p[label == 0]
    return ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())


def brute_average_precision(label, p):
    total, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        called = p >= t
        recall = (label[called] == 1).sum() / (label == 1).sum()
        total += (recall - before) * (label[called] == 1).mean()
        before = recall
    return total


# ---- metrics ----

@pytest.mark.parametrize("window", [1_000_000, 20])
def test_areas_match_brute_force_with_ties(scores, window, monkeypatch):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", window)
    for row in metrics.ranking_metrics(scores, ["model"]).collect():
        part = scores.filter(F.col("model") == row["model"]).toPandas()
        label, p = part["label"].to_numpy(), part["probability"].to_numpy()
        assert row["roc_auc"] == pytest.approx(brute_area(label, p), abs=1e-12)
        assert row["average_precision"] == pytest.approx(brute_average_precision(label, p), abs=1e-12)


def test_single_class_still_gives_a_full_matrix(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2)], "label int, probability double")
    row = metrics.evaluate(metrics.at_threshold(df)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (0, 0, 1, 1)
    assert row["specificity"] == 0.0 and row["roc_auc"] is None


def test_sweep_matches_direct_counts(scores):
    one = scores.filter("model = 'm1'")
    frame = one.toPandas()
    for row in metrics.threshold_sweep(one).collect():
        called = frame["probability"] >= row["threshold"]
        assert row["true_positives"] == int((called & (frame["label"] == 1)).sum())
        assert row["false_positives"] == int((called & (frame["label"] == 0)).sum())
        assert row["accuracy"] == pytest.approx(float((called == (frame["label"] == 1)).mean()))


def test_grid_and_best_threshold(spark):
    grid = metrics.threshold_grid()
    assert len(grid) == 9 and grid[0] == 0.30 and grid[2] == 0.39999999999999997 and grid[8] == 0.7
    sweep = spark.createDataFrame([(0.3, 0.5, 0.1), (0.4, 0.5, 0.9)], "threshold double, f1_score double, recall double")
    assert metrics.best_threshold(sweep, "unknown").first()["optimal_threshold"] == 0.3
    assert metrics.best_threshold(sweep, "recall").first()["optimal_threshold"] == 0.4


def test_comparison_tables(scores):
    rows = metrics.evaluate(metrics.at_threshold(scores), ["model"])
    tuned = metrics.evaluate_at(scores.filter("model = 'm1'").drop("model"), 0.45, "m1")
    table = metrics.compare_models([rows.withColumn("dataset", F.lit("test")), tuned])
    names = {r["model"]: r for r in table.collect()}
    assert names["m1 (t=0.45)"]["average_precision"] is None and names["m1"]["threshold_used"] is None
    assert "average_precision" not in {r["metric"] for r in metrics.long_comparison(table).collect()}
    assert metrics.best_model(table).count() == 1
    assert metrics.passes_gates(rows).filter("model = 'm2'").first()["passes"] == 0
    assert metrics.roc_points(scores, ["model"]).agg(F.max("tpr")).first()[0] == 1.0
    assert metrics.precision_recall_points(scores.drop("model")).count() > 10


# ---- risk ----

@pytest.mark.parametrize("p,band,priority", [(0.0, "low", 3), (0.3, "low", 3), (0.31, "medium", 2), (0.6, "medium", 2),
                                             (0.61, "high", 1), (1.0, "high", 1)])
def test_risk_bands(spark, p, band, priority):
    df = spark.createDataFrame([(1, p, 1)], "id int, probability double, prediction int")
    row = risk.with_alert_priority(risk.with_risk(df)).first()
    assert (row["delay_risk_category"], row["alert_priority"]) == (band, priority)
    assert row["delay_risk_score"] == float(np.round(p * 100, 1))


def test_high_risk_includes_the_threshold_and_sorts(spark):
    df = spark.createDataFrame([(1, 0.6), (2, 0.59), (3, 0.9)], "id int, delay_risk_probability double")
    assert [r["id"] for r in risk.high_risk(df, 0).collect()] == [3, 1]
    assert risk.high_risk(df, 0.95).count() == 0


def test_risk_summary_totals(scores):
    row = risk.risk_summary(metrics.at_threshold(scores)).first()
    assert row["total_shipments"] == 800 == row["predicted_late"] + row["predicted_on_time"]
    assert row["low_risk_count"] + row["medium_risk_count"] + row["high_risk_count"] == 800
    frame = scores.toPandas()
    assert row["median_risk_score"] == pytest.approx(float((frame["probability"] * 100).round(1).median()))


# ---- rankings ----

@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(42)
    a, noise, gap = rng.normal(size=300), rng.normal(size=300), rng.random(300)
    rows = [(float(x), float(2 * x + 0.01 * n), float(n), 5.0, None if g < 0.2 else float(x * n), int(x + 0.3 * n > 0))
            for x, n, g in zip(a, noise, gap)]
    return spark.createDataFrame(rows, f"a double, b double, noise double, flat double, gappy double, {TARGET} int").cache()


def test_moments_match_pandas_with_gaps(table):
    frame = table.toPandas()
    variance, links = selection.pairwise_moments(table, frame.columns.tolist())
    np.testing.assert_allclose(variance, frame.var().to_numpy(), rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(links, frame.corr().to_numpy(), rtol=1e-9, atol=1e-9)


def test_variance_and_correlation_reports(table):
    assert [r["feature"] for r in selection.low_variance(table).collect()] == ["flat"]
    pairs = {(r["feature_1"], r["feature_2"]) for r in selection.high_correlation(table).collect()}
    assert ("a", "b") in pairs and ("a", "noise") not in pairs
    low = selection.high_correlation(table, 0.1).count()
    assert low >= selection.high_correlation(table, 0.9).count()
    assert selection.target_correlation(table).first()["feature"] in ("a", "b")


def test_f_test_matches_brute_force(table):
    frame = table.toPandas().fillna(0.0)
    for row in selection.f_test(table).collect():
        groups = [g[row["feature"]].to_numpy() for _, g in frame.groupby(TARGET)]
        everything = np.concatenate(groups)
        between = sum(len(g) * (g.mean() - everything.mean()) ** 2 for g in groups)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups)
        if within == 0:
            assert row["f_score"] is None
        else:
            assert row["f_score"] == pytest.approx(between / (within / (len(everything) - 2)), rel=1e-9)


def test_f_tail_values():
    # Upper tails of the F distribution from tables.
    assert selection.f_tail(3.936, 1, 100) == pytest.approx(0.05, abs=2e-4)
    assert selection.f_tail(2.710, 5, 20) == pytest.approx(0.05, abs=2e-4)
    assert selection.f_tail(0.0, 1, 10) == 1.0


def test_top_features(table):
    for method in ("random_forest", "f_test", "mutual_info"):
        assert selection.top_features(table, 2, method).count() == 2
    assert selection.top_features(table, 99, "f_test").count() == 5
    with pytest.raises(ValueError):
        selection.top_features(table, 3, "other")


def test_combined_ranking(table):
    rows = selection.combined_importance(table, 5, 3).collect()
    assert [r["rank"] for r in rows] == sorted(r["rank"] for r in rows)
    assert all(0.0 <= r["avg_importance"] <= 1.0 for r in rows)


# ---- training ----

SMALL = {"logistic_regression": {"max_iter": 20}, "random_forest": {"n_estimators": 5, "max_depth": 3},
         "xgboost": {"n_estimators": 3, "max_depth": 2}}


@pytest.fixture(scope="module")
def training_rows(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] + x[:, 1] + 0.3 * rng.normal(size=500) > 0).astype(int)
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"id int, f0 double, f1 double, f2 double, f3 double, {TARGET} int").cache()


def test_models_learn_and_survive_saving(spark, training_rows, tmp_path):
    names = ["f0", "f1", "f2", "f3"]
    models = training.train_models(training_rows.filter("id < 400"), features=names, params=SMALL,
                                   models=[*training.MODELS, "unknown"], save_to=str(tmp_path))
    assert list(models) == training.MODELS
    test = training_rows.filter("id >= 400")
    for name, model in models.items():
        scored = model.score(test, ["id"], TARGET)
        assert metrics.evaluate(scored).first()["accuracy"] > 0.75
        again = training.TrainedModel.load(spark, str(tmp_path / name)).score(test, ["id"], TARGET)
        assert again.exceptAll(scored).isEmpty()
        assert {r["feature"] for r in model.importance(spark).limit(2).collect()} == {"f0", "f1"}
    with pytest.raises(ValueError):
        models["random_forest"].score(test.drop("f1"))
    with pytest.raises(FileNotFoundError):
        training.TrainedModel.load(spark, str(tmp_path / "none"))
    models["random_forest"].features = ["one"]
    assert "feature_0" in {r["feature"] for r in models["random_forest"].importance(spark).collect()}


def test_unknown_model_and_early_stop(training_rows):
    trainer = training.Trainer(training_rows, ["f0", "f1"], training_rows, params=SMALL)
    with pytest.raises(ValueError):
        trainer.train("other")
    assert trainer.train("xgboost", use_early_stopping=True).params["n_estimators"] == 3


def test_weights_balance_the_classes(training_rows):
    rows = training.weighted(training.assemble(training_rows.filter(f"{TARGET} = 1 or id % 4 = 0"), ["f0"], TARGET), "balanced")
    sums = [r["s"] for r in rows.groupBy("label").agg(F.sum("weight").alias("s")).collect()]
    assert sums[0] == pytest.approx(sums[1])


def test_ensembles(spark, training_rows, tmp_path):
    small = {"lr": {"max_iter": 5}, "gb": {"n_estimators": 2, "max_depth": 2},
             "long": {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3}}
    trainer = ensembles.EnsembleTrainer(training_rows, ["f0", "f1", "f2"], training_rows, params=small, bases=["lr", "gb"])
    stacked = trainer.train_stacking(cv=2, cv_folds=2)
    assert len(stacked.cv_scores) == 2 and stacked.cv_report(spark).first()["cv_mean"] > 0.7
    stacked.save(spark, str(tmp_path / "e"))
    again = ensembles.EnsembleModel.load(spark, str(tmp_path / "e"))
    assert again.score(training_rows, ["id"]).exceptAll(stacked.score(training_rows, ["id"])).isEmpty()
    soft = trainer.train_voting(cv_folds=0).score(training_rows, ["id"], TARGET)
    assert metrics.evaluate(soft).first()["roc_auc"] > 0.8
    hard = trainer.train_voting("hard", weights={"lr": 1.0, "gb": 1.0}, cv_folds=0)
    assert set(hard.score(training_rows, ["id"]).columns) == {"id", "prediction"}
    assert trainer.train_long_boosting(cv_folds=0).score(training_rows, ["id"]).count() == 500
    with pytest.raises(ValueError):
        trainer.train_voting("other")


# ---- supply ----

def test_abc_and_tiers(spark, monkeypatch):
    stock = spark.createDataFrame([(i, 1, 1.0, float(v)) for i, v in enumerate([80, 10, 5, 5])],
                                  "sku int, order_lines int, quantity double, value double")
    for window in (1_000_000, 2):
        monkeypatch.setattr(ranks, "WINDOW_ROWS", window)
        assert [r["abc_class"] for r in supply.abc_classes(stock).orderBy("sku").collect()] == ["A", "B", "B", "C"]
    scores = spark.createDataFrame([(i, s) for i, s in enumerate([0.1, 0.5, 0.5, 0.9])], "supplier int, vendor_score double")
    found = {r["supplier"]: r["percentile"] for r in supply.vendor_tiers(scores).collect()}
    assert found == pytest.approx({0: 0.0, 1: 1 / 3, 2: 1 / 3, 3: 1.0})


# ---- jobs ----

def test_full_job_from_a_folder_of_csv(spark, tmp_path):
    rows = order_rows(400)
    frame = pd.DataFrame(rows, columns=spark.createDataFrame([], SCHEMA).columns)
    frame[ORDER_ID] = range(len(rows))
    (tmp_path / "raw").mkdir()
    frame.to_csv(tmp_path / "raw" / "supply.csv", index=False)
    paths = jobs.Paths(str(tmp_path / "project"))
    assert jobs.run_evaluate(spark, paths) == {}

    def value(report, stage, key):
        return report.filter((F.col("stage") == stage) & (F.col("key") == key)).first()["value"]

    first = jobs.run_full(spark, str(tmp_path / "raw"), paths, params=SMALL)
    assert value(first, "train", "action") == "trained" and value(first, "evaluate", "models_evaluated") == "3"
    second = jobs.run_full(spark, str(tmp_path / "raw"), paths, params=SMALL)
    assert value(second, "train", "action") == "models exist"
    scored = jobs.run_predict(spark, str(tmp_path / "raw" / "supply.csv"), paths, "random_forest", str(tmp_path / "out"))
    assert scored.count() == 400 and scored.select(quoted(ORDER_ID)).distinct().count() == 400
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 400
    again = jobs.run_predict(spark, str(tmp_path / "raw" / "supply.csv"), paths, "random_forest", refit=True)
    assert again.count() == 400
    assert "split" in splitting.time_split(scored).columns
