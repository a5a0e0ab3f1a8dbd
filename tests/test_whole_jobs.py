"""Registered queries train with the parameters of the library, and few rows grow the same trees as many."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from lateline.operators import boosting, ensembles, training
from lateline.plans import catalog, catalog_models, jobs
from lateline.schema import TARGET


@pytest.fixture(scope="module")
def few_rows(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = x[:, 0] + rng.normal(size=300) * 0.5 > 0
    rows = [(*map(float, v), int(t), float(1 + t), bool(h)) for v, t, h in zip(x, y, rng.random(300) < 0.3)]
    return spark.createDataFrame(rows, f"f0 double, f1 double, f2 double, {TARGET} int, weight double, held boolean").repartition(3).cache()


@pytest.fixture
def over_few_rows(monkeypatch, few_rows):
    """The catalog over few rows, with fits that are only noted."""
    catalog.load_all()
    seen = []
    monkeypatch.setattr(catalog_models, "_rows", lambda spark, folder, split: few_rows)
    monkeypatch.setattr(catalog_models, "_columns", lambda spark, folder: ["f0", "f1", "f2"])
    monkeypatch.setattr(catalog_models, "raw_shipments", lambda spark, folder: few_rows)
    monkeypatch.setattr(catalog_models, "derived", lambda spark, folder, name, build: build())
    monkeypatch.setattr(catalog_models, "_folder", lambda spark, label: label)

    class Noted(Exception):
        pass

    def run(spark, build):
        with pytest.raises(Noted):
            build(spark, "none")
        return seen

    def noting(*args, **options):
        seen.append((args, options))
        raise Noted

    return run, noting, monkeypatch


@pytest.mark.parametrize("name", training.MODELS)
def test_models_have_the_parameters_of_the_library(spark, over_few_rows, name):
    run, noting, patch = over_few_rows
    patch.setattr(training, "fit_vectors", noting)
    (args, _), = run(spark, lambda s, f: catalog_models.fitted(s, f, name))
    assert args[0] == name and args[1] == training.PARAMS[name]


def test_early_stop_can_take_effect(spark, over_few_rows):
    run, noting, patch = over_few_rows
    patch.setattr(training, "fit_vectors", noting)
    (args, _), = run(spark, catalog.QUERIES["m04_boosted_trees_early_stop"])
    assert args[5] is not None and args[1]["n_estimators"] > args[1]["patience"]


def test_full_job_has_the_parameters_of_the_library(spark, over_few_rows):
    run, noting, patch = over_few_rows
    patch.setattr(jobs, "run_full", noting)
    (_, options), = run(spark, catalog.QUERIES["j01_s16_full_job"])
    assert not options.get("params")


@pytest.mark.parametrize("query", ["m08_base_estimators", "m10_soft_voting"])
def test_bases_have_the_parameters_of_the_library(spark, over_few_rows, query):
    run, noting, patch = over_few_rows
    patch.setattr(ensembles, "fit_vectors", noting)
    run(spark, catalog.QUERIES[query])
    bases = {kind: p for kind, p, *_ in ensembles.BASES.values()}
    seen = run(spark, catalog.QUERIES[query])
    assert seen and all(args[1] == bases[args[0]] for args, _ in seen)


def test_stacking_has_the_folds_and_parameters_of_the_library(spark, over_few_rows):
    run, noting, patch = over_few_rows
    patch.setattr(ensembles.EnsembleTrainer, "_stack", lambda self, rows, k, use_proba: noting(self.params, k))
    (args, _), = run(spark, catalog.QUERIES["m09_stacking"])
    assert args == ({}, 5)


@pytest.mark.parametrize("query", ["m11_long_boosting", "m12_cross_validation"])
def test_long_boosting_has_the_parameters_of_the_library(spark, over_few_rows, query):
    run, noting, patch = over_few_rows
    patch.setattr(ensembles, "fit_vectors", noting)
    (args, options), = run(spark, catalog.QUERIES[query])
    assert args[1] == ensembles.LONG_BOOSTING and options["held_out"] is not None


def test_cross_validation_has_three_folds(spark, over_few_rows):
    run, noting, patch = over_few_rows
    patch.setattr(ensembles, "fit_vectors", lambda *args, **options: None)
    patch.setattr(ensembles.EnsembleTrainer, "_accuracy", lambda self, fit, rows, k: noting(k))
    assert run(spark, catalog.QUERIES["m12_cross_validation"]) == [((3,), {})]


@pytest.mark.parametrize("held_out", [None, "held"])
@pytest.mark.parametrize("params", [
    {"growth": "level", "max_depth": 4, "subsample": 0.7, "colsample_bytree": 0.7, "gamma": 0.1, "min_child_weight": 3},
    {"growth": "leaf", "num_leaves": 9, "min_child_samples": 5, "reg_alpha": 0.1, "reg_lambda": 0.0}])
def test_one_task_grows_the_trees_of_many(few_rows, monkeypatch, params, held_out):
    rows = few_rows.select(array_to_vector(boosting.F.array("f0", "f1", "f2")).alias("features"), boosting.F.col(TARGET).alias("label"),
                           "weight", "held")
    found = []
    for most in (boosting.ONE_TASK_VALUES, 0):
        monkeypatch.setattr(boosting, "ONE_TASK_VALUES", most)
        model = boosting.fit_boosting(rows, {"n_estimators": 3, "patience": 2, **params}, held_out=held_out)
        found.append((model.trees, model.losses))
    assert found[0][0] and found[0] == found[1]


def test_folds_and_bases_at_once_give_the_same_models(few_rows, monkeypatch):
    """Steps that run others together, as the folds of few rows do, give what they give one after the other."""
    small = {"lr": {"max_iter": 3}, "rf": {"n_estimators": 2, "max_depth": 2}}
    found = []
    for values in (ensembles.FOLDS_AT_ONCE, 0):
        monkeypatch.setattr(ensembles, "FOLDS_AT_ONCE", values)
        monkeypatch.setattr(ensembles, "BASES_AT_ONCE", values)
        trainer = ensembles.EnsembleTrainer(few_rows, ["f0", "f1", "f2"], params=small, bases=["lr", "rf"])
        model = trainer.train_stacking(cv=2, cv_folds=0)
        found.append((list(model.bases), model.meta.stages[-1].coefficients.toArray().round(6).tolist()))
    assert found[0] == found[1]
