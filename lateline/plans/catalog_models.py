"""Queries on training, ensembles, evaluation of stored models, and whole jobs.

Models on their own, ensembles and the full job have the parameters of the library. Those of ``project``,
``m05_m07_training_metadata``, ``j02_train_job`` and ``leak_comparison`` are reduced; the rows are always the whole tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators import ensembles, metrics, training
from lateline.operators.risk import risk_summary
from lateline.operators.splitting import SPLIT, model_columns
from lateline.operators.features import drop_non_features
from lateline.plans import jobs
from lateline.plans.catalog import derived, divided, featured, query
from lateline.plans.catalog_features import RANKED
from lateline.plans.oracle_views import half_even, over
from lateline.plans.shipments import raw_shipments
from lateline.schema import ORDER_ID, TARGET
from lateline.session import shared_folder

SMALL = {"logistic_regression": {"max_iter": 30}, "random_forest": {"n_estimators": 10, "max_depth": 5},
         "xgboost": {"n_estimators": 5, "max_depth": 4}}


def _folder(spark, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def project(spark, folder) -> jobs.Paths:
    """A project trained once on the raw order lines."""
    def build():
        paths = jobs.Paths(_folder(spark, "project"))
        jobs.run_train(spark, raw_shipments(spark, folder), paths, SMALL)
        return paths
    return derived(spark, folder, "project", build)


def _rows(spark, folder, split):
    return drop_non_features(divided(spark, folder)).filter(F.col(SPLIT) == split)


def _columns(spark, folder):
    return model_columns(drop_non_features(divided(spark, folder)))


def _trainer(spark, folder):
    return training.Trainer(_rows(spark, folder, "train"), _columns(spark, folder), _rows(spark, folder, "validation"))


def _measured(model, rows):
    return metrics.evaluate(model.score(rows, [], TARGET)).select(
        F.lit(model.name).alias("model"), *metrics.METRICS)


@query("m01_scaler", over("feat", "AND VIEW s AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg(coalesce(CAST("{c}" AS DOUBLE), 0)) AS m, stddev_samp(coalesce(CAST("{c}" AS DOUBLE), 0)) AS d FROM feat"""
    for c in RANKED) + f") SELECT feature, {half_even('m', 6)} AS mean, {half_even('d', 6)} AS std FROM s"))
def _(spark, folder):
    table = training.scaler_parameters(featured(spark, folder), RANKED)
    return table.withColumns({c: round_half_even(F.col(c), 6) for c in ("mean", "std")})


def fitted(spark, folder, name):
    """A model on its own, trained once."""
    return derived(spark, folder, f"model {name}", lambda: _trainer(spark, folder).train(name))


def _single(name):
    def build(spark, folder):
        return _measured(fitted(spark, folder, name), _rows(spark, folder, "test"))
    return build


query("m02_logistic_regression")(_single("logistic_regression"))
query("m03_random_forest")(_single("random_forest"))
query("m04_boosted_trees")(_single("xgboost"))


@query("m04_boosted_trees_early_stop")
def _(spark, folder):
    model = _trainer(spark, folder).train("xgboost", use_early_stopping=True)
    return _measured(model, _rows(spark, folder, "test"))


@query("m05_m07_training_metadata")
def _(spark, folder):
    models = training.train_models(_rows(spark, folder, "train"), features=_columns(spark, folder), params=SMALL,
                                   models=["logistic_regression", "no_such_model"])
    return models["logistic_regression"].metadata(spark).drop("training_seconds")


def _ensembles(spark, folder):
    return ensembles.EnsembleTrainer(_rows(spark, folder, "train"), _columns(spark, folder),
                                     _rows(spark, folder, "validation"))


def combined(spark, folder, kind):
    """An ensemble, trained once."""
    # No query shows the scores of cross validation of these; that of m12_cross_validation is its own.
    train = {"stacking": lambda e: e.train_stacking(cv_folds=0), "voting": lambda e: e.train_voting(cv_folds=0),
             "long": lambda e: e.train_long_boosting(cv_folds=0)}[kind]
    return derived(spark, folder, f"ensemble {kind}", lambda: train(_ensembles(spark, folder)))


@query("m08_base_estimators")
def _(spark, folder):
    """Test metrics of each base classifier on its own."""
    parts = []
    for name in ensembles.BASES:
        trainer = ensembles.EnsembleTrainer(_rows(spark, folder, "train"), _columns(spark, folder), bases=[name])
        parts.append(_measured(trainer.train_voting(cv_folds=0), _rows(spark, folder, "test"))
                     .withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query("m09_stacking")
def _(spark, folder):
    return _measured(combined(spark, folder, "stacking"), _rows(spark, folder, "test"))


@query("m10_soft_voting")
def _(spark, folder):
    return _measured(combined(spark, folder, "voting"), _rows(spark, folder, "test"))


@query("m10_hard_voting")
def _(spark, folder):
    model = _ensembles(spark, folder).train_voting("hard", cv_folds=0)
    return metrics.rates(metrics.confusion(model.score(_rows(spark, folder, "test"), [], TARGET)))


@query("m11_long_boosting")
def _(spark, folder):
    return _measured(combined(spark, folder, "long"), _rows(spark, folder, "test"))


@query("m12_cross_validation")
def _(spark, folder):
    return _ensembles(spark, folder).train_long_boosting().cv_report(spark).drop("training_seconds")


@query("a01_evaluate_model")
def _(spark, folder):
    model = training.TrainedModel.load(spark, project(spark, folder).model("random_forest"))
    rows = jobs.read_splits(spark, project(spark, folder).splits).filter(F.col(SPLIT) == "test")
    return metrics.evaluate(model.score(rows, [], TARGET))


@query("a08_model_importance")
def _(spark, folder):
    return training.TrainedModel.load(spark, project(spark, folder).model("random_forest")).importance(spark)


@query("a15_s15_evaluate_all")
def _(spark, folder):
    return jobs.run_evaluate(spark, project(spark, folder))["model_comparison"]


@query("s13_r01_model_round_trip")
def _(spark, folder):
    paths = project(spark, folder)
    model = training.TrainedModel.load(spark, paths.model("logistic_regression"))
    copy = _folder(spark, "copy")
    model.save(spark, copy)
    return training.TrainedModel.load(spark, copy).importance(spark)


@query("r02_r03_score")
def _(spark, folder):
    paths = project(spark, folder)
    model = training.TrainedModel.load(spark, paths.model("xgboost"))
    rows = jobs.read_splits(spark, paths.splits)
    return model.score(rows, [SPLIT], TARGET)


@query("s14_r08_batch_scoring")
def _(spark, folder):
    paths = project(spark, folder)
    out = f"{paths.root}/predictions-{uuid.uuid4().hex}"
    jobs.run_predict(spark, raw_shipments(spark, folder), paths, "random_forest", out, "parquet")
    return spark.read.parquet(out).select(ORDER_ID, "delay_risk_probability", "delay_risk_prediction",
                                          "delay_risk_category", "delay_risk_score")


@query("j01_s16_full_job", over("base", """SELECT 'load' AS stage, 'rows' AS key, count(*)::VARCHAR AS value FROM raw
UNION ALL SELECT 'preprocess', 'rows', count(*)::VARCHAR FROM crit
UNION ALL SELECT * FROM (VALUES ('load', 'status', 'success'), ('validate', 'status', 'success'), ('validate', 'is_valid', 'False'),
('preprocess', 'status', 'success'), ('features', 'status', 'success'), ('features', 'columns', '57'), ('train', 'status', 'success'),
('train', 'action', 'trained'), ('evaluate', 'status', 'success'), ('evaluate', 'models_evaluated', '3'))"""))
def _(spark, folder):
    return jobs.run_full(spark, raw_shipments(spark, folder), jobs.Paths(_folder(spark, "full")))


@query("j02_train_job")
def _(spark, folder):
    models = jobs.run_train(spark, raw_shipments(spark, folder), jobs.Paths(_folder(spark, "train")), SMALL,
                            ["logistic_regression"])
    return models["logistic_regression"].importance(spark)


@query("j03_evaluate_job")
def _(spark, folder):
    return jobs.run_evaluate(spark, project(spark, folder))["threshold_analysis"]


@query("j04_predict_job_summary")
def _(spark, folder):
    scored = jobs.run_predict(spark, raw_shipments(spark, folder), project(spark, folder), "logistic_regression")
    return risk_summary(scored, "delay_risk_probability", "delay_risk_prediction")


@query("leak_comparison")
def _(spark, folder):
    """Test accuracy with and without the columns known only after delivery."""
    rows = drop_non_features(divided(spark, folder))
    parts = []
    for label, remove in (("without_leaks", True), ("with_leaks", False)):
        columns = model_columns(rows, remove_leaky_features=remove)
        trainer = training.Trainer(rows.filter(F.col(SPLIT) == "train"), columns, params=SMALL)
        scored = trainer.train("random_forest").score(rows.filter(F.col(SPLIT) == "test"), [], TARGET)
        parts.append(metrics.rates(metrics.confusion(scored)).select(F.lit(label).alias("variant"), "accuracy", "recall"))
    return parts[0].unionByName(parts[1])


@query("fitted_state_round_trip", over("clean", f"""SELECT CAST(count(*) AS BIGINT) AS "rows", {half_even('sum("Sales") / count(*)', 4)} AS mean_sales FROM clean"""))
def _(spark, folder):
    """A stored cleaner gives the same table as the one that was fitted."""
    from lateline.operators.cleaning import CleanerModel
    from lateline.plans.catalog import cleaner_model
    path = _folder(spark, "cleaner")
    cleaner_model(spark, folder).save(spark, path)
    table = CleanerModel.load(spark, path).transform(raw_shipments(spark, folder))
    return table.agg(F.count(F.lit(1)).alias("rows"),
                     round_half_even(F.sum(quoted("Sales")) / F.count(F.lit(1)), 4).alias("mean_sales"))
