"""Classification metrics over (label, probability) columns.

Every metric is one aggregate, or a running total over distinct scores; any of
them can be computed for several models at once with ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import ratio, ratio_or_zero, round_half_even
from lateline.operators.ranks import with_running_totals
from lateline.schema import GATES

THRESHOLD_METRICS = {"f1": "f1_score", "accuracy": "accuracy", "balanced": "balanced_accuracy",
                     "recall": "recall", "precision": "precision"}
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision", "specificity"]


def threshold_grid(low: float = 0.30, high: float = 0.71, step: float = 0.05) -> list[float]:
    """Evenly spaced thresholds below ``high``, spaced by the float gap of the first two."""
    gap, grid = (low + step) - low, []
    while low + len(grid) * gap < high:
        grid.append(low + len(grid) * gap)
    return grid


def at_threshold(df: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    return df.withColumn("prediction", (F.col(probability) >= threshold).cast("int"))


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tn, fp, fn, tp in one pass; a class that never occurs counts zero."""
    actual, called = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((actual == 0) & (called == 0)).alias("tn"), F.count_if((actual == 0) & (called == 1)).alias("fp"),
        F.count_if((actual == 1) & (called == 0)).alias("fn"), F.count_if((actual == 1) & (called == 1)).alias("tp"))


def rate_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Rates of a confusion matrix; undefined ones are zero."""
    recall, specificity = ratio_or_zero(tp, tp + fn), ratio_or_zero(tn, tn + fp)
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": recall,
        "f1_score": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / 2,
    }


def rates(confused: DataFrame) -> DataFrame:
    columns = rate_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return confused.withColumns({k: v for k, v in columns.items() if k != "balanced_accuracy"})


def score_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                probability: str = "probability") -> DataFrame:
    """Positives and negatives at each distinct score, with running totals from the top."""
    scores = df.groupBy(*by, F.col(probability).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    return with_running_totals(scores, [F.col("threshold").desc()],
                               {"tp": F.col("positives"), "fp": F.col("negatives")}, by=by)


def ranking_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                    probability: str = "probability") -> DataFrame:
    """ROC area with ties at half weight, and step-wise average precision."""
    curve = score_curve(df, by, label, probability)
    area = F.sum(F.col("negatives") * (F.col("tp") - F.col("positives") / 2.0))
    steps = F.sum(F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp")))
    positives, negatives = F.sum("positives"), F.sum("negatives")
    return curve.groupBy(*by).agg(
        F.try_divide(area, positives.cast("double") * negatives).alias("roc_auc"),
        F.try_divide(steps, positives.cast("double")).alias("average_precision"))


def _with_totals(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = curve.groupBy(*by).agg(F.sum("positives").alias("all_positives"), F.sum("negatives").alias("all_negatives"))
    if by:
        return curve.join(totals, list(by))
    row = totals.first()
    return curve.withColumns({"all_positives": F.lit(row["all_positives"] or 0),
                              "all_negatives": F.lit(row["all_negatives"] or 0)})


def roc_points(df: DataFrame, by: Sequence[str] = (), label: str = "label",
               probability: str = "probability") -> DataFrame:
    """False and true positive rate at each distinct score."""
    curve = _with_totals(score_curve(df, by, label, probability), by)
    return curve.select(*by, "threshold", ratio_or_zero(F.col("fp"), F.col("all_negatives")).alias("fpr"),
                        ratio_or_zero(F.col("tp"), F.col("all_positives")).alias("tpr"))


def precision_recall_points(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                            probability: str = "probability") -> DataFrame:
    """Precision and recall at each distinct score, with the positive rate as baseline."""
    curve = _with_totals(score_curve(df, by, label, probability), by)
    every = F.col("all_positives") + F.col("all_negatives")
    return curve.select(*by, "threshold", ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        ratio_or_zero(F.col("tp"), F.col("all_positives")).alias("recall"),
                        ratio_or_zero(F.col("all_positives"), every).alias("baseline"))


def evaluate(df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction",
             probability: str = "probability") -> DataFrame:
    """Confusion counts and every metric, one row per model."""
    counted = rates(confusion(df, by, label, prediction))
    ranked = ranking_metrics(df, by, label, probability)
    if by:
        return counted.join(ranked, list(by))
    row = ranked.first()
    return counted.withColumns({c: F.lit(row[c]).cast("double") for c in ("roc_auc", "average_precision")})


def evaluate_at(df: DataFrame, threshold: float, model: str, by: Sequence[str] = (), label: str = "label",
                probability: str = "probability") -> DataFrame:
    """Metrics with a chosen threshold; the model name carries it."""
    metrics = evaluate(at_threshold(df, threshold, probability), by, label, "prediction", probability)
    return metrics.drop("average_precision").withColumns({
        "model": F.lit(f"{model} (t={threshold:.2f})"), "dataset": F.lit("test"), "threshold_used": F.lit(threshold)})


def threshold_sweep(df: DataFrame, thresholds: Sequence[float] | None = None, by: Sequence[str] = (),
                    label: str = "label", probability: str = "probability") -> DataFrame:
    """Rates at each threshold.

    A row counts once, under the number of thresholds it reaches; suffix sums of
    those few buckets give the confusion matrix of every threshold. Rows without a
    probability are left out, as in ``confusion``.
    """
    grid = sorted(thresholds if thresholds is not None else threshold_grid())
    reached = sum(((F.col(probability) >= t).cast("int") for t in grid[1:]), (F.col(probability) >= grid[0]).cast("int"))
    buckets = df.filter(F.col(probability).isNotNull()).groupBy(*by, reached.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    wide = buckets.groupBy(*by).agg(F.sum("p").alias("p"), F.sum("n").alias("n"), *[
        F.sum(F.when(F.col("bucket") > i, F.col(c)).otherwise(0)).alias(f"{c}{i}")
        for i in range(len(grid)) for c in ("p", "n")])
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"p{i}").alias("tp"), F.col(f"n{i}").alias("fp"))
                     for i, t in enumerate(grid)])
    long = wide.select(*by, "p", "n", F.explode(rows).alias("r"))
    tp, fp = F.col("r.tp"), F.col("r.fp")
    tn, fn = F.col("n") - fp, F.col("p") - tp
    return long.select(*by, "r.threshold", *[c.alias(n) for n, c in rate_columns(tn, fp, fn, tp).items()],
                       tp.alias("true_positives"), fp.alias("false_positives"),
                       tn.alias("true_negatives"), fn.alias("false_negatives"))


def best_threshold(sweep: DataFrame, metric: str = "f1", by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the best metric, the lowest one on ties."""
    column = THRESHOLD_METRICS.get(metric, "f1_score")
    best = F.max(F.struct(F.col(column).alias("score"), (-F.col("threshold")).alias("t"))).alias("best")
    return sweep.groupBy(*by).agg(best).select(*by, (-F.col("best.t")).alias("optimal_threshold"),
                                               F.col("best.score").alias("best_score"))


def passes_gates(metrics: DataFrame) -> DataFrame:
    tests = {f"{m}_ok": (F.col(m) >= low).cast("int") for m, low in GATES.items()}
    passed = None
    for m, low in GATES.items():
        passed = F.col(m) >= low if passed is None else passed & (F.col(m) >= low)
    return metrics.withColumns({**tests, "passes": passed.cast("int")})


def compare_models(results: Sequence[DataFrame], columns: Sequence[str] = METRICS, digits: int = 4) -> DataFrame:
    """One row per result with rounded metrics; a metric a result lacks is null."""
    table = results[0]
    for other in results[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    present = [c for c in [*columns, "threshold_used"] if c in table.columns]
    keys = [c for c in ("model", "dataset") if c in table.columns]
    return table.select(*keys, *[round_half_even(F.col(c), digits).alias(c) for c in present])


def long_comparison(comparison: DataFrame) -> DataFrame:
    """(model, metric, value) rows for the metrics every model has."""
    present = [c for c in METRICS if c in comparison.columns]
    long = comparison.select("model", *[F.col(c).cast("double").alias(c) for c in present]).unpivot(
        ["model"], present, "metric", "value")
    complete = long.groupBy("metric").agg(F.count_if(F.col("value").isNull()).alias("gaps"))
    # One row per metric.
    return long.join(F.broadcast(complete.filter(F.col("gaps") == 0)), "metric").select("model", "metric", "value")


def best_model(comparison: DataFrame) -> DataFrame:
    return comparison.agg(F.max_by("model", "f1_score").alias("best_by_f1"),
                          F.max_by("model", "accuracy").alias("best_by_accuracy"))
