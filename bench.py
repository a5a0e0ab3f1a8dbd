"""Time the stages of the pipeline and some reports; print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every
stage reads whole tables. The three learners run with the reduced parameters
below, which the JSON line repeats.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.operators import metrics, quality, selection, supply
from lateline.operators.cleaning import Cleaner
from lateline.operators.features import FeatureBuilder
from lateline.operators.risk import risk_summary
from lateline.operators.splitting import SPLIT, model_columns, time_split
from lateline.operators.training import train_models
from lateline.plans import jobs
from lateline.plans.shipments import raw_shipments, shipments
from lateline.schema import QUANTITY, REAL_DAYS, SALES, SCHEDULED_DAYS, SHIPPING_MODE, TARGET
from lateline.session import local_session, stage
from lateline.sources.tables import read_splits, write_splits

PARAMS = {"logistic_regression": {"max_iter": 100}, "random_forest": {"n_estimators": 20, "max_depth": 8},
          "xgboost": {"n_estimators": 20, "max_depth": 5}}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    spark = local_session(cpus, "bench")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.time()
        result = run()
        times[name] = round(time.time() - start, 3)
        return result

    root = tempfile.mkdtemp(prefix="lateline-bench-")
    paths = jobs.Paths(root)
    raw = raw_shipments(spark, folder)
    # A first small read pays for starting the workers and compiling.
    timed("warm_up", lambda: spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect())
    lines = timed("load", lambda: stage(raw, "bench_raw"))
    timed("validate", lambda: quality.validate(lines).report.collect())
    cleaned = timed("preprocess", lambda: stage(Cleaner().fit_transform(lines)[0], "bench_clean"))
    features = timed("features", lambda: stage(FeatureBuilder().fit_transform(cleaned)[0], "bench_features"))
    timed("split", lambda: write_splits(time_split(features), paths.splits))
    rows = read_splits(spark, paths.splits)
    columns = model_columns(rows)
    train, validation = (rows.filter(F.col(SPLIT) == s) for s in ("train", "validation"))
    for name in PARAMS:
        timed(f"train_{name}", lambda name=name: train_models(
            train, validation, [name], save_to=f"{paths.root}/models", features=columns, params=PARAMS))
    timed("evaluate", lambda: jobs.run_evaluate(spark, paths))

    probability = features.select(quoted(TARGET).alias("label"), F.col("value_per_unit_norm").alias("probability"))
    ranked = features.select(*[quoted(c) for c in columns], quoted(TARGET))
    timed("ranking_metrics", lambda: metrics.ranking_metrics(probability).collect())
    timed("threshold_sweep", lambda: metrics.threshold_sweep(probability).collect())
    timed("risk_summary", lambda: risk_summary(metrics.at_threshold(probability)).collect())
    timed("high_correlation", lambda: selection.high_correlation(ranked).collect())
    timed("f_test", lambda: selection.f_test(ranked).collect())
    base = shipments(spark, folder)
    timed("late_rate_by_mode", lambda: base.groupBy(SHIPPING_MODE).agg(F.avg(TARGET)).collect())
    timed("abc_classes", lambda: supply.abc_classes(
        supply.inventory_by_sku(base, "Product Card Id", QUANTITY, SALES)).collect())
    timed("vendor_tiers", lambda: supply.vendor_tiers(supply.vendor_scores(supply.supplier_delivery(
        shipments(spark, folder, ("l_suppkey",)), "l_suppkey", REAL_DAYS, SCHEDULED_DAYS))).collect())

    times.pop("warm_up")
    print(json.dumps({"metric": "pipeline_and_reports", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "rows": lines.count(), "cpus": cpus, "model_params": PARAMS}))
    spark.stop()


if __name__ == "__main__":
    main()
