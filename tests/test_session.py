from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lateline import session
from lateline.operators import metrics, ranks, splitting
from lateline.schema import SPLITS


def test_a_cluster_without_a_shared_folder_is_an_error():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None),
                           sparkContext=SimpleNamespace(master="yarn", applicationId="none"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(bare)


def test_a_job_deletes_what_it_staged(spark):
    with session.job(spark):
        table = session.stage(spark.range(5), "gone")
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 5
        session.together(lambda: session.stage(spark.range(2), "inner"), lambda: None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    kept = session.stage(spark.range(3), "kept")
    assert kept.count() == 3


def test_no_task_sorts_all_distinct_values(spark, monkeypatch):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", 50)
    table = spark.range(20_000).select(F.xxhash64("id").alias("v"))
    counts = ranks.value_counts(table, {"v": F.col("v")})
    totals = ranks.count_totals(counts)
    want = sorted(r.v for r in table.collect())
    found = ranks.values_at(counts, {"v": [0, 9_999, 19_999]}, totals)
    assert [found[("v", k)].value for k in (0, 9_999, 19_999)] == [want[0], want[9_999], want[19_999]]
    bracket = ranks.Bracket("v", [5], 0, 20_000)
    marked = counts.withColumn("b", F.lit(0))
    plan = marked.withColumn("slot", ranks._sampled_slots(marked, [bracket], table.schema["v"].dataType))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Sort [" not in text


def test_cuts_through_copies_with_nested_columns(spark):
    rows = [(1, [k]) for k in range(7)] + [(2, [0])] * 3
    table = spark.createDataFrame(rows, "v int, list array<int>")
    parts = splitting.ordered_split(table, ["v"], (0.5, 0.2, 0.3))
    assert sorted((r.v, r.list) for r in parts.collect()) == sorted(rows)
    sizes = {r[splitting.SPLIT]: r["count"] for r in parts.groupBy(splitting.SPLIT).count().collect()}
    assert [sizes[s] for s in SPLITS] == [5, 2, 3]


def test_null_probabilities_count_nowhere(spark):
    table = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None)], "label int, probability double")
    row = metrics.threshold_sweep(table, [0.5]).first()
    assert row.true_positives + row.false_negatives + row.true_negatives + row.false_positives == 2


def test_evaluation_without_validation_rows(spark, tmp_path, monkeypatch):
    from lateline.plans import jobs

    scored = spark.createDataFrame([("m", 1.0, 0.9, 1), ("m", 0.0, 0.2, 0)], "model string, label double, probability double, prediction int")

    def rows(spark, paths, split, names=()):
        if split == "validation":
            raise FileNotFoundError(split)
        return scored

    monkeypatch.setattr(jobs, "scored_splits", rows)
    found = jobs.run_evaluate(spark, jobs.Paths(str(tmp_path)))
    assert list(found) == ["model_comparison_default_threshold"] and found["model_comparison_default_threshold"].count() == 1
