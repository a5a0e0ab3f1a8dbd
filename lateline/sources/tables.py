"""Tables a job leaves behind: splits, predictions, metrics and its report."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.operators.splitting import SPLIT, split_summary
from lateline.schema import SPLITS


def write_splits(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Rows partitioned by split, and their summary beside them. CSV keeps its column types in a file of their own."""
    writer = df.write.mode("overwrite").partitionBy(SPLIT)
    if form == "csv":
        writer = writer.options(header=True, escape='"')
        kinds = df.sparkSession.createDataFrame([(df.schema.json(),)], "schema string")
        kinds.coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    writer.format(form).save(f"{path}/rows")
    split_summary(read_splits(df.sparkSession, path, ()) if form == "parquet" else df).write.mode("overwrite").parquet(
        f"{path}/summary")


def read_splits(spark: SparkSession, path: str, required: Sequence[str] = SPLITS) -> DataFrame:
    """Written rows, Parquet or CSV; every required split must be there. Filters on ``split`` prune folders."""
    try:
        kinds = spark.read.parquet(f"{path}/schema").first()["schema"]
    except AnalysisException:
        kinds = None
    try:
        if kinds:
            schema = T.StructType.fromJson(json.loads(kinds))
            df = spark.read.options(header=True, escape='"', multiLine=True).schema(schema).csv(f"{path}/rows")
        else:
            df = spark.read.parquet(f"{path}/rows")
    except AnalysisException as problem:
        raise FileNotFoundError(f"no splits in {path}") from problem
    missing = [s for s in required if df.filter(F.col(SPLIT) == s).isEmpty()]
    if missing:
        raise FileNotFoundError(f"splits missing in {path}: {missing}")
    return df


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Predictions or metrics, as Parquet or as CSV with a header."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if form == "csv" else writer).format(form).save(path)


def stage_report(spark: SparkSession, stages: dict[str, dict[str, object]]) -> DataFrame:
    """(stage, key, value) rows of a finished job."""
    rows = [(stage, key, str(value)) for stage, entries in stages.items() for key, value in entries.items()]
    return spark.createDataFrame(rows, "stage string, key string, value string")
