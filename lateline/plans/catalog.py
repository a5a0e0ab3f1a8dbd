"""Registry of queries over the star-schema tables, with their SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lateline.operators.cleaning import Cleaner
from lateline.operators.features import FeatureBuilder
from lateline.operators.splitting import time_split
from lateline.plans.shipments import raw_shipments
from lateline.session import job, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_derived: dict[tuple[str, str, str], object] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return register


def derived(spark: SparkSession, folder: str, name: str, build: Callable[[], object]):
    """Something computed once per application and table folder, shared by several queries."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _derived:
        _derived[key] = build()
    return _derived[key]


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    def build():
        # The different rows that the cleaner writes on its way are not read again.
        with job(spark):
            table, model = Cleaner().fit_transform(raw_shipments(spark, folder))
            return stage(table, "cleaned", lasting=True), model
    return derived(spark, folder, "cleaned", build)[0]


def cleaner_model(spark: SparkSession, folder: str):
    cleaned(spark, folder)
    return _derived[(spark.sparkContext.applicationId, folder, "cleaned")][1]


def feature_model(spark: SparkSession, folder: str):
    return derived(spark, folder, "feature_model", lambda: FeatureBuilder(drop_non_features=False).fit(
        cleaned(spark, folder)))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned columns and every feature."""
    return derived(spark, folder, "featured", lambda: stage(
        feature_model(spark, folder).transform(cleaned(spark, folder)), "featured"))


def divided(spark: SparkSession, folder: str) -> DataFrame:
    """Features with their split."""
    return derived(spark, folder, "divided", lambda: stage(
        time_split(featured(spark, folder)), "divided"))


def load_all() -> None:
    """Import every module that registers queries."""
    from lateline.plans import (catalog_data, catalog_features, catalog_further, catalog_models,  # noqa: F401
                                catalog_scores)
