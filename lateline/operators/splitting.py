"""Exact-size splits by time, by row order and by seeded shuffle."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators.ranks import find_cuts, label_by_cuts
from lateline.schema import DATE_COLUMNS, LEAKY, ORDER_DATE, SEED, SPLIT_RATIOS, SPLITS, TARGET
from lateline.session import stage

logger = logging.getLogger(__name__)
SPLIT = "split"
_UNORDERED = (T.MapType, T.VariantType)


def check_ratios(train: float, validation: float, test: float) -> None:
    if abs(train + validation + test - 1.0) > 0.01:
        raise ValueError(f"split ratios must sum to 1, got {train + validation + test:.3f}")


def _sortable(df: DataFrame, first: Sequence[str]) -> list[str]:
    rest = [f.name for f in df.schema.fields
            if f.name not in first and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, _UNORDERED)]
    return [*first, *rest]


def ordered_split(df: DataFrame, order_by: Sequence[str], ratios: Sequence[float] = SPLIT_RATIOS,
                  column: str = SPLIT) -> DataFrame:
    """Label rows by their place in the order; every other column breaks ties.

    No row is sorted: the places of the cuts are searched by counting, then each
    row is compared with the boundary values.
    """
    check_ratios(*ratios)
    rows = df.count()
    positions = [int(rows * ratios[0]), int(rows * (ratios[0] + ratios[1]))]
    cuts = find_cuts(df, _sortable(df, order_by), positions)
    return label_by_cuts(df, cuts, SPLITS, column)


def time_split(df: DataFrame, date_column: str = ORDER_DATE, order_by: Sequence[str] = (),
               ratios: Sequence[float] = SPLIT_RATIOS, column: str = SPLIT) -> DataFrame:
    """Earliest rows train, the next validate, the last test; undated rows come last."""
    check_ratios(*ratios)
    if date_column not in df.columns:
        logger.warning("no date column %r, splitting by row order", date_column)
        return row_order_split(df, order_by, ratios, column)
    if isinstance(df.schema[date_column].dataType, T.StringType):
        df = df.withColumn(date_column, F.try_to_timestamp(quoted(date_column)))
    # Days are few whatever the resolution of the clock; only the boundary day is looked at closer.
    daily = df.withColumn("_day", quoted(date_column).cast("date"))
    return ordered_split(daily, ["_day", date_column, *order_by], ratios, column).drop("_day")


def row_order_split(df: DataFrame, order_by: Sequence[str] = (), ratios: Sequence[float] = SPLIT_RATIOS,
                    column: str = SPLIT) -> DataFrame:
    """Split by the given order, or by the order in which the rows are stored."""
    if order_by:
        return ordered_split(df, order_by, ratios, column)
    numbered = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    return ordered_split(numbered, ["_row"], ratios, column).drop("_row")


def random_split(df: DataFrame, seed: int = SEED, ratios: Sequence[float] = SPLIT_RATIOS,
                 column: str = SPLIT) -> DataFrame:
    """Exact sizes in the order of a seeded hash of the whole row."""
    mixed = df.withColumn("_mixed", F.xxhash64(F.lit(seed), *[quoted(c) for c in _sortable(df, [])]))
    # 65,536 leading values of the hash place the cuts; the full hash orders one of them.
    mixed = mixed.withColumn("_leading", F.shiftright("_mixed", 48))
    return ordered_split(mixed, ["_leading", "_mixed"], ratios, column).drop("_leading", "_mixed")


def split_data(df: DataFrame, method: str = "time", shuffle_within_splits: bool = False, seed: int = SEED,
               date_column: str = ORDER_DATE, order_by: Sequence[str] = (),
               ratios: Sequence[float] = SPLIT_RATIOS) -> DataFrame:
    if method == "time":
        result = time_split(df, date_column, order_by, ratios)
    elif method == "random":
        result = random_split(df, seed, ratios)
    else:
        raise ValueError(f"unknown split method {method!r}")
    return shuffled(result, seed) if shuffle_within_splits else result


def shuffled(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows of each split in a seeded order."""
    mixed = F.xxhash64(F.lit(seed), *[quoted(c) for c in _sortable(df, [])])
    return df.orderBy(SPLIT, mixed) if SPLIT in df.columns else df.orderBy(mixed)


def split_summary(df: DataFrame, date_column: str = ORDER_DATE, column: str = SPLIT) -> DataFrame:
    """Rows, percent, date range and late percent of each split."""
    aggregates: dict[str, Column] = {"rows": F.count(F.lit(1))}
    if date_column in df.columns:
        aggregates["first_date"] = F.min(quoted(date_column))
        aggregates["last_date"] = F.max(quoted(date_column))
    if TARGET in df.columns:
        aggregates["late_percent"] = round_half_even(F.avg(quoted(TARGET)) * 100, 4)
    grouped = df.groupBy(column).agg(*[a.alias(n) for n, a in aggregates.items()])
    # At most three rows: one per split.
    collected = grouped.groupBy().agg(F.sum("rows").alias("total"), F.collect_list(F.struct("*")).alias("splits"))
    return (collected.select("total", F.explode("splits").alias("s"))
            .select("s.*", round_half_even(F.col("s.rows") * 100.0 / F.col("total"), 4).alias("percent")))


def overlap_check(df: DataFrame, date_column: str = ORDER_DATE, column: str = SPLIT) -> DataFrame:
    """Whether an earlier split reaches past the start of a later one; equal dates pass."""
    spans = df.groupBy(F.lit(1).alias("all")).pivot(column, list(SPLITS)).agg(
        F.min(quoted(date_column)).alias("first"), F.max(quoted(date_column)).alias("last"))
    pairs = F.array(*[
        F.struct(F.lit(left).alias("earlier"), F.lit(right).alias("later"),
                 F.col(f"{left}_last").alias("earlier_last"), F.col(f"{right}_first").alias("later_first"),
                 F.coalesce(F.col(f"{left}_last") > F.col(f"{right}_first"), F.lit(False)).cast("int").alias("overlaps"))
        for left, right in zip(SPLITS, SPLITS[1:])])
    return spans.select(F.explode(pairs).alias("p")).select("p.*")


def model_columns(df: DataFrame, target: str = TARGET, drop_date_columns: bool = True,
                  remove_leaky_features: bool = True) -> list[str]:
    """Numeric columns a model may use."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    out = {target, SPLIT}
    if drop_date_columns:
        out |= set(DATE_COLUMNS)
    if remove_leaky_features:
        out |= set(LEAKY)
    return [f.name for f in df.schema.fields if f.name not in out and isinstance(f.dataType, T.NumericType)]


def matrix(df: DataFrame, target: str = TARGET, keep: Sequence[str] = (), **options) -> DataFrame:
    """Model columns and the target, with any other columns named in ``keep``."""
    columns = model_columns(df, target, **options)
    return df.select(*[quoted(c) for c in [*columns, target, *keep]])
