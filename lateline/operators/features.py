"""Feature columns of order lines, with learned medians, frequencies and codes."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions.expressions import (clip, flag, lookup, mean_of_known, per_nonzero, quoted,
                                            ratio, right_closed_bins, strip, text_or_nan, title)
from lateline.operators.ranks import exact_percentiles, with_running_totals
from lateline.schema import (CATEGORY, DATE_COLUMNS, DISCOUNT, EXPEDITED, ITEM_PRICE, MARKET, MARKET_RISK,
                             MODE_RISK, NON_FEATURES, ORDER_DATE, ORDER_ID, QUANTITY, REAL_DAYS, REGION,
                             SALES, SCHEDULED_DAYS, SEGMENT, SEGMENT_FREQUENCY, SHIP_DATE, SHIPPING_MODE,
                             TARGET, WEEKDAY_RISK)
from lateline.session import stage, together

ONE_HOT = [SHIPPING_MODE, SEGMENT]
LABELLED = [MARKET, REGION, CATEGORY]
BAND = "discount_category"
#: Lookup tables up to this size become literals; larger ones are joined as the session sees fit.
LITERAL_ROWS = 200


@dataclass
class FeatureOptions:
    create_temporal: bool = True
    create_shipping: bool = True
    create_geographic: bool = True
    create_product: bool = True
    encode_categorical: bool = True
    drop_original_categoricals: bool = False
    keep_date_columns: bool = True
    skip_leaky_features: bool = False
    drop_non_features: bool = True
    #: More values than this in a one-hot column are an error; None sets no limit.
    one_hot_limit: int | None = None
    #: Columns whose order decides which category appears first.
    appearance: list[str] = field(default_factory=lambda: [ORDER_DATE, ORDER_ID])


def temporal_features(df: DataFrame) -> DataFrame:
    if ORDER_DATE not in df.columns:
        return df
    date = quoted(ORDER_DATE)
    return df.withColumns({
        "order_day_of_week": F.weekday(date),
        "order_month": F.month(date),
        "order_quarter": F.quarter(date),
        "is_weekend": flag(F.weekday(date) >= 5),
        "is_month_start": flag(F.dayofmonth(date) <= 5),
        "is_month_end": flag(F.dayofmonth(date) >= 26),
        "is_holiday_season": flag(F.month(date).isin(11, 12)),
        "order_day_of_year": F.dayofyear(date),
    })


def shipping_features(df: DataFrame, skip_leaky: bool = False) -> DataFrame:
    has, new = set(df.columns), {}
    if SCHEDULED_DAYS in has:
        new["scheduled_shipping_days"] = quoted(SCHEDULED_DAYS)
    if SHIPPING_MODE in has:
        mode = title(strip(text_or_nan(quoted(SHIPPING_MODE))))
        new["shipping_mode_risk"] = lookup(mode, MODE_RISK, 0.5)
        new["is_expedited"] = flag(mode.isin(EXPEDITED))
    if not skip_leaky:
        if {REAL_DAYS, SCHEDULED_DAYS} <= has:
            new["shipping_lead_time_variance"] = quoted(REAL_DAYS) - quoted(SCHEDULED_DAYS)
            new["shipping_time_ratio"] = per_nonzero(quoted(REAL_DAYS), quoted(SCHEDULED_DAYS))
        if {ORDER_DATE, SHIP_DATE} <= has:
            ordered, shipped = quoted(ORDER_DATE), quoted(SHIP_DATE)
            days = F.timestamp_diff("DAY", ordered, shipped)
            new["order_processing_time"] = F.when(days.isNotNull(), F.greatest(days, F.lit(0)))
    return df.withColumns(new) if new else df


def geographic_features(df: DataFrame) -> DataFrame:
    """The fixed part; the region frequency is a learned lookup."""
    if MARKET not in df.columns:
        return df
    market = F.upper(strip(text_or_nan(quoted(MARKET))))
    return df.withColumns({
        "market_risk_score": lookup(market, MARKET_RISK, 0.5),
        "is_international": flag(market != "USCA"),
    })


def item_value() -> Column:
    return quoted(ITEM_PRICE) * quoted(QUANTITY)


def value_per_unit() -> Column:
    return per_nonzero(quoted(SALES), quoted(QUANTITY))


def discount_band() -> Column:
    return right_closed_bins(quoted(DISCOUNT), [-0.01, 0.0, 0.1, 0.2, 1.0], ["none", "low", "medium", "high"])


def product_features(df: DataFrame, median_value: float | None) -> DataFrame:
    has, new = set(df.columns), {}
    if {ITEM_PRICE, QUANTITY} <= has:
        new["order_item_value"] = item_value()
        new["is_high_value_order"] = flag(item_value() > F.lit(median_value).cast("double"))
    if DISCOUNT in has:
        new[BAND] = discount_band()
        new["has_discount"] = flag(quoted(DISCOUNT) > 0)
    if SEGMENT in has:
        new["segment_order_frequency"] = lookup(title(strip(text_or_nan(quoted(SEGMENT)))), SEGMENT_FREQUENCY, 0.5)
    if QUANTITY in has:
        new["is_bulk_order"] = flag(quoted(QUANTITY) > 5)
    return df.withColumns(new) if new else df


def interaction_features(df: DataFrame, unit_value_q99: float | None) -> DataFrame:
    """Products and averages of the features that are present."""
    has, new = set(df.columns), {}
    mode, market = F.col("shipping_mode_risk"), F.col("market_risk_score")
    if {"shipping_mode_risk", "market_risk_score"} <= has:
        new["shipping_market_interaction"] = mode * market
    if {"is_expedited", "is_international"} <= has:
        new["expedited_international"] = F.col("is_expedited") * F.col("is_international")
    period = None
    if {"is_weekend", "is_holiday_season"} <= has:
        period = flag((F.col("is_weekend") == 1) | (F.col("is_holiday_season") == 1))
        new["high_risk_period"] = period
    if SCHEDULED_DAYS in has:
        new["scheduled_days_cat"] = F.coalesce(
            right_closed_bins(quoted(SCHEDULED_DAYS), [-1, 2, 4, 6, 100], [0.0, 1.0, 2.0, 3.0]), F.lit(1.0))
    if {SALES, QUANTITY} <= has:
        top = F.lit(unit_value_q99).cast("double")
        new["value_per_unit"] = value_per_unit()
        new["value_per_unit_norm"] = ratio(clip(value_per_unit(), None, unit_value_q99), top)
    parts = [F.col(c) for c in ("is_high_value_order", "is_bulk_order", "is_expedited") if c in has]
    if parts:
        new["order_complexity"] = sum(parts[1:], parts[0])
    if {"market_risk_score", "segment_order_frequency"} <= has:
        new["market_segment_risk"] = market * (1 - F.col("segment_order_frequency"))
    temporal = None
    if "order_day_of_week" in has:
        day = lookup(F.col("order_day_of_week"), WEEKDAY_RISK, 0.5)
        new["day_risk_score"] = day
        if period is not None:
            temporal = day * 0.5 + period * 0.5
            new["temporal_risk"] = temporal
    known = [c for c, present in ((mode, "shipping_mode_risk" in has), (market, "market_risk_score" in has),
                                  (temporal, temporal is not None)) if present]
    if known:
        new["overall_risk_score"] = mean_of_known(known)
    return df.withColumns(new) if new else df


@dataclass
class FeatureState:
    """Learned numbers, small category tables, and the frame that holds every category."""

    rows: int = 0
    median_value: float | None = None
    unit_value_q99: float | None = None
    sizes: dict[str, int] = field(default_factory=dict)
    small: dict[str, list[list]] = field(default_factory=dict)


@dataclass
class FeatureModel:
    state: FeatureState
    options: FeatureOptions
    #: (name, value, n, code) rows for the columns that were grouped.
    categories: DataFrame | None = None

    def _attach(self, df: DataFrame, name: str, column: str, field_index: int, new: str, key: Column) -> DataFrame:
        """Add ``new``, looked up by ``key`` in the learned table of ``name``."""
        if name in self.state.small:
            table = {entry[0]: entry[field_index] for entry in self.state.small[name] if entry[0] is not None}
            pairs = [F.lit(part) for item in table.items() for part in item]
            value = F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None)
            return df.withColumn(new, value)
        learned = (self.categories.filter(F.col("name") == name)
                   .select(F.col("value").alias("_key"), F.col(column).alias(new)))
        return df.withColumn("_k", key).join(learned, F.col("_k") == F.col("_key"), "left").drop("_k", "_key")

    def region_frequency(self, df: DataFrame) -> DataFrame:
        """Share of learned rows in the region; null for a null or unseen region."""
        df = self._attach(df, "region_rows", "n", 1, "_region_rows", quoted(REGION))
        return df.withColumn("region_order_frequency",
                             ratio(F.col("_region_rows"), F.lit(self.state.rows))).drop("_region_rows")

    def one_hot(self, df: DataFrame) -> DataFrame:
        new = {}
        for c in ONE_HOT:
            if c in df.columns and c in self.state.small:
                prefix = c.lower().replace(" ", "_")
                for value in sorted(entry[0] for entry in self.state.small[c]):
                    new[f"{prefix}_{value}"] = (text_or_nan(quoted(c)) == value).cast("int")
        return df.withColumns(new) if new else df

    def label_codes(self, df: DataFrame) -> DataFrame:
        """Codes in order of first appearance; -1 for a value never seen in fitting."""
        for c in LABELLED:
            if c in df.columns:
                new = f"{c.lower().replace(' ', '_')}_encoded"
                df = self._attach(df, c, "code", 2, new, text_or_nan(quoted(c)))
                df = df.withColumn(new, F.coalesce(F.col(new), F.lit(-1)).cast("long"))
        return df

    def discount_one_hot(self, df: DataFrame) -> DataFrame:
        if BAND not in df.columns or BAND not in self.state.small:
            return df
        return df.withColumns({f"discount_{value}": (text_or_nan(F.col(BAND)) == value).cast("int")
                               for value in sorted(entry[0] for entry in self.state.small[BAND])})

    def transform(self, df: DataFrame) -> DataFrame:
        o = self.options
        if o.create_temporal:
            df = temporal_features(df)
        if o.create_shipping:
            df = shipping_features(df, o.skip_leaky_features)
        if o.create_geographic:
            df = geographic_features(df)
            if REGION in df.columns:
                df = self.region_frequency(df)
        if o.create_product:
            df = product_features(df, self.state.median_value)
        df = interaction_features(df, self.state.unit_value_q99)
        if o.encode_categorical:
            df = self.discount_one_hot(self.label_codes(self.one_hot(df)))
            if o.drop_original_categoricals:
                df = df.drop(*ONE_HOT, *LABELLED, BAND)
        return drop_non_features(df, o.keep_date_columns) if o.drop_non_features else df

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"state": asdict(self.state), "options": asdict(self.options)})
        spark.createDataFrame([(text,)], "state string").coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
        if self.categories is not None:
            self.categories.write.mode("overwrite").parquet(f"{path}/categories")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        text = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        state = FeatureState(**text["state"])
        categories = spark.read.parquet(f"{path}/categories") if state.sizes else None
        return FeatureModel(state, FeatureOptions(**text["options"]), categories)


class FeatureBuilder:
    """Estimator of a ``FeatureModel``."""

    def __init__(self, **options) -> None:
        self.options = FeatureOptions(**options)

    def fit(self, df: DataFrame, approx: bool = False) -> FeatureModel:
        o, has = self.options, set(df.columns)
        state = FeatureState()
        numbers = {}
        if o.create_product and {ITEM_PRICE, QUANTITY} <= has:
            numbers["median_value"] = (item_value(), [0.5])
        if {SALES, QUANTITY} <= has:
            numbers["unit_value_q99"] = (value_per_unit(), [0.99])
        grouped: dict[str, Column] = {}
        if o.create_geographic and REGION in has:
            grouped["region_rows"] = quoted(REGION)
        if o.encode_categorical:
            grouped.update({c: text_or_nan(quoted(c)) for c in [*ONE_HOT, *LABELLED] if c in has})
            if o.create_product and DISCOUNT in has:
                grouped[BAND] = text_or_nan(discount_band())
        tasks = [lambda: exact_percentiles(df, numbers, approx)] if numbers else []
        done = together(*tasks, *([lambda: self._categories(df, grouped)] if grouped else []))
        if numbers:
            state.median_value = done[0].get("median_value", [None])[0]
            state.unit_value_q99 = done[0].get("unit_value_q99", [None])[0]
        if not grouped:
            return FeatureModel(state, o)
        categories = done[-1]
        for row in categories.groupBy("name").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("rows")).collect():
            state.sizes[row["name"]] = row["size"]
            state.rows = row["rows"]
        self._check_width(state.sizes, o.one_hot_limit)
        small = [name for name, size in state.sizes.items() if size <= LITERAL_ROWS or name in (*ONE_HOT, BAND)]
        for row in categories.filter(F.col("name").isin(small)).orderBy("name", "code").collect():
            state.small.setdefault(row["name"], []).append([row["value"], row["n"], row["code"]])
        return FeatureModel(state, o, categories)

    def _categories(self, df: DataFrame, grouped: Mapping[str, Column]) -> DataFrame:
        keys = [c for c in self.options.appearance if c in df.columns]
        first = F.struct(*[part for i, c in enumerate(keys)
                           for part in (quoted(c).isNull().alias(f"gap{i}"), quoted(c).alias(f"key{i}"))],
                         F.lit(0).alias("end"))
        long = (df.select(first.alias("first"), *[column.alias(name) for name, column in grouped.items()])
                .unpivot(["first"], [quoted(name) for name in grouped], "name", "value"))
        counts = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
        counts = stage(counts, "counts")
        coded = with_running_totals(counts, [F.col("first"), F.col("value")], {"code": F.lit(1)}, by=["name"], staged=True)
        return stage(coded.select("name", "value", "n", (F.col("code") - 1).alias("code")), "categories")

    @staticmethod
    def _check_width(sizes: Mapping[str, int], limit: int | None) -> None:
        for c in (*ONE_HOT, BAND):
            if limit is not None and sizes.get(c, 0) > limit:
                raise ValueError(f"{c!r} has {sizes[c]:,} values, too many for one column each")

    def fit_transform(self, df: DataFrame) -> tuple[DataFrame, FeatureModel]:
        model = self.fit(df)
        return model.transform(df), model


def engineer_features(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Feature table and its report."""
    features, _ = FeatureBuilder(**options).fit_transform(df)
    return features, feature_report(df, features)


def feature_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(feature, action) rows for created and dropped columns."""
    rows = [(c, "created") for c in after.columns if c not in before.columns and c != "value_per_unit"]
    rows += [(c, "dropped") for c in before.columns if c not in after.columns]
    return before.sparkSession.createDataFrame(rows, "feature string, action string")


def drop_non_features(df: DataFrame, keep_date_columns: bool = True) -> DataFrame:
    extra: Sequence[str] = [] if keep_date_columns else DATE_COLUMNS
    return df.drop(*[c for c in [*NON_FEATURES, *extra] if c in df.columns])


def feature_names(df: DataFrame, include_target: bool = False) -> list[str]:
    """Columns except the target, which comes last when asked for."""
    names = [c for c in df.columns if c != TARGET]
    return names + [TARGET] if include_target and TARGET in df.columns else names


def features_and_target(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    if TARGET not in df.columns:
        raise ValueError(f"target column {TARGET!r} not found")
    return df.drop(TARGET), df.select(quoted(TARGET))
