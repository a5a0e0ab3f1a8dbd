"""Queries on features, splits and feature rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators import features, selection, splitting
from lateline.plans.catalog import cleaned, divided, feature_model, featured, query
from lateline.plans.oracle_views import half_even, over
from lateline.plans.shipments import shipments
from lateline.schema import (CATEGORY, DISCOUNT, ITEM_PRICE, MARKET, NON_FEATURES, ORDER_DATE, ORDER_ID, PRICE,
                             QUANTITY, REAL_DAYS, REGION, SALES, SCHEDULED_DAYS, SEGMENT, SHIP_DATE, SHIPPING_MODE,
                             TARGET)

TEMPORAL = ["order_day_of_week", "order_month", "order_quarter", "is_weekend", "is_month_start", "is_month_end",
            "is_holiday_season", "order_day_of_year"]
#: Integers that are null for an undated order.
_UNDATED = ["order_day_of_week", "order_month", "order_quarter", "order_day_of_year", "order_processing_time"]
SHIPPING = ["scheduled_shipping_days", "shipping_mode_risk", "is_expedited", "shipping_lead_time_variance",
            "shipping_time_ratio", "order_processing_time"]
GEOGRAPHIC = ["market_risk_score", "is_international", "region_order_frequency"]
PRODUCT = ["order_item_value", "is_high_value_order", "discount_category", "has_discount", "segment_order_frequency",
           "is_bulk_order"]
INTERACTION = ["shipping_market_interaction", "expedited_international", "high_risk_period", "scheduled_days_cat",
               "value_per_unit", "value_per_unit_norm", "order_complexity", "market_segment_risk", "day_risk_score",
               "temporal_risk", "overall_risk_score"]


def _sql_columns(names: list[str]) -> str:
    return ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' if c in _UNDATED else f'"{c}"' for c in names)


def _picked(df, names: list[str]):
    return df.select(*[quoted(c).cast("double").alias(c) if c in _UNDATED else quoted(c) for c in names])


@query("late_rate_by_risk_band", over("ship", f"""SELECT CASE "{SHIPPING_MODE}" WHEN 'Same Day' THEN 0.2::DOUBLE
WHEN 'First Class' THEN 0.8::DOUBLE WHEN 'Second Class' THEN 0.5::DOUBLE ELSE 0.6::DOUBLE END AS shipping_mode_risk,
count(*) AS "rows", {half_even(f'avg("{TARGET}")', 6)} AS late_rate FROM ship GROUP BY 1"""))
def _(spark, folder):
    lines = features.shipping_features(shipments(spark, folder).select(quoted(SHIPPING_MODE), quoted(TARGET)))
    return lines.groupBy("shipping_mode_risk").agg(
        F.count(F.lit(1)).alias("rows"), round_half_even(F.avg(TARGET), 6).alias("late_rate"))


@query("f01_f08_temporal", over("feat", f'SELECT "{ORDER_ID}", {_sql_columns(TEMPORAL)} FROM feat'))
def _(spark, folder):
    return _picked(features.temporal_features(cleaned(spark, folder)), [ORDER_ID, *TEMPORAL])


@query("f09_f14_shipping", over("feat", f'SELECT "{ORDER_ID}", {_sql_columns(SHIPPING)} FROM feat'))
def _(spark, folder):
    return _picked(features.shipping_features(cleaned(spark, folder)), [ORDER_ID, *SHIPPING])


@query("f15_f17_geographic", over("feat", f'SELECT "{ORDER_ID}", {_sql_columns(GEOGRAPHIC)} FROM feat'))
def _(spark, folder):
    located = features.geographic_features(cleaned(spark, folder))
    return _picked(feature_model(spark, folder).region_frequency(located), [ORDER_ID, *GEOGRAPHIC])


@query("f18_f23_product", over("feat", f'SELECT "{ORDER_ID}", {_sql_columns(PRODUCT)} FROM feat'))
def _(spark, folder):
    median = feature_model(spark, folder).state.median_value
    return _picked(features.product_features(cleaned(spark, folder), median), [ORDER_ID, *PRODUCT])


@query("f24_f34_interactions", over("feat", f'SELECT "{ORDER_ID}", {_sql_columns(INTERACTION)} FROM feat'))
def _(spark, folder):
    return _picked(featured(spark, folder), [ORDER_ID, *INTERACTION])


_ONE_HOT = {SHIPPING_MODE: ["First Class", "Same Day", "Second Class", "Standard Class"],
            SEGMENT: ["Consumer", "Corporate", "Home Office"]}
_ONE_HOT_NAMES = [f"{c.lower().replace(' ', '_')}_{v}" for c, values in _ONE_HOT.items() for v in values]


@query("f35_one_hot", over("clean", f'SELECT "{ORDER_ID}", ' + ", ".join(
    f"""CAST("{c}" = '{v}' AS INTEGER) AS "{c.lower().replace(' ', '_')}_{v}" """ for c, vs in _ONE_HOT.items() for v in vs)
    + " FROM clean"))
def _(spark, folder):
    return feature_model(spark, folder).one_hot(cleaned(spark, folder)).select(
        ORDER_ID, *[quoted(c) for c in _ONE_HOT_NAMES])


def _codes(column: str, new: str) -> str:
    return f"""{new}_codes AS (SELECT v, row_number() OVER (ORDER BY first, v) - 1 AS code FROM (
SELECT v, min(rn) AS first FROM (SELECT "{column}" AS v, row_number() OVER (ORDER BY "{ORDER_DATE}" NULLS LAST,
"{ORDER_ID}", "{column}") AS rn FROM clean) GROUP BY v))"""


@query("f36_label_codes", over("clean", f"""AND VIEW {_codes(MARKET, 'market')}, {_codes(REGION, 'region')},
{_codes(CATEGORY, 'category')}
SELECT "{ORDER_ID}", m.code AS market_encoded, r.code AS order_region_encoded, c.code AS category_name_encoded
FROM clean JOIN market_codes m ON m.v = "{MARKET}" JOIN region_codes r ON r.v = "{REGION}"
JOIN category_codes c ON c.v = "{CATEGORY}" """))
def _(spark, folder):
    return feature_model(spark, folder).label_codes(cleaned(spark, folder)).select(
        ORDER_ID, "market_encoded", "order_region_encoded", "category_name_encoded")


@query("f37_discount_one_hot", over("feat", f"""SELECT "{ORDER_ID}", CAST(discount_category = 'low' AS INTEGER)
AS discount_low, CAST(discount_category = 'none' AS INTEGER) AS discount_none FROM feat"""))
def _(spark, folder):
    return featured(spark, folder).select(ORDER_ID, "discount_low", "discount_none")


_KEPT = [REAL_DAYS, SCHEDULED_DAYS, "Sales per customer", TARGET, DISCOUNT, ITEM_PRICE, QUANTITY, SALES, PRICE]


@query("f38_f39_feature_table", over("feat", f"""SELECT {_sql_columns([*_KEPT, *TEMPORAL, *SHIPPING, *GEOGRAPHIC,
*[c for c in PRODUCT if c != 'discount_category'], *INTERACTION])} FROM feat"""))
def _(spark, folder):
    builder = features.FeatureBuilder(keep_date_columns=False, drop_original_categoricals=True)
    table, _ = builder.fit_transform(cleaned(spark, folder))
    gone = set(NON_FEATURES) | {ORDER_DATE, SHIP_DATE, "discount_category"}
    if gone & set(table.columns):
        raise ValueError(f"columns not dropped: {gone & set(table.columns)}")
    return _picked(table, [*_KEPT, *TEMPORAL, *SHIPPING, *GEOGRAPHIC,
                           *[c for c in PRODUCT if c != "discount_category"], *INTERACTION])


@query("f39_skip_leaky", over("feat", f'SELECT "{ORDER_ID}", scheduled_shipping_days, shipping_mode_risk, is_expedited FROM feat'))
def _(spark, folder):
    return features.shipping_features(cleaned(spark, folder), skip_leaky=True).select(
        ORDER_ID, *[c for c in SHIPPING if c in ("scheduled_shipping_days", "shipping_mode_risk", "is_expedited")])


@query("f40_feature_names")
def _(spark, folder):
    """Each feature, in order, with the rows that have it."""
    table = features.drop_non_features(featured(spark, folder))
    names = features.feature_names(table, include_target=True)
    known = table.agg(*[F.count(quoted(n)).alias(f"n{i}") for i, n in enumerate(names)])
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature"), F.col(f"n{i}").alias("rows"))
                      for i, n in enumerate(names)])
    return known.select(F.explode(items).alias("f")).select("f.*")


@query("f41_features_and_target", over("clean", f'SELECT "{TARGET}", count(*) AS "rows" FROM clean GROUP BY 1'))
def _(spark, folder):
    _, target = features.features_and_target(featured(spark, folder))
    return target.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))


@query("f42_feature_report")
def _(spark, folder):
    return features.engineer_features(cleaned(spark, folder))[1]


# ---- splits ----

_LINE = [ORDER_DATE, ORDER_ID, "Order Item Id", SALES, SHIP_DATE, "Product Card Id", TARGET]


def _split_sql(order: list[str], tail: str) -> str:
    keys = ", ".join(f'"{c}" NULLS LAST' for c in order)
    return over("ship", f"""AND VIEW numbered AS (SELECT {', '.join(f'"{c}"' for c in _LINE)},
row_number() OVER (ORDER BY {keys}) - 1 AS rn, count(*) OVER () AS total FROM ship),
parted AS (SELECT * EXCLUDE (rn, total), CASE WHEN rn < CAST(floor(total * 0.7::DOUBLE) AS BIGINT) THEN 'train'
WHEN rn < CAST(floor(total * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM numbered)
{tail}""")


def _line(spark, folder):
    return shipments(spark, folder).select(*[quoted(c) for c in _LINE])


@query("t02_time_split", _split_sql(_LINE, "SELECT * FROM parted"))
def _(spark, folder):
    return splitting.time_split(_line(spark, folder))


_ORDERED = [ORDER_ID, "Order Item Id", *[c for c in _LINE if c not in (ORDER_ID, "Order Item Id")]]


@query("t03_row_order_split", _split_sql(_ORDERED, "SELECT * FROM parted"))
def _(spark, folder):
    return splitting.time_split(_line(spark, folder), date_column="absent", order_by=[ORDER_ID, "Order Item Id"])


def _sizes_sql(view: str, train: float, validation: float) -> str:
    first, second = f"CAST(floor(n * {train!r}::DOUBLE) AS BIGINT)", f"CAST(floor(n * ({train!r}::DOUBLE + {validation!r}::DOUBLE)) AS BIGINT)"
    return over(view, f"""AND VIEW k AS (SELECT count(*) AS n FROM {view})
SELECT 'train' AS split, {first} AS "rows" FROM k UNION ALL SELECT 'validation', {second} - {first} FROM k
UNION ALL SELECT 'test', n - {second} FROM k""")


@query("t04_random_split", _sizes_sql("ship", 0.7, 0.15))
def _(spark, folder):
    return splitting.random_split(_line(spark, folder)).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("t06_shuffled_splits", _split_sql(_LINE, "SELECT * FROM parted"))
def _(spark, folder):
    return splitting.split_data(_line(spark, folder), shuffle_within_splits=True)


@query("t07_overlap_check", _split_sql(_LINE, f"""SELECT a.split AS earlier, b.split AS later, a.hi AS earlier_last,
b.lo AS later_first, CAST(a.hi > b.lo AS INTEGER) AS overlaps FROM
(SELECT split, min("{ORDER_DATE}") AS lo, max("{ORDER_DATE}") AS hi FROM parted GROUP BY 1) a,
(SELECT split, min("{ORDER_DATE}") AS lo, max("{ORDER_DATE}") AS hi FROM parted GROUP BY 1) b
WHERE (a.split = 'train' AND b.split = 'validation') OR (a.split = 'validation' AND b.split = 'test')"""))
def _(spark, folder):
    return splitting.overlap_check(splitting.time_split(_line(spark, folder)))


@query("t08_split_summary", _split_sql(_LINE, f"""SELECT split, count(*) AS "rows", min("{ORDER_DATE}") AS first_date,
max("{ORDER_DATE}") AS last_date, {half_even(f'avg("{TARGET}") * 100', 4)} AS late_percent,
{half_even('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM parted)', 4)} AS percent FROM parted GROUP BY 1"""))
def _(spark, folder):
    return splitting.split_summary(splitting.time_split(_line(spark, folder)))


_MATRIX = [SCHEDULED_DAYS, "Sales per customer", DISCOUNT, ITEM_PRICE, QUANTITY, SALES, PRICE, *TEMPORAL,
           "scheduled_shipping_days", "shipping_mode_risk", "is_expedited", *GEOGRAPHIC,
           *[c for c in PRODUCT if c != "discount_category"], *INTERACTION]


@query("t09_model_matrix", over("feat", f'SELECT {_sql_columns([*_MATRIX, TARGET])} FROM feat'))
def _(spark, folder):
    table = splitting.matrix(features.drop_non_features(featured(spark, folder)))
    coded = [c for c in table.columns if c.endswith("_encoded") or c in _ONE_HOT_NAMES or c in ("discount_low", "discount_none")]
    return _picked(table.drop(*coded), [*_MATRIX, TARGET])


@query("t01_t10_split_data", _sizes_sql("ship", 0.6, 0.2))
def _(spark, folder):
    return splitting.split_data(_line(spark, folder), method="random", ratios=(0.6, 0.2, 0.2)).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"))


# ---- rankings ----

RANKED = [SCHEDULED_DAYS, DISCOUNT, QUANTITY, SALES, PRICE, "order_month", "order_day_of_week", "is_weekend",
          "shipping_mode_risk", "is_expedited", "market_risk_score", "region_order_frequency", "order_item_value",
          "is_high_value_order", "scheduled_days_cat", "value_per_unit", "order_complexity", "overall_risk_score"]


def _ranked(spark, folder):
    return featured(spark, folder).select(*[quoted(c) for c in [*RANKED, TARGET]])


def _each(template: str) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in RANKED)


@query("l01_low_variance", over("feat", "AND VIEW v AS (" + _each(
    """SELECT '{c}' AS feature, var_samp(CAST("{c}" AS DOUBLE)) AS variance FROM feat""")
    + f") SELECT feature, {half_even('variance', 9)} AS variance FROM v WHERE variance < 0.01"))
def _(spark, folder):
    return selection.low_variance(_ranked(spark, folder)).withColumn("variance", round_half_even(F.col("variance"), 9))


@query("l02_high_correlation", over("feat", "AND VIEW p AS (" + " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, abs(corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE))) AS r FROM feat"""
    for i, a in enumerate(RANKED) for b in RANKED[i + 1:])
    + f") SELECT feature_1, feature_2, {half_even('r', 4)} AS correlation FROM p WHERE r > 0.6"))
def _(spark, folder):
    return selection.high_correlation(_ranked(spark, folder), threshold=0.6)


@query("l03_forest_importance")
def _(spark, folder):
    return selection.forest_importance(_ranked(spark, folder), n_estimators=10, max_depth=5)


_F_SQL = "AND VIEW c AS (" + _each(f"""SELECT '{{c}}' AS feature, "{TARGET}" AS t, count(*) AS n,
avg(coalesce(CAST("{{c}}" AS DOUBLE), 0)) AS m, var_pop(coalesce(CAST("{{c}}" AS DOUBLE), 0)) AS v FROM feat GROUP BY 2""") + """),
g AS (SELECT feature, sum(n * m) / sum(n) AS grand, sum(n) AS total, count(*) AS k, sum(n * v) AS within FROM c GROUP BY 1),
f AS (SELECT feature, sum(n * (m - grand) * (m - grand)) / any_value(k - 1) /
(any_value(within) / any_value(total - k)) AS f_score FROM c JOIN g USING (feature) GROUP BY 1)"""


@query("l04_f_test", over("feat", _F_SQL + f" SELECT feature, {half_even('f_score', 4)} AS f_score FROM f"))
def _(spark, folder):
    return selection.f_scores(_ranked(spark, folder)).select(
        "feature", round_half_even(F.col("f_score"), 4).alias("f_score"))


@query("l04_f_test_p_values")
def _(spark, folder):
    return selection.f_test(_ranked(spark, folder))


_MI_SQL = "AND VIEW b AS (" + _each(f"""SELECT '{{c}}' AS feature, "{TARGET}" AS label,
len(list_filter(list_distinct((SELECT quantile_cont(coalesce(CAST("{{c}}" AS DOUBLE), 0), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
FROM feat)), lambda e: e < coalesce(CAST("{{c}}" AS DOUBLE), 0))) AS bin FROM feat""") + """),
n AS (SELECT feature, bin, label, count(*)::DOUBLE AS n FROM b GROUP BY ALL),
j AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, label) AS nl,
sum(n) OVER (PARTITION BY feature) AS total FROM n),
mi AS (SELECT feature, greatest(sum(n / total * ln(n * total / (nb * nl))), 0) AS mutual_info FROM j GROUP BY 1)"""


@query("l05_mutual_information", over("feat", _MI_SQL + f" SELECT feature, {half_even('mutual_info', 8)} AS mutual_info FROM mi"))
def _(spark, folder):
    return selection.mutual_information(_ranked(spark, folder)).select(
        "feature", round_half_even(F.col("mutual_info"), 8).alias("mutual_info"))


_CORR_SQL = "AND VIEW r AS (" + _each(f"""SELECT '{{c}}' AS feature, corr(CAST("{{c}}" AS DOUBLE), CAST("{TARGET}" AS DOUBLE))
AS correlation FROM feat""") + ")"


@query("l06_combined_importance", over("feat", _F_SQL + ", " + _MI_SQL[9:] + ", " + _CORR_SQL[9:] + f""",
a AS (SELECT feature, abs(correlation) AS rf_importance, f_score, mutual_info FROM r FULL JOIN f USING (feature)
FULL JOIN mi USING (feature)), s AS (SELECT feature,
(rf_importance - min(rf_importance) OVER ()) / (max(rf_importance) OVER () - min(rf_importance) OVER ()) AS x,
(f_score - min(f_score) OVER ()) / (max(f_score) OVER () - min(f_score) OVER ()) AS y,
(mutual_info - min(mutual_info) OVER ()) / (max(mutual_info) OVER () - min(mutual_info) OVER ()) AS z FROM a)
SELECT feature, {half_even('(x + y + z) / 3', 6)} AS avg_importance FROM s"""))
def _(spark, folder):
    # The forest's scores depend on the engine, so a correlation stands in for them here.
    table = _ranked(spark, folder)
    stand_in = selection.target_correlation(table).select("feature", F.col("abs_correlation").alias("importance"))
    return selection.combine_importance(stand_in, selection.f_scores(table), selection.mutual_information(table)).select(
        "feature", round_half_even(F.col("avg_importance"), 6).alias("avg_importance"))


@query("l06_combined_with_forest")
def _(spark, folder):
    return selection.combined_importance(_ranked(spark, folder), n_estimators=10, max_depth=5)


@query("l07_top_features_f_test", over("feat", _F_SQL + """ SELECT feature, CAST(rank AS INTEGER) AS rank FROM (
SELECT feature, row_number() OVER (ORDER BY f_score DESC, feature) AS rank FROM f) WHERE rank <= 10"""))
def _(spark, folder):
    return selection.top_features(_ranked(spark, folder), 10, "f_test")


@query("l07_top_features_mutual_info", over("feat", _MI_SQL + """ SELECT feature, CAST(rank AS INTEGER) AS rank FROM (
SELECT feature, row_number() OVER (ORDER BY mutual_info DESC, feature) AS rank FROM mi) WHERE rank <= 10"""))
def _(spark, folder):
    return selection.top_features(_ranked(spark, folder), 10, "mutual_info")


@query("l08_target_correlation", over("feat", _CORR_SQL + f""" SELECT feature, {half_even('correlation', 8)} AS correlation,
{half_even('abs(correlation)', 8)} AS abs_correlation FROM r"""))
def _(spark, folder):
    return selection.target_correlation(_ranked(spark, folder)).select("feature", *[
        round_half_even(F.col(c), 8).alias(c) for c in ("correlation", "abs_correlation")])


@query("t_split_of_features", _sizes_sql("clean", 0.7, 0.15))
def _(spark, folder):
    return divided(spark, folder).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
