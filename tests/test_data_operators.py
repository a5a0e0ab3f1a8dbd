from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.operators import cleaning, features, quality, splitting
from lateline.schema import (DISCOUNT, MARKET, ORDER_DATE, ORDER_ID, REAL_DAYS, REGION, SALES, SCHEDULED_DAYS,
                             SHIP_DATE, SHIPPING_MODE, TARGET)
from lateline.sources import csv, profile, tables
from tests.conftest import SCHEMA


def severities(report):
    return {(r["check"], r["column"]): r["severity"] for r in report.collect()}


# ---- quality ----

def test_clean_table_is_valid(order_lines):
    result = quality.validate(order_lines)
    assert result.is_valid
    assert severities(result.report)[("row_count", None)] == "ok"


def test_empty_table_is_an_error(spark):
    empty = spark.createDataFrame([], SCHEMA)
    result = quality.validate(empty)
    assert not result.is_valid
    assert severities(result.report)[("row_count", None)] == "error"


def test_missing_columns_and_target(spark):
    result = quality.validate(spark.createDataFrame([("a", 1.0)], "`Order Id` string, Sales double"))
    found = severities(result.report)
    assert found[("required_columns", None)] == "error" and found[("target_missing", TARGET)] == "error"
    assert found[("row_count", None)] == "warning"


def test_invalid_target_values_and_nulls(spark):
    df = spark.createDataFrame([(0,), (2,), (-1,), (None,)], f"{TARGET} int")
    rows = {r["check"]: r["rows"] for r in quality.target_check(df).collect()}
    assert rows == {"target_nulls": 1, "target_values": 2}


@pytest.mark.parametrize("late,severity,word", [(5, "warning", "severe"), (20, "warning", "moderate"), (45, "ok", "balanced")])
def test_class_balance(spark, late, severity, word):
    df = spark.range(100).select((F.col("id") < late).cast("int").alias(TARGET))
    row = quality.balance_check(df).first()
    assert row["severity"] == severity and word in row["message"]


def test_negative_value_warns_twice_and_quote_in_names(spark):
    df = spark.createDataFrame([(-5.0, 1)], f"{SALES} double, `it's``odd` int")
    found = severities(quality.range_check(df))
    assert found[("below_minimum", SALES)] == "warning" and found[("negative", SALES)] == "warning"
    assert quality.missing_check(df).count() == 2


def test_ship_before_order_and_text_dates(spark, order_lines):
    early = order_lines.withColumn(SHIP_DATE, F.when(
        quoted(ORDER_ID) == "ln-0000", quoted(ORDER_DATE) - F.expr("interval 5 days")).otherwise(quoted(SHIP_DATE)))
    assert {r["check"]: r["rows"] for r in quality.consistency_check(early).collect()}["shipped_before_ordered"] == 1
    text = order_lines.withColumn(ORDER_DATE, quoted(ORDER_DATE).cast("string"))
    assert severities(quality.date_check(text))[("date_type", ORDER_DATE)] == "warning"


# ---- cleaning ----

def test_duplicates_collapse_and_are_counted(spark):
    rows = [(1, 0, 2.0, "a"), (1, 0, 2.0, "a"), (2, 1, 3.0, "b"), (2, 1, 3.0, "b"), (3, 0, None, "c"), (3, 0, None, "c"),
            (4, 1, 1.0, "d"), (5, 0, 1.0, "e")]
    df = spark.createDataFrame(rows, f"`{ORDER_ID}` int, {TARGET} int, `{REAL_DAYS}` double, `{SHIPPING_MODE}` string")
    table, model = cleaning.Cleaner().fit_transform(df)
    assert table.count() == 5 and model.state.initial_rows - model.state.distinct_rows == 3


def test_copies_that_differ_in_dropped_ids_collapse(spark):
    df = spark.createDataFrame([(1, 0, "x"), (1, 0, "y")], f"`{ORDER_ID}` int, {TARGET} int, `Customer Email` string")
    assert cleaning.clean(df)[0].count() == 1


def test_critical_nulls_are_counted_in_order(spark):
    df = spark.createDataFrame([(1, 0), (None, None), (None, 1), (2, None), (3, None)], f"`{ORDER_ID}` int, {TARGET} int")
    _, model = cleaning.Cleaner().fit_transform(df)
    assert model.state.critical == {TARGET: 3, ORDER_ID: 1} and model.state.final_rows == 1


def test_mode_tie_takes_the_smallest_and_all_null_is_unknown(spark):
    df = spark.createDataFrame([(1, 0, "b", None), (2, 0, "a", None), (3, 0, None, None)],
                               f"`{ORDER_ID}` int, {TARGET} int, {MARKET} string, `{REGION}` string")
    table, _ = cleaning.Cleaner().fit_transform(df)
    assert {r[MARKET] for r in table.collect() if r[ORDER_ID] == 3} == {"A"}
    assert {r[REGION] for r in table.collect()} == {"Unknown"}


@pytest.mark.parametrize("rule", ["median", "mean", "zero", "mode", "something else"])
def test_fill_and_winsorise_match_pandas(spark, rule):
    rng = np.random.default_rng(7)
    values = [None if i % 6 == 0 else float(np.round(rng.lognormal(1, 1.5), 1)) for i in range(300)]
    df = spark.createDataFrame([(i, i % 2, v) for i, v in enumerate(values)], f"`{ORDER_ID}` int, {TARGET} int, {SALES} double")
    got = cleaning.Cleaner(numeric_fill={SALES: rule}, winsor={SALES: (0.05, 0.9)}).fit_transform(df)[0].toPandas()
    s = pd.Series(values, dtype=float)
    fill = {"mean": s.mean(), "zero": 0.0, "mode": s.mode().iloc[0]}.get(rule, s.median())
    s = s.fillna(fill)
    expected = s.clip(s.quantile(0.05), s.quantile(0.9))
    np.testing.assert_allclose(got.sort_values(ORDER_ID)[SALES].to_numpy(), expected.to_numpy(), rtol=1e-12)


def test_messy_categories_merge(spark):
    df = spark.createDataFrame([(1, 0, " standard class"), (2, 1, "STANDARD CLASS "), (3, 0, "Same-Day"), (4, 0, "LATAM")],
                               f"`{ORDER_ID}` int, {TARGET} int, `{SHIPPING_MODE}` string")
    table, model = cleaning.Cleaner().fit_transform(df)
    assert {r[SHIPPING_MODE] for r in table.collect()} == {"Standard Class", "Same-Day", "Latam"}
    assert model.state.merged[SHIPPING_MODE] == (4, 3)


def test_toggles_leave_columns_and_gaps(spark):
    df = spark.createDataFrame([(1, 0, "e", None), (1, 0, "e", None)],
                               f"`{ORDER_ID}` int, {TARGET} int, `Customer Email` string, {SALES} double")
    options = dict(remove_duplicates=False, handle_missing=False, handle_outliers=False,
                   standardize_categories=False, drop_unused=False)
    table, _ = cleaning.Cleaner(**options).fit_transform(df)
    assert table.count() == 2 and "Customer Email" in table.columns and table.first()[SALES] is None


def test_types_are_repaired(spark):
    df = spark.createDataFrame([("1", "x", "1/31/2018 22:56"), ("0", "2.5", "bad")],
                               f"{TARGET} string, `{REAL_DAYS}` string, `{ORDER_DATE}` string")
    rows = cleaning.fix_types(df).collect()
    assert [r[TARGET] for r in rows] == [1, 0] and [r[REAL_DAYS] for r in rows] == [None, 2.5]
    assert rows[0][ORDER_DATE] == dt.datetime(2018, 1, 31, 22, 56) and rows[1][ORDER_DATE] is None


def test_cleaner_round_trip(spark, order_lines, tmp_path):
    table, model = cleaning.Cleaner().fit_transform(order_lines)
    model.save(spark, str(tmp_path / "cleaner"))
    again = cleaning.CleanerModel.load(spark, str(tmp_path / "cleaner")).transform(order_lines)
    assert again.exceptAll(table).isEmpty() and table.exceptAll(again).isEmpty()


# ---- features ----

def test_processing_time_counts_whole_days(spark):
    late = dt.datetime(2020, 1, 1, 23)
    df = spark.createDataFrame([(late, late + dt.timedelta(hours=2)), (late, late + dt.timedelta(hours=50)),
                                (late, late - dt.timedelta(days=3)), (None, late)],
                               f"`{ORDER_DATE}` timestamp_ntz, `{SHIP_DATE}` timestamp_ntz")
    days = [r["order_processing_time"] for r in features.shipping_features(df).collect()]
    assert days == [0, 2, 0, None]


def test_null_inputs(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               f"`{ORDER_DATE}` timestamp_ntz, {MARKET} string, `{DISCOUNT}` double,"
                               f"`{SCHEDULED_DAYS}` double, `{SHIPPING_MODE}` string")
    row = features.FeatureBuilder(drop_non_features=False).fit_transform(df)[0].first()
    assert row["is_weekend"] == 0 and row["is_month_start"] == 0 and row["is_international"] == 1
    assert row["scheduled_days_cat"] == 1.0 and row["shipping_mode_risk"] == 0.5 and row["market_risk_score"] == 0.5
    assert row["discount_category"] is None and row["discount_nan"] == 1 and row["shipping_mode_nan"] == 1
    assert row["market_encoded"] == 0 and row["overall_risk_score"] == pytest.approx((0.5 + 0.5 + 0.25) / 3)


@pytest.mark.parametrize("days,label", [(-1, 1.0), (2, 0.0), (3, 1.0), (4, 1.0), (6, 2.0), (100, 3.0), (101, 1.0)])
def test_scheduled_bins(spark, days, label):
    df = spark.createDataFrame([(days,)], f"`{SCHEDULED_DAYS}` int")
    assert features.interaction_features(df, None).first()["scheduled_days_cat"] == label


def test_codes_follow_first_appearance(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [(day + dt.timedelta(days=2), 1, "a"), (day, 2, "z"), (day, 3, "m"), (None, 0, "n"), (day, 9, "z")]
    df = spark.createDataFrame(rows, f"`{ORDER_DATE}` timestamp_ntz, `{ORDER_ID}` int, {MARKET} string")
    table, _ = features.FeatureBuilder(drop_non_features=False).fit_transform(df)
    assert {r[MARKET]: r["market_encoded"] for r in table.collect()} == {"z": 0, "m": 1, "a": 2, "n": 3}


def test_lookup_strategies_agree(spark, order_lines, monkeypatch):
    expected = features.FeatureBuilder(drop_non_features=False).fit_transform(order_lines)[0]
    columns = [ORDER_ID, "region_order_frequency", "market_encoded", "order_region_encoded", "category_name_encoded"]
    want = expected.select(*[quoted(c) for c in columns]).collect()
    monkeypatch.setattr(features, "LITERAL_ROWS", 0)
    got = features.FeatureBuilder(drop_non_features=False).fit_transform(order_lines)[0]
    assert sorted(got.select(*[quoted(c) for c in columns]).collect()) == sorted(want)


def test_one_hot_limit_is_an_option(order_lines):
    with pytest.raises(ValueError):
        features.FeatureBuilder(one_hot_limit=2).fit(order_lines)


def test_feature_table_and_round_trip(spark, order_lines, tmp_path):
    table, model = features.FeatureBuilder(skip_leaky_features=True, keep_date_columns=False).fit_transform(order_lines)
    assert not {"shipping_time_ratio", ORDER_ID, ORDER_DATE, SHIPPING_MODE} & set(table.columns)
    assert features.feature_names(table, include_target=True)[-1] == TARGET
    model.save(spark, str(tmp_path / "f"))
    again = features.FeatureModel.load(spark, str(tmp_path / "f")).transform(order_lines)
    assert again.columns == table.columns and again.exceptAll(table).isEmpty()
    with pytest.raises(ValueError):
        features.features_and_target(table.drop(TARGET))


# ---- splits ----

def test_split_errors(order_lines):
    with pytest.raises(ValueError):
        splitting.split_data(order_lines, method="other")
    with pytest.raises(ValueError):
        splitting.time_split(order_lines, ratios=(0.9, 0.2, 0.2))


@pytest.mark.parametrize("method", ["time", "random"])
def test_splits_are_complete_and_repeatable(order_lines, method):
    first = splitting.split_data(order_lines, method)
    sizes = {r["split"]: r["count"] for r in first.groupBy("split").count().collect()}
    assert sizes == {"train": 70, "validation": 15, "test": 15}
    assert first.drop("split").exceptAll(order_lines).isEmpty()
    assert first.exceptAll(splitting.split_data(order_lines, method)).isEmpty()


def test_time_split_has_no_overlap_and_summary_adds_up(order_lines):
    table = splitting.time_split(order_lines)
    assert [r["overlaps"] for r in splitting.overlap_check(table).collect()] == [0, 0]
    assert sum(r["percent"] for r in splitting.split_summary(table).collect()) == pytest.approx(100)


def test_without_a_date_rows_keep_their_stored_order(spark):
    df = spark.range(0, 100, 1, 4).select(F.col("id").cast("double").alias("f"))
    table = splitting.time_split(df, date_column="no such date")
    assert table.filter("split = 'train'").agg(F.max("f")).first()[0] == 69.0


def test_matrix_drops_dates_leaks_and_text(order_lines):
    columns = splitting.model_columns(order_lines)
    assert REAL_DAYS not in columns and SHIPPING_MODE not in columns and ORDER_DATE not in columns and SALES in columns
    assert REAL_DAYS in splitting.model_columns(order_lines, remove_leaky_features=False)
    with pytest.raises(ValueError):
        splitting.model_columns(order_lines.drop(TARGET))


# ---- sources ----

def test_missing_file_and_empty_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        csv.discover_csv(spark, str(tmp_path))


def test_csv_types_encoding_and_missing_marks(spark, tmp_path):
    path = tmp_path / "a supply file.csv"
    path.write_bytes("Order Id,Sales,Market,order date (DateOrders),col1\n7,NaN,NA,1/31/2018 22:56,3\n8,2.5,Perú,bad,4\n"
                     .encode("latin-1"))
    with pytest.raises(ValueError, match="order date"):
        csv.read_csv(spark, str(path))
    rows = csv.read_csv(spark, str(path), unreadable="null").collect()
    assert rows[0].asDict() == {"Order Id": 7, "Sales": None, "Market": None, "order date (DateOrders)":
                                dt.datetime(2018, 1, 31, 22, 56), "col1": 3}
    assert rows[1]["Market"] == "Perú" and rows[1][ORDER_DATE] is None
    assert csv.read_csv(spark, str(path), columns=["Sales"]).columns == ["Sales"]
    with pytest.raises(ValueError):
        csv.read_csv(spark, str(path), columns=["absent"])


def test_csv_keeps_text_ids_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('Order Id,Days for shipping (real),Late_delivery_risk,Product Name,Sales\n'
                    'A-00001,3.0,1.0,"say ""hi"", then","1,5"\n'
                    'A-00002, 4 ,0,"two\nlines \\",2.5\n7,5,1,plain,\n')
    with pytest.raises(ValueError, match="Sales"):
        csv.read_csv(spark, str(path))
    rows = csv.read_csv(spark, str(path), unreadable="null").collect()
    assert [tuple(r) for r in rows] == [("A-00001", 3, 1, 'say "hi", then', None), ("A-00002", 4, 0, "two\nlines \\", 2.5),
                                        ("7", 5, 1, "plain", None)]
    table = spark.createDataFrame([("x", "1"), ("3.5", "2")], "Late_delivery_risk string, Sales string")
    assert [tuple(r) for r in csv.unreadable_values(table).collect()] == [("Late_delivery_risk", 2)]


def test_cleaning_a_file_with_text_ids_loses_no_row(spark, order_lines, tmp_path):
    order_lines.withColumns({c: F.date_format(c, csv.DATE_FORMAT) for c in (ORDER_DATE, SHIP_DATE)}).write.option(
        "header", True).option("escape", '"').csv(str(tmp_path / "lines.csv"))
    read = csv.read_csv(spark, str(tmp_path / "lines.csv"))
    assert read.count() == order_lines.count() and dict(read.dtypes)[ORDER_ID] == "string"
    assert cleaning.clean(read)[0].count() == order_lines.distinct().count()


def test_stored_cleaning_covers_columns_clean_at_fit(spark, order_lines):
    model = cleaning.Cleaner().fit(order_lines)
    gaps = order_lines.limit(4).withColumns({"Shipping Mode": F.lit(None).cast("string"), "Sales": F.lit(None).cast("double"),
                                             "Order Item Quantity": F.lit(9_999)})
    rows = model.transform(gaps).collect()
    mode = order_lines.groupBy("Shipping Mode").count().orderBy(F.desc("count"), "Shipping Mode").first()[0]
    assert {r["Shipping Mode"] for r in rows} == {mode}
    assert {r["Sales"] for r in rows} == {order_lines.agg(F.median("Sales")).first()[0]}
    assert max(r["Order Item Quantity"] for r in rows) <= order_lines.agg(F.max("Order Item Quantity")).first()[0]


def test_discovery_stays_in_the_folder(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "supply.csv").write_text("col1\n1\n")
    (tmp_path / "z.csv").write_text("col1\n1\n")
    assert csv.discover_csv(spark, str(tmp_path)).endswith("/z.csv")


def test_csv_splits_round_trip(spark, order_lines, tmp_path):
    table = splitting.time_split(order_lines)
    tables.write_splits(table, str(tmp_path / "c"), form="csv")
    back = tables.read_splits(spark, str(tmp_path / "c"))
    assert dict(back.dtypes) == dict(table.dtypes)
    assert sorted(map(str, back.select(*table.columns).collect())) == sorted(map(str, table.collect()))


def test_discovery_prefers_the_main_table(spark, tmp_path):
    for name in ("a.csv", "MySupply.csv", "z.csv"):
        (tmp_path / name).write_text("col1,col2\n1,2\n3,4\n")
    path = csv.discover_csv(spark, str(tmp_path))
    assert path.endswith("MySupply.csv") and csv.read_csv(spark, path).count() == 2


def test_samples_have_exact_sizes(order_lines):
    assert csv.random_sample(order_lines, 17).count() == 17
    assert csv.random_sample(order_lines, 500).count() == 100
    assert csv.head_sample(order_lines, 3, [ORDER_ID]).first()[ORDER_ID] == "ln-0000"


def test_profile_and_narrowing(spark):
    df = spark.createDataFrame([(1, "a", 300), (2, None, 70000), (2, "b", 5)], "x bigint, y string, z bigint")
    rows = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert (rows["y"]["null_count"], rows["y"]["null_percent"], rows["y"]["sample_values"]) == (1, 33.33, "a, b")
    assert rows["x"]["unique_count"] == 2 and rows["z"]["dtype"] == "bigint"
    assert profile.narrowed(df).dtypes == [("x", "tinyint"), ("y", "string"), ("z", "int")]
    assert profile.column_profile(df, approx=True).count() == 3


def test_splits_round_trip_and_missing_split(spark, order_lines, tmp_path):
    table = splitting.time_split(order_lines)
    tables.write_splits(table, str(tmp_path / "s"))
    assert tables.read_splits(spark, str(tmp_path / "s")).count() == 100
    tables.write_splits(table.filter("split = 'train'"), str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        tables.read_splits(spark, str(tmp_path / "t"))
