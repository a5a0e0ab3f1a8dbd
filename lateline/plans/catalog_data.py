"""Queries on sources, quality rules and cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators import cleaning, quality
from lateline.plans.catalog import cleaned, cleaner_model, divided, query
from lateline.plans.oracle_views import half_even, over
from lateline.plans.shipments import raw_shipments, shipments, table
from lateline.schema import (CATEGORICALS, CATEGORY, DISCOUNT, ITEM_PRICE, MARKET, ORDER_DATE, ORDER_ID, QUANTITY,
                             REAL_DAYS, REGION, REQUIRED, SALES, SCHEDULED_DAYS, SHIP_DATE, SHIPPING_MODE, TARGET)
from lateline.session import shared_folder
from lateline.sources import csv, profile, tables


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _columns(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _as_csv(df: DataFrame, label: str, **options: str) -> str:
    path = _folder(df.sparkSession, label) + "/supply_lines.csv"
    df.write.options(header="True", **options).csv(path)
    return path


_COLUMNS = ["Type", REAL_DAYS, SCHEDULED_DAYS, "Benefit per order", "Sales per customer", "Delivery Status", TARGET,
            CATEGORY, "Customer Country", "Customer Email", "Customer Fname", "Customer Id", "Customer Segment",
            "Department Name", MARKET, "Order City", "Order Country", ORDER_DATE, ORDER_ID, DISCOUNT, "Order Item Id",
            ITEM_PRICE, QUANTITY, SALES, REGION, "Order Status", "Product Card Id", "Product Name", "Product Price",
            SHIP_DATE, SHIPPING_MODE]
_SCAN = [ORDER_ID, "Order Item Id", TARGET, REAL_DAYS, SHIPPING_MODE, DISCOUNT, QUANTITY, SALES, CATEGORY, MARKET,
         REGION, "Customer Segment", "Product Price"]


@query("s01_csv_scan", over("ship", f"SELECT {_columns(_SCAN)} FROM ship"))
def _(spark, folder):
    path = _as_csv(shipments(spark, folder).drop(ORDER_DATE, SHIP_DATE), "scan")
    return csv.read_csv(spark, path, encoding="UTF-8").select(*[
        quoted(c).cast("int") if c == "Order Item Id" else quoted(c) for c in _SCAN])


@query("s02_encoding_fallback", "SELECT c_custkey, c_name || ' café' AS \"Customer Fname\" FROM customer")
def _(spark, folder):
    named = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" café")).alias("Customer Fname"))
    return csv.read_csv(spark, _as_csv(named, "latin", encoding="ISO-8859-1")).select(
        F.col("c_custkey").cast("long").alias("c_custkey"), quoted("Customer Fname"))


@query("s03_column_subset", over("ship", 'SELECT "Order Id", "Sales", "Market" FROM ship'))
def _(spark, folder):
    return csv.read_csv(spark, _as_csv(shipments(spark, folder), "subset"), columns=[ORDER_ID, SALES, MARKET],
                        encoding="UTF-8")


@query("s04_date_parse", over("ship", f"SELECT \"Order Id\", \"Order Item Id\", \"{ORDER_DATE}\", \"{SHIP_DATE}\" FROM ship"))
def _(spark, folder):
    lines = shipments(spark, folder).select(
        ORDER_ID, "Order Item Id", *[F.date_format(quoted(c), csv.DATE_FORMAT).alias(c) for c in (ORDER_DATE, SHIP_DATE)])
    return csv.read_csv(spark, _as_csv(lines, "dates"), encoding="UTF-8").select(
        ORDER_ID, F.col("`Order Item Id`").cast("int").alias("Order Item Id"),
        *[quoted(c).cast("timestamp_ntz").alias(c) for c in (ORDER_DATE, SHIP_DATE)])


@query("s05_type_narrowing", over("ship", """AND VIEW spans AS (
SELECT 'Order Id' AS "column", min("Order Id")::BIGINT AS low, max("Order Id")::BIGINT AS high FROM ship
UNION ALL SELECT 'Order Item Id', min("Order Item Id")::BIGINT, max("Order Item Id")::BIGINT FROM ship
UNION ALL SELECT 'Days for shipping (real)', min("Days for shipping (real)")::BIGINT, max("Days for shipping (real)")::BIGINT FROM ship
UNION ALL SELECT 'Customer Id', min("Customer Id")::BIGINT, max("Customer Id")::BIGINT FROM ship)
SELECT "column", low, high, CASE WHEN low >= -128 AND high < 128 THEN 'tinyint' WHEN low >= -32768 AND high < 32768
THEN 'smallint' WHEN low >= -2147483648 AND high < 2147483648 THEN 'int' ELSE 'bigint' END AS narrow FROM spans"""))
def _(spark, folder):
    lines = shipments(spark, folder).select(ORDER_ID, "Order Item Id", quoted(REAL_DAYS), "Customer Id")
    return profile.narrowing_plan(lines).drop("dtype")


@query("s06_head_sample", over("ship", """SELECT "Order Id", "Order Item Id", "Sales" FROM ship
ORDER BY "Order Id", "Order Item Id", "Sales" LIMIT 1000"""))
def _(spark, folder):
    return csv.head_sample(shipments(spark, folder).select(ORDER_ID, "Order Item Id", SALES), 1000,
                           [ORDER_ID, "Order Item Id", SALES])


@query("s07_random_sample")
def _(spark, folder):
    return csv.random_sample(shipments(spark, folder), 1000)


_INTS = [REAL_DAYS, SCHEDULED_DAYS, TARGET, "Order Item Id"]
_LONGS = ["Customer Id", ORDER_ID, "Product Card Id"]
_DOUBLES = ["Benefit per order", "Sales per customer", DISCOUNT, ITEM_PRICE, QUANTITY, SALES, "Product Price"]
_KINDS = {c: "int" if c in _INTS else "bigint" if c in _LONGS else "double" if c in _DOUBLES
          else "timestamp_ntz" if c in (ORDER_DATE, SHIP_DATE) else "string" for c in _COLUMNS}


def _samples(column: str) -> str:
    """The three smallest values as text; engines spell doubles differently, so those are left out."""
    if column in _DOUBLES:
        return "NULL::VARCHAR"
    return (f"""(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT "{column}"::VARCHAR AS v FROM raw """
            f"""WHERE "{column}" IS NOT NULL ORDER BY v LIMIT 3))""")


@query("s08_column_profile", over("raw", "AND VIEW p AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{k}' AS dtype, count("{c}") AS non_null_count, count(*) - count("{c}") AS null_count,
{half_even(f'(count(*) - count("{c}")) * 100.0::DOUBLE / count(*)', 2)} AS null_percent,
count(DISTINCT "{c}") AS unique_count, {_samples(c)} AS sample_values FROM raw""" for c, k in _KINDS.items()) + ") SELECT * FROM p"))
def _(spark, folder):
    """Every column; the samples of all but doubles."""
    found = profile.column_profile(raw_shipments(spark, folder))
    return found.withColumn("sample_values", F.when(F.col("dtype") != "double", F.col("sample_values")))


@query("s10_input_discovery", over("ship", 'SELECT count(*) AS "rows", sum("Order Item Quantity") AS quantity FROM ship'))
def _(spark, folder):
    path, lines = _folder(spark, "inbox"), shipments(spark, folder).select(ORDER_ID, QUANTITY)
    table(spark, folder, "region").write.option("header", True).csv(f"{path}/attic.csv")
    lines.write.option("header", True).csv(f"{path}/supply_lines.csv")
    found = csv.read_csv(spark, csv.discover_csv(spark, path), encoding="UTF-8")
    return found.agg(F.count(F.lit(1)).alias("rows"), F.sum(QUANTITY).alias("quantity"))


@query("s11_s12_split_round_trip", over("clean", """AND VIEW k AS (SELECT count(*) AS n FROM clean)
SELECT 'train' AS split, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS "rows" FROM k UNION ALL SELECT 'validation',
CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) - CAST(floor(n * 0.7::DOUBLE) AS BIGINT) FROM k
UNION ALL SELECT 'test', n - CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) FROM k"""))
def _(spark, folder):
    path = _folder(spark, "splits")
    tables.write_splits(divided(spark, folder), path)
    return tables.read_splits(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


# ---- quality rules ----

def _rule(check: str, column: str | None, condition: str, severity: str, over_percent: float = 0.0) -> str:
    name = "NULL::VARCHAR" if column is None else f"'{column}'"
    rows = f"count(*) FILTER (WHERE {condition})"
    share = f"{rows} * 100.0::DOUBLE / count(*)"
    return (f"""SELECT '{check}' AS "check", {name} AS "column", CASE WHEN {rows} > 0 AND {share} > {over_percent}
THEN '{severity}' ELSE 'ok' END AS severity, {rows} AS "rows", {half_even(share, 4)} AS percent FROM raw""")


_FIELDS = ["check", "column", "severity", "rows", "percent"]


@query("v01_row_count", over("raw", """SELECT 'row_count' AS "check", CASE WHEN count(*) = 0 THEN 'error'
WHEN count(*) < 100 THEN 'warning' ELSE 'ok' END AS severity, count(*) AS "rows" FROM raw"""))
def _(spark, folder):
    return quality.row_count_check(raw_shipments(spark, folder)).select("check", "severity", "rows")


@query("v02_required_columns", "SELECT 'required_columns' AS \"check\", 'error' AS severity, count(*) AS \"rows\" FROM (VALUES "
       + ", ".join(f"('{c}')" for c in REQUIRED) + """) r(name)
WHERE name NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'lineitem')
UNION ALL SELECT 'row_count', 'ok', count(*) FROM lineitem""")
def _(spark, folder):
    report = quality.validate(table(spark, folder, "lineitem")).report
    return report.filter(F.col("check").isin("required_columns", "row_count")).select("check", "severity", "rows")


@query("v03_target", over("raw", _rule("target_nulls", TARGET, f'"{TARGET}" IS NULL', "error") + " UNION ALL "
                          + _rule("target_values", TARGET, f'"{TARGET}" NOT IN (0, 1)', "error")))
def _(spark, folder):
    return quality.target_check(raw_shipments(spark, folder)).select(*_FIELDS)


@query("v04_class_balance", over("raw", f"""AND VIEW c AS (SELECT "{TARGET}" AS t, count(*) AS n FROM raw
WHERE "{TARGET}" IS NOT NULL GROUP BY 1)
SELECT CASE WHEN count(*) <> 2 THEN 'not two classes' WHEN min(n) * 100.0::DOUBLE / sum(n) < 10 THEN 'severe imbalance'
WHEN min(n) * 100.0::DOUBLE / sum(n) < 30 THEN 'moderate imbalance' ELSE 'balanced enough' END AS message,
min(n) AS "rows", {half_even('min(n) * 100.0::DOUBLE / sum(n)', 4)} AS percent FROM c"""))
def _(spark, folder):
    return quality.balance_check(raw_shipments(spark, folder)).select("message", "rows", "percent")


@query("v05_duplicates", over("raw", f"""SELECT 'duplicate_rows' AS "check", CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))
AS BIGINT) AS "rows" UNION ALL SELECT 'repeated_order_id', CAST((SELECT count(*) FROM raw) -
(SELECT count(DISTINCT "{ORDER_ID}") FROM raw) AS BIGINT)"""))
def _(spark, folder):
    return quality.duplicate_check(raw_shipments(spark, folder)).select("check", "rows")


@query("v06_missing_values", over("raw", " UNION ALL ".join(
    _rule("missing_values", c, f'"{c}" IS NULL', "warning" if c in REQUIRED else "ok", 10.0) for c in _COLUMNS)))
def _(spark, folder):
    return quality.missing_check(raw_shipments(spark, folder)).select(*_FIELDS)


_LIMITS = {REAL_DAYS: (0, 365), SCHEDULED_DAYS: (0, 365), DISCOUNT: (0, 1), QUANTITY: (1, 10000),
           ITEM_PRICE: (0, 1e9), SALES: (0, 1e9)}


@query("v07_ranges", over("raw", " UNION ALL ".join(
    _rule(check, c, test, "warning") for c, (low, high) in _LIMITS.items()
    for check, test in (("below_minimum", f'"{c}" < {low}'), ("above_maximum", f'"{c}" > {high}'),
                        ("negative", f'"{c}" < 0')))))
def _(spark, folder):
    return quality.range_check(raw_shipments(spark, folder)).select(*_FIELDS)


@query("v08_domains", over("raw", """AND VIEW v AS (SELECT 'Shipping Mode' AS "column", "Shipping Mode" AS value FROM raw
WHERE "Shipping Mode" NOT IN ('Standard Class', 'First Class', 'Second Class', 'Same Day')
UNION ALL SELECT 'Customer Segment', "Customer Segment" FROM raw WHERE "Customer Segment" NOT IN ('Consumer', 'Corporate', 'Home Office')
UNION ALL SELECT 'Market', "Market" FROM raw WHERE "Market" NOT IN ('LATAM', 'Europe', 'Pacific Asia', 'USCA', 'Africa'))
SELECT "column", value, count(*) AS "rows" FROM v GROUP BY ALL"""))
def _(spark, folder):
    return quality.domain_check(raw_shipments(spark, folder)).select("column", F.col("message").alias("value"), "rows")


@query("v09a_dates", over("raw", " UNION ALL ".join(
    _rule(f"date_too_{word}", c, f"\"{c}\" {sign} TIMESTAMP '{limit}'", "warning") for c in (ORDER_DATE, SHIP_DATE)
    for word, sign, limit in (("early", "<", "2010-01-01"), ("late", ">", "2030-01-01")))))
def _(spark, folder):
    return quality.date_check(raw_shipments(spark, folder)).select(*_FIELDS)


@query("v09b_v09c_consistency", over("raw", _rule(
    "shipped_before_ordered", SHIP_DATE, f'"{SHIP_DATE}" < "{ORDER_DATE}"', "warning") + " UNION ALL " + _rule(
    "late_flag_mismatch", TARGET, f'CAST(coalesce("{REAL_DAYS}" > "{SCHEDULED_DAYS}", false) AS INTEGER) '
    f'IS DISTINCT FROM "{TARGET}"', "warning", 5.0)))
def _(spark, folder):
    return quality.consistency_check(raw_shipments(spark, folder)).select(*_FIELDS)


@query("v10_statistics", over("raw", f"""SELECT 'total_rows' AS statistic, count(*)::VARCHAR AS value FROM raw
UNION ALL SELECT 'total_columns', '31'
UNION ALL SELECT 'date_range_start', min("{ORDER_DATE}")::DATE::VARCHAR FROM raw
UNION ALL SELECT 'date_range_end', max("{ORDER_DATE}")::DATE::VARCHAR FROM raw
UNION ALL SELECT 'target_share_0', printf('%.4f', avg(1 - "{TARGET}")) FROM raw
UNION ALL SELECT 'target_share_1', printf('%.4f', avg("{TARGET}")) FROM raw"""))
def _(spark, folder):
    return quality.table_statistics(raw_shipments(spark, folder))


_DOMAINS = {SHIPPING_MODE: "'Standard Class', 'First Class', 'Second Class', 'Same Day'",
            "Customer Segment": "'Consumer', 'Corporate', 'Home Office'",
            MARKET: "'LATAM', 'Europe', 'Pacific Asia', 'USCA', 'Africa'"}
_ALL_RULES = " UNION ALL ".join([
    _rule("target_nulls", TARGET, f'"{TARGET}" IS NULL', "error"),
    _rule("target_values", TARGET, f'"{TARGET}" NOT IN (0, 1)', "error"),
    *[_rule("missing_values", c, f'"{c}" IS NULL', "warning" if c in REQUIRED else "ok", 10.0) for c in _COLUMNS],
    *[_rule(check, c, test, "warning") for c, (low, high) in _LIMITS.items()
      for check, test in (("below_minimum", f'"{c}" < {low}'), ("above_maximum", f'"{c}" > {high}'),
                          ("negative", f'"{c}" < 0'))],
    *[_rule(f"date_too_{word}", c, f"\"{c}\" {sign} TIMESTAMP '{limit}'", "warning") for c in (ORDER_DATE, SHIP_DATE)
      for word, sign, limit in (("early", "<", "2010-01-01"), ("late", ">", "2030-01-01"))],
    _rule("shipped_before_ordered", SHIP_DATE, f'"{SHIP_DATE}" < "{ORDER_DATE}"', "warning"),
    _rule("late_flag_mismatch", TARGET, f'CAST(coalesce("{REAL_DAYS}" > "{SCHEDULED_DAYS}", false) AS INTEGER) '
          f'IS DISTINCT FROM "{TARGET}"', "warning", 5.0),
    """SELECT 'row_count', NULL, CASE WHEN count(*) = 0 THEN 'error' WHEN count(*) < 100 THEN 'warning' ELSE 'ok' END,
count(*), 100.0::DOUBLE FROM raw""",
    "SELECT 'required_columns', NULL, 'ok', 0, 0.0::DOUBLE",
    f"""SELECT 'duplicate_rows', NULL, CASE WHEN n * 100.0::DOUBLE / total > 5 THEN 'warning' ELSE 'ok' END, n,
{half_even('n * 100.0::DOUBLE / total', 4)} FROM (SELECT (SELECT count(*) FROM raw) AS total,
(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS n)""",
    f"""SELECT 'repeated_order_id', '{ORDER_ID}', 'ok', n, {half_even('n * 100.0::DOUBLE / total', 4)} FROM
(SELECT (SELECT count(*) FROM raw) AS total, (SELECT count(*) - count(DISTINCT "{ORDER_ID}") FROM raw) AS n)""",
    *[f"""SELECT 'unexpected_value', '{c}', 'warning', count(*), 0.0::DOUBLE FROM raw WHERE "{c}" NOT IN ({accepted})
GROUP BY "{c}" """ for c, accepted in _DOMAINS.items()],
    f"""SELECT 'class_balance', '{TARGET}', CASE WHEN count(*) = 2 AND min(n) * 100.0::DOUBLE / sum(n) < 30 THEN 'warning'
ELSE 'ok' END, min(n), {half_even('min(n) * 100.0::DOUBLE / sum(n)', 4)} FROM (SELECT count(*) AS n FROM raw
WHERE "{TARGET}" IS NOT NULL GROUP BY "{TARGET}")"""])


@query("v11_validate_all", over("raw", f"AND VIEW r AS ({_ALL_RULES}) SELECT * FROM r"))
def _(spark, folder):
    report = quality.validate(raw_shipments(spark, folder)).report.select(*_FIELDS)
    return report.withColumn("percent", F.coalesce("percent", F.lit(0.0)))


@query("v12_class_balance_report", over("raw", f"""AND VIEW c AS (SELECT count(*) FILTER (WHERE "{TARGET}" = 0) AS on_time,
count(*) FILTER (WHERE "{TARGET}" = 1) AS late FROM raw)
SELECT on_time, late, {half_even('on_time * 100.0::DOUBLE / (on_time + late)', 4)} AS on_time_percent,
{half_even('late * 100.0::DOUBLE / (on_time + late)', 4)} AS late_percent,
{half_even('greatest(on_time, late)::DOUBLE / least(on_time, late)', 6)} AS imbalance_ratio,
CASE WHEN greatest(on_time, late)::DOUBLE / least(on_time, late) < 1.5 THEN 'balanced'
WHEN greatest(on_time, late)::DOUBLE / least(on_time, late) < 3 THEN 'moderate' ELSE 'significant' END AS verdict FROM c"""))
def _(spark, folder):
    return quality.class_balance_report(raw_shipments(spark, folder))


# ---- cleaning ----

@query("p00_clean", over("clean", "SELECT * FROM clean"))
def _(spark, folder):
    return cleaning.Cleaner().fit_transform(raw_shipments(spark, folder))[0]


_WIDE = [REAL_DAYS, TARGET]
_REPLACE = "REPLACE (" + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _WIDE) + ")"


def _wide(df: DataFrame) -> DataFrame:
    """Integers that hold nulls as doubles, so both engines hand them over alike."""
    return df.withColumns({c: quoted(c).cast("double") for c in _WIDE})


@query("p01_drop_unused", over("raw", f"""SELECT * EXCLUDE ("Customer Fname", "Customer Email", "Order Item Id",
"Product Card Id", "Customer Id", "Benefit per order") {_REPLACE} FROM raw"""))
def _(spark, folder):
    return _wide(cleaning.drop_unused(raw_shipments(spark, folder)))


@query("p02_deduplicate", over("base", f"SELECT * {_REPLACE} FROM base"))
def _(spark, folder):
    return _wide(cleaning.distinct_rows(cleaning.drop_unused(raw_shipments(spark, folder))).drop(cleaning.COPIES))


@query("p03_critical_nulls", over("raw", f'SELECT * {_REPLACE} FROM raw WHERE "{TARGET}" IS NOT NULL AND "{ORDER_ID}" IS NOT NULL'))
def _(spark, folder):
    return _wide(cleaning.drop_critical_nulls(raw_shipments(spark, folder)))


_NUMBERS = [REAL_DAYS, SCHEDULED_DAYS, DISCOUNT, QUANTITY, ITEM_PRICE, SALES, "Product Price"]


@query("p04_impute_numbers", over("imputed", f'SELECT "{ORDER_ID}", {_columns(_NUMBERS)} FROM imputed'))
def _(spark, folder):
    filled, _ = cleaning.Cleaner(handle_outliers=False, standardize_categories=False).fit_transform(
        raw_shipments(spark, folder))
    return filled.select(ORDER_ID, *[quoted(c) for c in _NUMBERS])


_TEXTS = [SHIPPING_MODE, CATEGORY, MARKET, REGION, "Order Country", "Order City", "Customer Segment"]


@query("p05_impute_categories", over("imputed", f'SELECT "{ORDER_ID}", {_columns(_TEXTS)} FROM imputed'))
def _(spark, folder):
    filled, _ = cleaning.Cleaner(handle_outliers=False, standardize_categories=False).fit_transform(
        raw_shipments(spark, folder))
    return filled.select(ORDER_ID, *[quoted(c) for c in _TEXTS])


@query("p06_winsorise", over("clean", f'SELECT "{ORDER_ID}", {_columns(_NUMBERS)} FROM clean'))
def _(spark, folder):
    capped, _ = cleaning.Cleaner(standardize_categories=False).fit_transform(raw_shipments(spark, folder))
    return capped.select(ORDER_ID, *[quoted(c) for c in _NUMBERS])


@query("p07_standardise", over("clean", " UNION ALL ".join(
    f"""SELECT '{c}' AS name, "{c}" AS value, count(*) AS n FROM clean GROUP BY ALL""" for c in CATEGORICALS)))
def _(spark, folder):
    from lateline.operators.ranks import value_counts
    return value_counts(cleaned(spark, folder), {c: quoted(c) for c in CATEGORICALS})


@query("p08_fix_types", over("raw", f"""SELECT "{ORDER_ID}", coalesce(CAST("{TARGET}" AS INTEGER), -1) AS "{TARGET}",
CAST("{REAL_DAYS}" AS DOUBLE) AS "{REAL_DAYS}", CAST("{QUANTITY}" AS DOUBLE) AS "{QUANTITY}", "{ORDER_DATE}" FROM raw"""))
def _(spark, folder):
    texts = raw_shipments(spark, folder).select(
        ORDER_ID, quoted(TARGET).cast("string").alias(TARGET), quoted(REAL_DAYS).cast("string").alias(REAL_DAYS),
        quoted(QUANTITY).cast("string").alias(QUANTITY), F.date_format(quoted(ORDER_DATE), "M/d/yyyy H:mm").alias(ORDER_DATE))
    return cleaning.fix_types(texts).withColumns({
        TARGET: F.coalesce(quoted(TARGET), F.lit(-1)), ORDER_DATE: quoted(ORDER_DATE).cast("timestamp_ntz")})


@query("p09_missing_summary", over("raw", "AND VIEW m AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing_count, count(*) AS total FROM raw""" for c in _COLUMNS)
    + f""") SELECT "column", missing_count, {half_even('missing_count::DOUBLE / total * 100.0::DOUBLE', 2)} AS missing_percent
FROM m WHERE missing_count > 0"""))
def _(spark, folder):
    return cleaning.missing_summary(raw_shipments(spark, folder))


@query("p10_outlier_summary", over("raw", "AND VIEW q AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST("{c}" AS DOUBLE) AS v, (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.25) FROM raw) AS q1,
(SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.75) FROM raw) AS q3 FROM raw"""
    for c in [REAL_DAYS, SCHEDULED_DAYS, DISCOUNT, QUANTITY, ITEM_PRICE]) + f"""), o AS (
SELECT "column", count(*) FILTER (WHERE v < q1 - 1.5::DOUBLE * (q3 - q1)) AS below_lower,
count(*) FILTER (WHERE v > q3 + 1.5::DOUBLE * (q3 - q1)) AS above_upper, count(*) AS total,
any_value(q1 - 1.5::DOUBLE * (q3 - q1)) AS low, any_value(q3 + 1.5::DOUBLE * (q3 - q1)) AS high FROM q GROUP BY 1)
SELECT "column", below_lower, above_upper, below_lower + above_upper AS total_outliers,
{half_even('low', 2)} AS lower_bound, {half_even('high', 2)} AS upper_bound,
{half_even('(below_lower + above_upper)::DOUBLE / total * 100.0::DOUBLE', 2)} AS outlier_percent
FROM o WHERE below_lower + above_upper > 0"""))
def _(spark, folder):
    return cleaning.outlier_summary(raw_shipments(spark, folder))


@query("p11_cleaning_report", over("imputed", f"""SELECT 'initial_rows' AS step, NULL::VARCHAR AS "column", (SELECT count(*) FROM raw) AS "rows"
UNION ALL SELECT 'final_rows', NULL, (SELECT count(*) FROM crit)
UNION ALL SELECT 'rows_removed', NULL, (SELECT count(*) FROM raw) - (SELECT count(*) FROM crit)
UNION ALL SELECT 'duplicates_removed', NULL, (SELECT count(*) FROM raw) - (SELECT count(*) FROM base)
UNION ALL SELECT 'critical_null', '{TARGET}', (SELECT count(*) FROM base WHERE "{TARGET}" IS NULL)
""" + "".join(f"""UNION ALL SELECT 'imputed', '{c}', count(*) - count("{c}") FROM crit HAVING count(*) > count("{c}")
""" for c in [*_NUMBERS, *_TEXTS])))
def _(spark, folder):
    report = cleaner_model(spark, folder).report(spark)
    return report.filter(~F.col("step").isin("capped", "standardized")).select("step", "column", "rows")


@query("p11_capped_report", over("imputed", "AND VIEW w AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" < (SELECT quantile_cont("{c}", {low}) FROM imputed)
OR "{c}" > (SELECT quantile_cont("{c}", 0.99) FROM imputed)) AS "rows" FROM imputed"""
    for c, low in ((REAL_DAYS, 0.01), (SCHEDULED_DAYS, 0.01), (QUANTITY, 0.0), (ITEM_PRICE, 0.0), (SALES, 0.0)))
    + ') SELECT * FROM w WHERE "rows" > 0'))
def _(spark, folder):
    return cleaner_model(spark, folder).report(spark).filter(F.col("step") == "capped").select("column", "rows")


@query("p12_late_rate_by_mode", over("clean", f"""SELECT "{SHIPPING_MODE}", count(*) AS "rows",
{half_even(f'avg("{TARGET}")', 6)} AS late_rate FROM clean GROUP BY 1"""))
def _(spark, folder):
    table_, _ = cleaning.clean(raw_shipments(spark, folder))
    return table_.groupBy(SHIPPING_MODE).agg(F.count(F.lit(1)).alias("rows"),
                                             round_half_even(F.avg(TARGET), 6).alias("late_rate"))
