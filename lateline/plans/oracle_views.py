"""SQL text of the order-line views, for checking results with another engine."""

from __future__ import annotations

SHIP = """ship AS (
SELECT l_returnflag AS "Type",
  CAST(((date_diff('day', o_orderdate, l_shipdate) % 7) + 7) % 7 AS INTEGER) AS "Days for shipping (real)",
  CAST(CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 4 END AS INTEGER)
    AS "Days for shipment (scheduled)",
  l_extendedprice * l_tax AS "Benefit per order",
  l_extendedprice * (1 - l_discount) AS "Sales per customer",
  p_type AS "Category Name", n_name AS "Customer Country",
  lower(c_name) || '@example.com' AS "Customer Email", c_name AS "Customer Fname", c_custkey AS "Customer Id",
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'Consumer'
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Corporate'
       WHEN c_mktsegment = 'FURNITURE' THEN 'Home Office' END AS "Customer Segment",
  p_brand AS "Department Name",
  CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'USCA' WHEN 'ASIA' THEN 'Pacific Asia'
       WHEN 'EUROPE' THEN 'Europe' WHEN 'MIDDLE EAST' THEN 'LATAM' END AS "Market",
  n_name || ' ' || CAST(c_custkey % 10 AS VARCHAR) AS "Order City", n_name AS "Order Country",
  o_orderdate AS "order date (DateOrders)", l_orderkey AS "Order Id",
  l_discount AS "Order Item Discount Rate", l_linenumber AS "Order Item Id",
  p_retailprice AS "Order Item Product Price", l_quantity AS "Order Item Quantity",
  l_extendedprice AS "Sales", n_name AS "Order Region", o_orderstatus AS "Order Status",
  l_partkey AS "Product Card Id", p_name AS "Product Name", p_retailprice AS "Product Price",
  l_shipdate AS "shipping date (DateOrders)",
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'Same Day' WHEN '2' THEN 'First Class' WHEN '3' THEN 'Second Class'
       ELSE 'Standard Class' END AS "Shipping Mode",
  CASE WHEN CAST(((date_diff('day', o_orderdate, l_shipdate) % 7) + 7) % 7 AS INTEGER) >
            CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 4 END
       THEN 1 ELSE 0 END::INTEGER AS "Late_delivery_risk",
  CASE WHEN CAST(((date_diff('day', o_orderdate, l_shipdate) % 7) + 7) % 7 AS INTEGER) >
            CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 4 END
       THEN 'Late delivery' ELSE 'Shipping on time' END AS "Delivery Status",
  l_suppkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey)"""

RAW = """dirty AS (
SELECT * EXCLUDE (l_suppkey) REPLACE (
  CASE WHEN NOT ("Order Item Id" = 7 AND "Order Item Quantity" = 50) THEN "Late_delivery_risk" END AS "Late_delivery_risk",
  CASE WHEN "Order Item Id" = 7 THEN NULL WHEN "Order Item Id" = 1 AND "Order Item Quantity" = 50 THEN 60
       ELSE "Days for shipping (real)" END AS "Days for shipping (real)",
  CASE WHEN "Order Item Id" = 6 THEN NULL WHEN "Order Item Id" = 2 THEN '  ' || upper("Shipping Mode") || ' '
       WHEN "Order Item Id" = 1 THEN lower("Shipping Mode") ELSE "Shipping Mode" END AS "Shipping Mode",
  CASE WHEN NOT ("Order Item Id" = 6 AND "Order Item Quantity" > 40) THEN "Market" END AS "Market",
  CASE WHEN "Order Item Id" = 5 THEN NULL WHEN "Order Item Quantity" = 50 THEN "Sales" * 100 ELSE "Sales" END AS "Sales",
  CASE WHEN NOT ("Order Item Id" = 4) THEN "Order Item Discount Rate" END AS "Order Item Discount Rate",
  CASE WHEN "Order Item Id" = 3 THEN NULL WHEN "Order Item Id" = 2 THEN lower("Category Name")
       ELSE "Category Name" END AS "Category Name",
  CASE WHEN NOT ("Order Item Id" = 5 AND "Order Item Quantity" < 10) THEN "Order Region" END AS "Order Region",
  CASE WHEN NOT ("Order Item Id" = 3 AND "Order Item Quantity" < 5) THEN "Order Item Quantity" END AS "Order Item Quantity",
  CASE WHEN NOT ("Order Item Id" = 7 AND "Order Item Quantity" = 49) THEN "order date (DateOrders)" END
    AS "order date (DateOrders)")
FROM ship),
raw AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE "Order Item Id" = 1)"""


def title_sql(column: str) -> str:
    """Title case for words separated by spaces."""
    return (f"array_to_string(list_transform(string_split(lower(trim({column})), ' '), "
            "lambda w: upper(w[1]) || w[2:]), ' ')")


def _mode(column: str) -> str:
    return (f'(SELECT "{column}" FROM crit WHERE "{column}" IS NOT NULL GROUP BY "{column}" '
            f'ORDER BY count(*) DESC, "{column}" LIMIT 1)')


def _median(column: str) -> str:
    return f'(SELECT quantile_cont(CAST("{column}" AS DOUBLE), 0.5) FROM crit)'


_NUMBERS = ["Days for shipping (real)", "Days for shipment (scheduled)", "Order Item Quantity",
            "Order Item Product Price", "Sales", "Product Price"]
_MODES = ["Shipping Mode", "Market", "Order Region", "Order Country", "Order City", "Customer Segment"]
_BOUNDS = {"Days for shipping (real)": 0.01, "Days for shipment (scheduled)": 0.01, "Order Item Quantity": 0.0,
           "Order Item Product Price": 0.0, "Sales": 0.0}

BASE = """base AS (
SELECT DISTINCT * EXCLUDE ("Customer Fname", "Customer Email", "Order Item Id", "Product Card Id", "Customer Id",
  "Benefit per order") FROM raw),
crit AS (SELECT * FROM base WHERE "Late_delivery_risk" IS NOT NULL AND "Order Id" IS NOT NULL)"""

IMPUTED = (
    "imputed AS MATERIALIZED (SELECT * REPLACE ("
    + ", ".join(f'coalesce(CAST("{c}" AS DOUBLE), {_median(c)}) AS "{c}"' for c in _NUMBERS)
    + ', coalesce("Order Item Discount Rate", 0.0) AS "Order Item Discount Rate"'
    + ", " + ", ".join(f'coalesce("{c}", {_mode(c)}) AS "{c}"' for c in _MODES)
    + ', coalesce("Category Name", \'Unknown\') AS "Category Name") FROM crit)')

CLEAN = (
    "bounds AS (SELECT "
    + ", ".join(f'quantile_cont("{c}", {low}) AS "{c} low", quantile_cont("{c}", 0.99) AS "{c} high"'
                for c, low in _BOUNDS.items())
    + " FROM imputed), clean AS MATERIALIZED (SELECT imputed.* REPLACE ("
    + ", ".join(f'greatest(least("{c}", "{c} high"), "{c} low") AS "{c}"' for c in _BOUNDS)
    + ", " + ", ".join(f'{title_sql(chr(34) + c + chr(34))} AS "{c}"' for c in
                       ["Shipping Mode", "Category Name", "Market", "Order Region", "Customer Segment"])
    + ") FROM imputed, bounds)")

TEMPORAL = """CAST(isodow("order date (DateOrders)") - 1 AS INTEGER) AS order_day_of_week,
CAST(month("order date (DateOrders)") AS INTEGER) AS order_month,
CAST(quarter("order date (DateOrders)") AS INTEGER) AS order_quarter,
CAST(coalesce(isodow("order date (DateOrders)") >= 6, false) AS INTEGER) AS is_weekend,
CAST(coalesce(day("order date (DateOrders)") <= 5, false) AS INTEGER) AS is_month_start,
CAST(coalesce(day("order date (DateOrders)") >= 26, false) AS INTEGER) AS is_month_end,
CAST(coalesce(month("order date (DateOrders)") IN (11, 12), false) AS INTEGER) AS is_holiday_season,
CAST(dayofyear("order date (DateOrders)") AS INTEGER) AS order_day_of_year"""

SHIPPING = """"Days for shipment (scheduled)" AS scheduled_shipping_days,
CASE "Shipping Mode" WHEN 'Same Day' THEN 0.2::DOUBLE WHEN 'First Class' THEN 0.8::DOUBLE
  WHEN 'Second Class' THEN 0.5::DOUBLE WHEN 'Standard Class' THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END AS shipping_mode_risk,
CAST(coalesce("Shipping Mode" IN ('Same Day', 'First Class'), false) AS INTEGER) AS is_expedited,
"Days for shipping (real)" - "Days for shipment (scheduled)" AS shipping_lead_time_variance,
"Days for shipping (real)" / CASE WHEN "Days for shipment (scheduled)" = 0 THEN 1.0::DOUBLE
  ELSE "Days for shipment (scheduled)" END AS shipping_time_ratio,
CASE WHEN "order date (DateOrders)" IS NOT NULL AND "shipping date (DateOrders)" IS NOT NULL THEN
  greatest(date_sub('day', "order date (DateOrders)", "shipping date (DateOrders)"), 0) END::BIGINT
  AS order_processing_time"""

GEOGRAPHIC = """CASE upper(coalesce("Market", 'nan')) WHEN 'USCA' THEN 0.3::DOUBLE WHEN 'EUROPE' THEN 0.5::DOUBLE
  WHEN 'LATAM' THEN 0.7::DOUBLE WHEN 'PACIFIC ASIA' THEN 0.6::DOUBLE WHEN 'AFRICA' THEN 0.8::DOUBLE
  ELSE 0.5::DOUBLE END AS market_risk_score,
CAST(upper(coalesce("Market", 'nan')) <> 'USCA' AS INTEGER) AS is_international,
CAST(count("Order Region") OVER (PARTITION BY "Order Region") AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE)
  AS region_order_frequency"""

PRODUCT = """"Order Item Product Price" * "Order Item Quantity" AS order_item_value,
CAST(coalesce("Order Item Product Price" * "Order Item Quantity" >
  (SELECT quantile_cont("Order Item Product Price" * "Order Item Quantity", 0.5) FROM clean), false) AS INTEGER)
  AS is_high_value_order,
CASE WHEN "Order Item Discount Rate" > -0.01 AND "Order Item Discount Rate" <= 0 THEN 'none'
  WHEN "Order Item Discount Rate" > 0 AND "Order Item Discount Rate" <= 0.1::DOUBLE THEN 'low'
  WHEN "Order Item Discount Rate" > 0.1::DOUBLE AND "Order Item Discount Rate" <= 0.2::DOUBLE THEN 'medium'
  WHEN "Order Item Discount Rate" > 0.2::DOUBLE AND "Order Item Discount Rate" <= 1 THEN 'high' END AS discount_category,
CAST(coalesce("Order Item Discount Rate" > 0, false) AS INTEGER) AS has_discount,
CASE "Customer Segment" WHEN 'Consumer' THEN 0.5::DOUBLE WHEN 'Corporate' THEN 0.7::DOUBLE
  WHEN 'Home Office' THEN 0.4::DOUBLE ELSE 0.5::DOUBLE END AS segment_order_frequency,
CAST(coalesce("Order Item Quantity" > 5, false) AS INTEGER) AS is_bulk_order"""

FEATURES = f"""feat1 AS MATERIALIZED (SELECT clean.*, {TEMPORAL}, {SHIPPING}, {GEOGRAPHIC}, {PRODUCT} FROM clean),
feat2 AS (SELECT feat1.*, CAST(is_weekend = 1 OR is_holiday_season = 1 AS INTEGER) AS high_risk_period,
  CASE WHEN "Days for shipment (scheduled)" > -1 AND "Days for shipment (scheduled)" <= 2 THEN 0.0::DOUBLE
    WHEN "Days for shipment (scheduled)" > 2 AND "Days for shipment (scheduled)" <= 4 THEN 1.0::DOUBLE
    WHEN "Days for shipment (scheduled)" > 4 AND "Days for shipment (scheduled)" <= 6 THEN 2.0::DOUBLE
    WHEN "Days for shipment (scheduled)" > 6 AND "Days for shipment (scheduled)" <= 100 THEN 3.0::DOUBLE
    ELSE 1.0::DOUBLE END AS scheduled_days_cat,
  "Sales" / CASE WHEN "Order Item Quantity" = 0 THEN 1.0::DOUBLE ELSE "Order Item Quantity" END AS value_per_unit,
  CASE order_day_of_week WHEN 0 THEN 0.7::DOUBLE WHEN 1 THEN 0.4::DOUBLE WHEN 2 THEN 0.3::DOUBLE WHEN 3 THEN 0.4::DOUBLE
    WHEN 4 THEN 0.6::DOUBLE WHEN 5 THEN 0.5::DOUBLE WHEN 6 THEN 0.5::DOUBLE ELSE 0.5::DOUBLE END AS day_risk_score
  FROM feat1),
top_unit AS (SELECT quantile_cont(value_per_unit, 0.99) AS q99 FROM feat2),
feat AS MATERIALIZED (SELECT feat2.*, shipping_mode_risk * market_risk_score AS shipping_market_interaction,
  is_expedited * is_international AS expedited_international,
  least(value_per_unit, q99) / q99 AS value_per_unit_norm,
  is_high_value_order + is_bulk_order + is_expedited AS order_complexity,
  market_risk_score * (1 - segment_order_frequency) AS market_segment_risk,
  day_risk_score * 0.5::DOUBLE + high_risk_period * 0.5::DOUBLE AS temporal_risk,
  (shipping_mode_risk + market_risk_score + (day_risk_score * 0.5::DOUBLE + high_risk_period * 0.5::DOUBLE)) / 3.0::DOUBLE
    AS overall_risk_score
  FROM feat2, top_unit)"""

#: Deterministic probabilities that need no model.
SCORED = """scored AS MATERIALIZED (SELECT "Order Id", "Late_delivery_risk" AS label, overall_risk_score AS probability,
  "Sales" FROM feat)"""

_CHAIN = {"ship": [SHIP], "raw": [SHIP, RAW], "base": [SHIP, RAW, BASE], "imputed": [SHIP, RAW, BASE, IMPUTED],
          "clean": [SHIP, RAW, BASE, IMPUTED, CLEAN], "feat": [SHIP, RAW, BASE, IMPUTED, CLEAN, FEATURES],
          "scored": [SHIP, RAW, BASE, IMPUTED, CLEAN, FEATURES, SCORED]}


def over(view: str, body: str) -> str:
    """A query over one of the views; a body may add its own views before its SELECT."""
    body = body.strip()
    link = ", " if body.upper().startswith("AND VIEW ") else " "
    body = body[9:] if link == ", " else body
    return "WITH " + ", ".join(_CHAIN[view]) + link + body


def half_even(expression: str, digits: int) -> str:
    scale = f"1{'0' * digits}.0::DOUBLE"
    return f"round_even(CAST({expression} AS DOUBLE) * {scale}, 0) / {scale}"
