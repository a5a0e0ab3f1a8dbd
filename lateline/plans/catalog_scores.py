"""Queries on metrics, risk and supply, over probabilities that need no model."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators import metrics, risk, supply
from lateline.plans.catalog import featured, query
from lateline.plans.oracle_views import half_even, over
from lateline.plans.shipments import shipments, table
from lateline.schema import ORDER_ID, QUANTITY, REAL_DAYS, REGION, SALES, SCHEDULED_DAYS, SEGMENT, TARGET


def scored(spark, folder):
    """Label and a rule-based probability of each order line."""
    return featured(spark, folder).select(
        ORDER_ID, quoted(TARGET).alias("label"), F.col("overall_risk_score").alias("probability"), SALES)


def two_models(spark, folder):
    base = scored(spark, folder)
    rules = base.withColumn("model", F.lit("rules"))
    mirror = base.withColumns({"model": F.lit("mirror"), "probability": 1 - F.col("probability")})
    return rules.unionByName(mirror)


_TWO = """AND VIEW both_models AS (SELECT 'rules' AS model, label, probability FROM scored
UNION ALL SELECT 'mirror', label, 1 - probability FROM scored)"""


def _rates(digits: int = 6) -> str:
    parts = {"accuracy": "(tp + tn)::DOUBLE / nullif(tp + tn + fp + fn, 0)", "precision": "tp::DOUBLE / nullif(tp + fp, 0)",
             "recall": "tp::DOUBLE / nullif(tp + fn, 0)", "f1_score": "(2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0)",
             "specificity": "tn::DOUBLE / nullif(tn + fp, 0)"}
    return ", ".join(f"{half_even(f'coalesce({e}, 0)', digits)} AS {n}" for n, e in parts.items())


_CELLS = """count(*) FILTER (WHERE label = 0 AND probability < {t}) AS tn, count(*) FILTER (WHERE label = 0 AND probability >= {t}) AS fp,
count(*) FILTER (WHERE label = 1 AND probability < {t}) AS fn, count(*) FILTER (WHERE label = 1 AND probability >= {t}) AS tp"""
_CURVE = """AND VIEW g AS (SELECT probability AS threshold, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
FROM scored GROUP BY 1), cum AS (SELECT *, sum(p) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS fp,
sum(p) OVER () AS pp, sum(n) OVER () AS nn FROM g)"""


def _rounded(df, *names, digits=6):
    return df.withColumns({n: round_half_even(F.col(n), digits) for n in names})


RATES = ["accuracy", "precision", "recall", "f1_score", "specificity"]


@query("a02_confusion_matrix", over("scored", f"SELECT {_CELLS.format(t='0.5::DOUBLE')} FROM scored"))
def _(spark, folder):
    return metrics.confusion(metrics.at_threshold(scored(spark, folder)))


@query("a03_rates", over("scored", f"AND VIEW c AS (SELECT {_CELLS.format(t='0.5::DOUBLE')} FROM scored) SELECT tn, fp, fn, tp, {_rates()} FROM c"))
def _(spark, folder):
    return _rounded(metrics.rates(metrics.confusion(metrics.at_threshold(scored(spark, folder)))), *RATES)


_AREAS = f"""{half_even('sum(n * (tp - p / 2.0::DOUBLE)) / (any_value(pp)::DOUBLE * any_value(nn))', 8)} AS roc_auc,
{half_even('sum(p * tp::DOUBLE / (tp + fp)) / any_value(pp)::DOUBLE', 8)} AS average_precision"""


@query("a04_a05_ranking_metrics", over("scored", f"{_CURVE} SELECT {_AREAS} FROM cum"))
def _(spark, folder):
    return _rounded(metrics.ranking_metrics(scored(spark, folder)), "roc_auc", "average_precision", digits=8)


@query("a04_a05_many_scores", over("feat", f"""AND VIEW scored AS (SELECT "{TARGET}" AS label, value_per_unit_norm AS probability FROM feat),
{_CURVE[9:]} SELECT {_AREAS} FROM cum"""))
def _(spark, folder):
    rows = featured(spark, folder).select(quoted(TARGET).alias("label"), F.col("value_per_unit_norm").alias("probability"))
    return _rounded(metrics.ranking_metrics(rows), "roc_auc", "average_precision", digits=8)


@query("a06_roc_points", over("scored", f"""{_CURVE} SELECT threshold, {half_even('fp::DOUBLE / nn', 8)} AS fpr,
{half_even('tp::DOUBLE / pp', 8)} AS tpr FROM cum"""))
def _(spark, folder):
    return _rounded(metrics.roc_points(scored(spark, folder)), "fpr", "tpr", digits=8)


@query("a07_precision_recall_points", over("scored", f"""{_CURVE} SELECT threshold, {half_even('tp::DOUBLE / (tp + fp)', 8)} AS precision,
{half_even('tp::DOUBLE / pp', 8)} AS recall, {half_even('pp::DOUBLE / (pp + nn)', 8)} AS baseline FROM cum"""))
def _(spark, folder):
    return _rounded(metrics.precision_recall_points(scored(spark, folder)), "precision", "recall", "baseline", digits=8)


@query("a09_gates", over("scored", f"""{_CURVE}, c AS (SELECT {_CELLS.format(t='0.5::DOUBLE')} FROM scored),
m AS (SELECT (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy, tp::DOUBLE / (tp + fn) AS recall FROM c),
a AS (SELECT {_AREAS} FROM cum)
SELECT CAST(accuracy >= 0.8 AS INTEGER) AS accuracy_ok, CAST(recall >= 0.75 AS INTEGER) AS recall_ok,
CAST(roc_auc >= 0.8 AS INTEGER) AS roc_auc_ok, CAST(accuracy >= 0.8 AND recall >= 0.75 AND roc_auc >= 0.8 AS INTEGER) AS passes FROM m, a"""))
def _(spark, folder):
    return metrics.passes_gates(metrics.evaluate(metrics.at_threshold(scored(spark, folder)))).select(
        "accuracy_ok", "recall_ok", "roc_auc_ok", "passes")


_COMPARED = f"""{_TWO}, c AS (SELECT model, {_CELLS.format(t='0.5::DOUBLE')} FROM both_models GROUP BY 1)"""


def _comparison(spark, folder):
    rows = metrics.rates(metrics.confusion(metrics.at_threshold(two_models(spark, folder)), ["model"]))
    parts = [rows.filter(F.col("model") == m).withColumn("dataset", F.lit("all")) for m in ("rules", "mirror")]
    return metrics.compare_models(parts)


@query("a10_model_comparison", over("scored", f"{_COMPARED} SELECT model, 'all' AS dataset, {_rates(4)} FROM c"))
def _(spark, folder):
    return _comparison(spark, folder)


@query("a11_long_comparison", over("scored", f"""{_COMPARED}, w AS (SELECT model, {_rates(4)} FROM c)
UNPIVOT_LATER""".replace("UNPIVOT_LATER", " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {m} AS value FROM w" for m in RATES))))
def _(spark, folder):
    return metrics.long_comparison(_comparison(spark, folder))


_GRID = ", ".join(f"({t!r}::DOUBLE)" for t in metrics.threshold_grid())
_SWEEP = f"""AND VIEW grid AS (SELECT * FROM (VALUES {_GRID}) v(t)),
cells AS (SELECT t AS threshold, {_CELLS.format(t='t')} FROM scored, grid GROUP BY 1)"""
_BALANCED = "(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2"


@query("a12_threshold_sweep", over("scored", f"""{_SWEEP} SELECT threshold, {_rates()}, {half_even(_BALANCED, 6)} AS balanced_accuracy,
tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives FROM cells"""))
def _(spark, folder):
    return _rounded(metrics.threshold_sweep(scored(spark, folder)), *RATES, "balanced_accuracy")


@query("a12_best_threshold", over("scored", f"""{_SWEEP}, r AS (SELECT threshold, {_BALANCED} AS s FROM cells)
SELECT threshold AS optimal_threshold, {half_even('s', 6)} AS best_score FROM r ORDER BY s DESC, threshold LIMIT 1"""))
def _(spark, folder):
    return _rounded(metrics.best_threshold(metrics.threshold_sweep(scored(spark, folder)), "balanced"), "best_score")


@query("a13_a14_at_threshold", over("scored", f"""{_CURVE}, c AS (SELECT {_CELLS.format(t='0.45::DOUBLE')} FROM scored),
a AS (SELECT {_AREAS} FROM cum)
SELECT 'rules (t=0.45)' AS model, 'test' AS dataset, 0.45::DOUBLE AS threshold_used, tn, fp, fn, tp, {_rates()},
{half_even('roc_auc', 6)} AS roc_auc FROM c, a"""))
def _(spark, folder):
    return _rounded(metrics.evaluate_at(scored(spark, folder), 0.45, "rules"), *RATES, "roc_auc")


@query("a16_best_model", over("scored", f"""{_COMPARED}, w AS (SELECT model, {_rates(4)} FROM c)
SELECT arg_max(model, f1_score) AS best_by_f1, arg_max(model, accuracy) AS best_by_accuracy FROM w"""))
def _(spark, folder):
    return metrics.best_model(_comparison(spark, folder))


# ---- risk ----

_BAND = """CASE WHEN probability > -0.01 AND probability <= 0.3::DOUBLE THEN 'low' WHEN probability > 0.3::DOUBLE AND probability <= 0.6::DOUBLE
THEN 'medium' WHEN probability > 0.6::DOUBLE AND probability <= 1.01 THEN 'high' END"""
_SCORE = half_even("probability * 100.0::DOUBLE", 1)


def _called(spark, folder):
    return metrics.at_threshold(scored(spark, folder))


@query("r04_risk_table", over("scored", f"""SELECT "{ORDER_ID}", probability AS delay_probability,
CAST(probability >= 0.5::DOUBLE AS INTEGER) AS delay_prediction, {_SCORE} AS risk_score, {_BAND} AS risk_category FROM scored"""))
def _(spark, folder):
    return risk.risk_table(_called(spark, folder), [ORDER_ID])


@query("r05_r09_risk_columns", over("scored", f"""SELECT "{ORDER_ID}", "Sales", probability AS delay_risk_probability,
CAST(probability >= 0.5::DOUBLE AS INTEGER) AS delay_risk_prediction, {_BAND} AS delay_risk_category, {_SCORE} AS delay_risk_score,
CAST(CASE {_BAND} WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS INTEGER) AS alert_priority FROM scored"""))
def _(spark, folder):
    return risk.with_alert_priority(risk.with_risk(_called(spark, folder))).drop("label", "probability", "prediction")


@query("r06_high_risk", over("scored", f"""SELECT "{ORDER_ID}", "Sales", probability AS delay_risk_probability FROM scored
WHERE probability >= 0.6::DOUBLE"""))
def _(spark, folder):
    return risk.high_risk(risk.with_risk(_called(spark, folder)), ties=[ORDER_ID]).select(
        ORDER_ID, SALES, "delay_risk_probability")


@query("r07_risk_summary", over("scored", f"""AND VIEW b AS (SELECT {_SCORE} AS s, {_BAND} AS band, CAST(probability >= 0.5::DOUBLE AS INTEGER) AS late FROM scored)
SELECT count(*) AS total_shipments, CAST(sum(late) AS BIGINT) AS predicted_late, CAST(sum(1 - late) AS BIGINT) AS predicted_on_time,
{half_even('avg(s)', 6)} AS average_risk_score, quantile_cont(s, 0.5) AS median_risk_score,
count(*) FILTER (WHERE band = 'low') AS low_risk_count, count(*) FILTER (WHERE band = 'medium') AS medium_risk_count,
count(*) FILTER (WHERE band = 'high') AS high_risk_count,
{half_even("count(*) FILTER (WHERE band = 'high') * 100.0::DOUBLE / count(*)", 6)} AS high_risk_percentage FROM b"""))
def _(spark, folder):
    return _rounded(risk.risk_summary(_called(spark, folder)), "average_risk_score", "high_risk_percentage")


# ---- supply ----

@query("d01_merge_sites", over("ship", """SELECT r_name AS site, count(*) AS "rows", CAST(round(sum(amount), 2) AS DOUBLE) AS sales,
count(note) AS notes FROM (SELECT r_name, l_extendedprice AS amount, CASE WHEN r_name = 'ASIA' THEN l_returnflag END AS note
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY 1"""))
def _(spark, folder):
    lines = shipments(spark, folder)
    names = {"AFRICA": "Africa", "AMERICA": "USCA", "ASIA": "Pacific Asia", "EUROPE": "Europe", "MIDDLE EAST": "LATAM"}
    tables = {}
    for site, market in names.items():
        own = lines.filter(F.col("Market") == market)
        tables[site] = (own.select(quoted(SALES).alias("amount"), quoted("Type").alias("note")) if site == "ASIA"
                        else own.select(SALES))
    merged = supply.merge_sites(tables, {"ASIA": {"amount": SALES}})
    return merged.groupBy("site").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(SALES), 2).alias("sales"),
                                      F.count("note").alias("notes"))


def _inventory(spark, folder):
    return supply.inventory_by_sku(shipments(spark, folder), "Product Card Id", QUANTITY, SALES)


_CENTS = 'CAST(round(sum("Sales") * 100) AS BIGINT)'


@query("d02_inventory_by_sku", over("ship", """SELECT "Product Card Id" AS sku, count(*) AS order_lines,
sum("Order Item Quantity") AS quantity, CAST(round(sum("Sales"), 2) AS DOUBLE) AS value FROM ship GROUP BY 1"""))
def _(spark, folder):
    return _inventory(spark, folder).withColumn("value", F.round("value", 2))


@query("d03_abc_classes", over("ship", f"""AND VIEW s AS (SELECT "Product Card Id" AS sku, {_CENTS} AS cents FROM ship GROUP BY 1),
c AS (SELECT sku, cents, CAST(sum(cents) OVER (ORDER BY cents DESC, sku) AS DOUBLE) / CAST(sum(cents) OVER () AS DOUBLE) AS share FROM s)
SELECT sku, cents AS value, {half_even('share', 8)} AS cumulative_share,
CASE WHEN share <= 0.8::DOUBLE THEN 'A' WHEN share <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_class FROM c"""))
def _(spark, folder):
    cents = _inventory(spark, folder).withColumn("value", F.rint(F.col("value") * 100).cast("long"))
    return _rounded(supply.abc_classes(cents).drop("quantity"), "cumulative_share", digits=8)


@query("d04_allocation_gaps", over("ship", f"""AND VIEW a AS (SELECT "Order Region" AS site, sum("Order Item Quantity") AS demand FROM ship GROUP BY 1),
s AS (SELECT n_name AS site, sum(l_quantity) AS stock FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
b AS (SELECT site, coalesce(stock, 0.0::DOUBLE) AS stock, coalesce(demand, 0.0::DOUBLE) AS demand FROM s FULL JOIN a USING (site)),
h AS (SELECT *, stock / sum(stock) OVER () AS stock_share, demand / sum(demand) OVER () AS demand_share FROM b)
SELECT site, stock, demand, {half_even('stock_share', 8)} AS stock_share, {half_even('demand_share', 8)} AS demand_share,
{half_even('stock_share - demand_share', 8)} + 0.0::DOUBLE AS gap, CASE WHEN stock_share - demand_share > 0.01 THEN 'reduce' WHEN stock_share - demand_share < -0.01
THEN 'increase' ELSE 'keep' END AS recommendation FROM h"""))
def _(spark, folder):
    stock = (table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
             .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.col("n_name").alias(REGION), "l_quantity"))
    gaps = supply.allocation_gaps(stock.withColumnRenamed(REGION, "site"),
                                  shipments(spark, folder).select(quoted(REGION).alias("site"), quoted(QUANTITY)),
                                  "site", "l_quantity", QUANTITY)
    return _rounded(gaps, "stock_share", "demand_share", "gap", digits=8).withColumn("gap", F.col("gap") + F.lit(0.0))


def _delivery(spark, folder):
    return supply.supplier_delivery(shipments(spark, folder, ("l_suppkey",)), "l_suppkey", REAL_DAYS, SCHEDULED_DAYS)


_DELIVERY = f"""AND VIEW d AS (SELECT l_suppkey AS supplier, count(*) AS order_lines,
avg(CASE WHEN "{REAL_DAYS}" <= "{SCHEDULED_DAYS}" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS on_time_rate,
avg(CAST(greatest("{REAL_DAYS}" - "{SCHEDULED_DAYS}", 0) AS DOUBLE)) AS average_delay,
CAST(max("{REAL_DAYS}" - "{SCHEDULED_DAYS}") AS INTEGER) AS worst_delay FROM ship GROUP BY 1)"""


@query("d05_d06_supplier_delivery", over("ship", f"""{_DELIVERY} SELECT supplier, order_lines, {half_even('on_time_rate', 8)} AS on_time_rate,
{half_even('average_delay', 8)} AS average_delay, worst_delay FROM d"""))
def _(spark, folder):
    return _rounded(_delivery(spark, folder), "on_time_rate", "average_delay", digits=8)


@query("d06_delay_alerts", over("ship", f"""AND VIEW a AS (SELECT "{ORDER_ID}", "{SEGMENT}", "{REAL_DAYS}" - "{SCHEDULED_DAYS}" AS delay_days FROM ship
WHERE "{REAL_DAYS}" > "{SCHEDULED_DAYS}") SELECT *, CASE WHEN delay_days >= 4 THEN 'high' WHEN delay_days >= 2 THEN 'medium' ELSE 'low' END AS severity,
CAST(CASE WHEN delay_days >= 4 THEN 1 WHEN delay_days >= 2 THEN 2 ELSE 3 END AS INTEGER) AS alert_priority FROM a"""))
def _(spark, folder):
    return supply.delay_alerts(shipments(spark, folder), [ORDER_ID, SEGMENT], REAL_DAYS, SCHEDULED_DAYS)


_SCORES = f"""{_DELIVERY}, k AS (SELECT supplier, {half_even('''(on_time_rate - min(on_time_rate) OVER ()) / (max(on_time_rate) OVER () - min(on_time_rate) OVER ()) * 0.5::DOUBLE
+ (1 - (average_delay - min(average_delay) OVER ()) / (max(average_delay) OVER () - min(average_delay) OVER ())) * 0.3::DOUBLE
+ (order_lines - min(order_lines) OVER ())::DOUBLE / (max(order_lines) OVER () - min(order_lines) OVER ()) * 0.2::DOUBLE''', 6)} AS vendor_score FROM d)"""


@query("d07_vendor_scores", over("ship", f"{_SCORES} SELECT supplier, vendor_score FROM k"))
def _(spark, folder):
    return supply.vendor_scores(_delivery(spark, folder)).select("supplier", "vendor_score")


@query("d08_vendor_tiers", over("ship", f"""{_SCORES}, p AS (SELECT supplier, vendor_score, percent_rank() OVER (ORDER BY vendor_score) AS percentile FROM k)
SELECT supplier, vendor_score, {half_even('percentile', 8)} AS percentile, CASE WHEN percentile >= 0.75 THEN 'strategic' WHEN percentile >= 0.5 THEN 'preferred'
WHEN percentile >= 0.25 THEN 'watch' ELSE 'exit' END AS tier FROM p"""))
def _(spark, folder):
    tiers = supply.vendor_tiers(supply.vendor_scores(_delivery(spark, folder)))
    return _rounded(tiers, "percentile", digits=8).select("supplier", "vendor_score", "percentile", "tier")


@query("d09_delimiter_and_mapping", over("ship", 'SELECT "Order Id", "Sales", "Shipping Mode" FROM ship'))
def _(spark, folder):
    from lateline.plans.catalog_data import _as_csv
    from lateline.sources.csv import read_csv
    lines = shipments(spark, folder).select(quoted(ORDER_ID).alias("order_no"), quoted(SALES).alias("amount"),
                                            quoted("Shipping Mode").alias("mode"))
    return read_csv(spark, _as_csv(lines, "semicolons", sep=";"), delimiter=None, encoding="UTF-8",
                    rename={"order_no": ORDER_ID, "amount": SALES, "mode": "Shipping Mode"})
