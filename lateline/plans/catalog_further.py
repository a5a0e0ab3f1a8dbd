"""Queries on files of mixed form, memory plans, transfers, neighbour information, boosting, folds and model invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, round_half_even
from lateline.operators import boosting, metrics, selection, supply, training
from lateline.operators.risk import with_risk
from lateline.plans import catalog_models as models
from lateline.plans import jobs
from lateline.plans.catalog import cleaned, featured, query
from lateline.plans.catalog_data import _folder
from lateline.plans.catalog_features import RANKED, _each
from lateline.plans.oracle_views import half_even, over
from lateline.plans.shipments import raw_shipments, shipments, table
from lateline.schema import MARKET, ORDER_DATE, ORDER_ID, QUANTITY, REGION, SALES, TARGET
from lateline.sources import csv, profile

# ---- files ----


@query("s02_encoding_by_file", "SELECT c_custkey, c_name || ' café, ' || c_mktsegment AS \"Customer Fname\" FROM customer")
def _(spark, folder):
    """One file in UTF-8 and one in Latin-1 in the same folder."""
    path = f"{_folder(spark, 'mixed')}/customers.csv"
    named = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" café, "), "c_mktsegment").alias("Customer Fname"))
    half = F.xxhash64("c_custkey") % 2 == 0
    for part, encoding in ((half, "UTF-8"), (~half, "ISO-8859-1")):
        named.filter(part).write.mode("append").options(header=True, encoding=encoding, emptyValue="").csv(path)
    return csv.read_csv(spark, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), quoted("Customer Fname"))


@query("d09_delimiter_by_file", over("ship", f"""SELECT "{ORDER_ID}", "{SALES}", "{MARKET}" || '; one, two|three' AS "Order City" FROM ship"""))
def _(spark, folder):
    """A delimiter for each market, in files with quoted delimiters in header and values."""
    path = f"{_folder(spark, 'delimited')}/lines.csv"
    lines = shipments(spark, folder).select(
        quoted(ORDER_ID), quoted(SALES), F.concat(quoted(MARKET), F.lit("; one, two|three")).alias("city; of, order|here"), quoted(MARKET))
    for k, market in enumerate(("LATAM", "Europe", "Pacific Asia", "USCA", "Africa")):
        own = lines.filter(quoted(MARKET) == market).drop(MARKET)
        own.write.mode("append").options(header=True, quoteAll=True, sep=csv.DELIMITERS[k % len(csv.DELIMITERS)]).csv(path)
    return csv.read_csv(spark, path, delimiter=None, rename={"city; of, order|here": "Order City"})


# ---- memory ----

_INTEGERS = ["Days for shipping (real)", "Days for shipment (scheduled)", TARGET, "Customer Id", ORDER_ID, "Order Item Id", "Product Card Id"]
_LONGS = ["Customer Id", ORDER_ID, "Product Card Id"]
_DOUBLES = ["Benefit per order", "Sales per customer", "Order Item Discount Rate", "Order Item Product Price", QUANTITY, SALES, "Product Price"]
_TEXTS = ["Type", "Delivery Status", "Category Name", "Customer Country", "Customer Email", "Customer Fname", "Customer Segment",
          "Department Name", MARKET, "Order City", "Order Country", REGION, "Order Status", "Product Name", "Shipping Mode"]
_DATES = [ORDER_DATE, "shipping date (DateOrders)"]


def _memory_sql() -> str:
    parts = []
    for c in _INTEGERS:
        width, kind = (8, "bigint") if c in _LONGS else (4, "int")
        parts.append(f"""SELECT '{c}' AS "column", '{kind}' AS dtype, n * {width} AS plain_bytes, k AS stored_as,
n * CASE k WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 ELSE 8 END AS narrow_bytes FROM (SELECT count(*) AS n,
CASE WHEN min("{c}") >= -128 AND max("{c}") < 128 THEN 'tinyint' WHEN min("{c}") >= -32768 AND max("{c}") < 32768 THEN 'smallint'
WHEN min("{c}") >= -2147483648 AND max("{c}") < 2147483648 THEN 'int' ELSE 'bigint' END AS k FROM raw)""")
    for c in _DOUBLES:
        parts.append(f"""SELECT '{c}', 'double', n * 8, CASE WHEN s THEN 'float' ELSE 'double' END, n * CASE WHEN s THEN 4 ELSE 8 END
FROM (SELECT count(*) AS n, bool_and("{c}"::FLOAT::DOUBLE = "{c}") AS s FROM raw)""")
    for c in _TEXTS:
        parts.append(f"""SELECT '{c}', 'string', n * 4 + b, CASE WHEN d < 0.5 * k THEN 'dictionary' ELSE 'string' END, CASE WHEN d < 0.5 * k
THEN n * CASE WHEN d <= 256 THEN 1 WHEN d <= 65536 THEN 2 ELSE 4 END + d * 4 + d * b // k ELSE n * 4 + b END FROM (SELECT count(*) AS n,
count("{c}") AS k, sum(octet_length(encode("{c}")))::BIGINT AS b, count(DISTINCT "{c}") AS d FROM raw)""")
    parts += [f"SELECT '{c}', 'timestamp_ntz', count(*) * 8, 'timestamp_ntz', count(*) * 8 FROM raw" for c in _DATES]
    return " UNION ALL ".join(parts)


@query("v10_memory", over("raw", _memory_sql()))
def _(spark, folder):
    return profile.memory_plan(raw_shipments(spark, folder))


@query("v10_memory_summary", over("raw", f"""AND VIEW m AS ({_memory_sql()})
SELECT {half_even('sum(plain_bytes) / 1e6', 2)} AS before_mb, {half_even('sum(narrow_bytes) / 1e6', 2)} AS after_mb,
{half_even('(sum(plain_bytes) - sum(narrow_bytes)) * 100.0::DOUBLE / sum(plain_bytes)', 1)} AS saved_percent FROM m"""))
def _(spark, folder):
    return profile.memory_summary(profile.memory_plan(raw_shipments(spark, folder)))


# ---- transfers ----

_BALANCE = f"""AND VIEW s AS (SELECT l_returnflag AS item, n_name AS site, sum(CAST(l_quantity AS BIGINT)) AS stock FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
a AS (SELECT "Type" AS item, "{REGION}" AS site, sum(CAST("{QUANTITY}" AS BIGINT)) AS demand FROM ship GROUP BY 1, 2),
b AS (SELECT item, site, coalesce(stock, 0)::BIGINT AS stock, coalesce(demand, 0)::BIGINT AS demand FROM s FULL JOIN a USING (item, site)),
t AS (SELECT item, sum(stock)::HUGEINT AS stock_all, sum(demand)::HUGEINT AS demand_all FROM b GROUP BY 1),
f AS (SELECT item, site, stock, demand, stock_all, (stock_all * demand) // demand_all AS fair, (stock_all * demand) % demand_all AS rest
FROM b JOIN t USING (item) WHERE demand_all > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY rest DESC, site) AS k, stock_all - sum(fair) OVER (PARTITION BY item) AS open FROM f),
units AS (SELECT item, site, stock, demand, (stock - fair - CASE WHEN k <= open THEN 1 ELSE 0 END)::BIGINT AS units FROM r)"""


def _fair(spark, folder):
    stock = (table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
             .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.col("l_returnflag").alias("item"), F.col("n_name").alias("site"), F.col("l_quantity").alias("held")))
    demand = shipments(spark, folder).select(F.col("Type").alias("item"), quoted(REGION).alias("site"), quoted(QUANTITY).alias("asked"))
    return supply.fair_balance(stock, demand, ["item"], "site", "held", "asked")


@query("d04_fair_balance", over("ship", f"{_BALANCE} SELECT item, site, stock, demand, units FROM units"))
def _(spark, folder):
    return _fair(spark, folder)


@query("d04_transfer_plan", over("ship", f"""{_BALANCE}, p AS (SELECT item, site, units > 0 AS gives, abs(units) AS u,
sum(abs(units)) OVER (PARTITION BY item, units > 0 ORDER BY site) AS until FROM units WHERE units != 0)
SELECT x.item, x.site AS from_site, y.site AS to_site,
(least(x.until, y.until) - greatest(x.until - x.u, y.until - y.u))::BIGINT AS units FROM p x JOIN p y ON x.item = y.item AND x.gives AND NOT y.gives
AND greatest(x.until - x.u, y.until - y.u) < least(x.until, y.until)"""))
def _(spark, folder):
    return supply.transfer_plan(_fair(spark, folder), ["item"], "site", "units")


# ---- rankings ----


def _psi(x: str) -> str:
    x = f"({x})::DOUBLE"
    s = f"(1.0::DOUBLE / (({x} + 8) * ({x} + 8)))"
    low = " + ".join(f"1.0::DOUBLE / ({x} + {i})" for i in range(8))
    return (f"(ln({x} + 8) - 0.5::DOUBLE / ({x} + 8) - {s} * (1.0::DOUBLE / 12 - {s} * (1.0::DOUBLE / 120 - {s} * (1.0::DOUBLE / 252 - {s} * "
            f"(1.0::DOUBLE / 240 - {s} * (1.0::DOUBLE / 132))))) - ({low}))")


_NEAR = ", ".join(f"abs(value - {f}(value, {i}) OVER w)" for f in ("lag", "lead") for i in (1, 2, 3))


@query("l05_neighbour_information", over("feat", "AND VIEW b AS (" + _each(
    f"""SELECT '{{c}}' AS feature, "{TARGET}" AS label, coalesce(CAST("{{c}}" AS DOUBLE), 0) AS value FROM feat WHERE "{TARGET}" IS NOT NULL""") + f"""),
g AS (SELECT *, count(*) OVER (PARTITION BY feature, label) AS nl FROM b),
d AS (SELECT feature, value, nl, least(3, nl - 1) AS k, list_sort(list_filter([{_NEAR}], lambda x: x IS NOT NULL)) AS near FROM g WHERE nl > 1
WINDOW w AS (PARTITION BY feature, label ORDER BY value)),
r AS (SELECT feature, value, nl, k, near[k] AS radius, count(*) AS n FROM d GROUP BY ALL),
v AS (SELECT feature, value, count(*) AS n FROM d GROUP BY ALL),
c AS (SELECT feature, value, n, sum(n) OVER (PARTITION BY feature ORDER BY value) AS upto FROM v),
hi AS (SELECT r.*, c.upto AS above FROM r ASOF JOIN c ON r.feature = c.feature AND r.value + r.radius > c.value WHERE radius > 0),
lo AS (SELECT hi.*, coalesce(c.upto, 0) AS below FROM hi ASOF LEFT JOIN c ON hi.feature = c.feature AND hi.value - hi.radius >= c.value),
m AS (SELECT feature, n, k, nl, above - below AS m FROM lo
UNION ALL SELECT r.feature, r.n, k, nl, c.n FROM r JOIN c USING (feature, value) WHERE radius = 0),
i AS (SELECT feature, sum(n) AS rows, sum(n * ({_psi('k')} - {_psi('nl')} - {_psi('m')})) AS terms FROM m GROUP BY 1)
SELECT feature, {half_even(f"greatest({_psi('rows')} + terms / rows, 0)", 6)} + 0.0::DOUBLE AS mutual_info FROM i"""))
def _(spark, folder):
    ranked = featured(spark, folder).select(*[quoted(c) for c in [*RANKED, TARGET]])
    return selection.neighbour_information(ranked).select("feature", (round_half_even(F.col("mutual_info"), 6) + 0.0).alias("mutual_info"))


# ---- boosting ----

_SPLIT_ON = ["scheduled_shipping_days", "order_month", "order_day_of_week", QUANTITY, "market_risk_score", "day_risk_score"]


def _stump_sql(reg_lambda: float, reg_alpha: float, least: int) -> str:
    def shrunk(g):
        return f"(sign({g}) * greatest(abs({g}) - {reg_alpha}::DOUBLE, 0))"

    def score(g, h):
        return f"({shrunk(g)} * {shrunk(g)} / ({h} + {reg_lambda}::DOUBLE))"

    def weight(g, h):
        return half_even(f"-{shrunk(g)} / ({h} + {reg_lambda}::DOUBLE) * 0.1::DOUBLE", 6)

    union = " UNION ALL ".join(f"""SELECT {i} AS f, '{c}' AS feature, coalesce(CAST("{c}" AS DOUBLE), 0) AS value, g, h FROM q""" for i, c in enumerate(_SPLIT_ON))
    return over("feat", f"""AND VIEW p AS (SELECT avg("{TARGET}") AS p, count(*) AS n FROM feat),
q AS (SELECT feat.*, p - "{TARGET}" AS g, p * (1 - p) AS h FROM feat, p),
c AS (SELECT f, feature, value, sum(sum(g)) OVER (PARTITION BY f ORDER BY value) AS gl, sum(sum(h)) OVER (PARTITION BY f ORDER BY value) AS hl,
sum(count(*)) OVER (PARTITION BY f ORDER BY value) AS nl, sum(sum(g)) OVER (PARTITION BY f) AS ga, sum(sum(h)) OVER (PARTITION BY f) AS ha,
sum(count(*)) OVER (PARTITION BY f) AS na FROM ({union}) GROUP BY f, feature, value),
s AS (SELECT *, {score('gl', 'hl')} + {score('(ga - gl)', '(ha - hl)')} - {score('ga', 'ha')} AS gain FROM c WHERE nl >= {least} AND na - nl >= {least})
SELECT feature, value AS threshold, {half_even('gain', 2)} AS gain, nl::BIGINT AS left_rows, (na - nl)::BIGINT AS right_rows,
{weight('gl', 'hl')} AS left_value, {weight('(ga - gl)', '(ha - hl)')} AS right_value FROM s ORDER BY round(gain, 6) DESC, f, value LIMIT 1""")


def _stump(spark, folder, params):
    """The split and the leaves of the first tree of two leaves over all rows."""
    rows = featured(spark, folder).select(
        array_to_vector(F.array(*[F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in _SPLIT_ON])).alias("features"),
        quoted(TARGET).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    model = boosting.fit_boosting(rows, {"n_estimators": 1, "learning_rate": 0.1, **params})
    nodes = model.nodes(spark)
    root, left, right = (nodes.alias(n) for n in ("root", "low", "high"))
    joined = root.filter("root.node = 0").join(left, F.col("root.left") == F.col("low.node")).join(
        right, F.col("root.right") == F.col("high.node"))
    names = F.array(*[F.lit(c) for c in _SPLIT_ON])
    return joined.select(
        F.get(names, F.col("root.feature")).alias("feature"), F.col("root.threshold").alias("threshold"),
        round_half_even(F.col("root.gain"), 2).alias("gain"), F.col("low.rows").alias("left_rows"), F.col("high.rows").alias("right_rows"),
        round_half_even(F.col("low.value"), 6).alias("left_value"), round_half_even(F.col("high.value"), 6).alias("right_value"))


@query("m04_first_split", _stump_sql(1.0, 0.0, 1))
def _(spark, folder):
    return _stump(spark, folder, {"max_depth": 1, "gamma": 0.1, "min_child_weight": 3.0})


@query("m11_first_split", _stump_sql(0.1, 0.1, 20))
def _(spark, folder):
    return _stump(spark, folder, {"growth": "leaf", "num_leaves": 2, "max_depth": 12, "reg_alpha": 0.1, "reg_lambda": 0.1,
                                  "min_child_samples": 20, "min_child_weight": 1e-3})


@query("m11_tree_sums", over("feat", f"""SELECT k::INTEGER AS tree, 20::BIGINT AS leaves, 19::BIGINT AS splits, count(*) AS "rows",
sum(1 - "{TARGET}")::BIGINT AS zeros, true AS children_add_up, true AS gains_positive FROM feat, range(5) r(k) GROUP BY 1"""))
def _(spark, folder):
    """Whole leaf-wise trees: leaves, splits and rows of each, and whether the rows of all inner nodes add up."""
    rows = featured(spark, folder).select(
        array_to_vector(F.array(*[F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in RANKED])).alias("features"),
        quoted(TARGET).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    model = boosting.fit_boosting(rows, {"n_estimators": 5, "growth": "leaf", "num_leaves": 20, "max_depth": 12, "learning_rate": 0.1,
                                         "min_child_samples": 5, "min_child_weight": 1e-3})
    nodes = model.nodes(spark)
    size = nodes.select(F.col("tree").alias("t"), F.col("node").alias("child"), F.col("rows").alias("child_rows"))
    parts = nodes.filter("feature >= 0").select("tree", "node", "rows", F.explode(F.array("left", "right")).alias("at")).join(
        size, (F.col("tree") == F.col("t")) & (F.col("at") == F.col("child"))).groupBy("tree", "node", "rows").agg(
        F.sum("child_rows").alias("below")).groupBy("tree").agg(F.bool_and(F.col("rows") == F.col("below")).alias("children_add_up"))
    zeros = rows.filter("label = 0").count()
    return nodes.groupBy("tree").agg(
        F.count_if(F.col("feature") < 0).alias("leaves"), F.count_if(F.col("feature") >= 0).alias("splits"),
        F.max(F.when(F.col("node") == 0, F.col("rows"))).alias("rows"), F.lit(zeros).cast("long").alias("zeros"),
        F.bool_and((F.col("feature") < 0) | (F.col("gain") > 0)).alias("gains_positive")).join(parts, "tree")


@query("m09_fold_sizes", over("clean", f"""AND VIEW k AS (SELECT "{TARGET}" AS label, count(*) AS n FROM clean GROUP BY 1)
SELECT label, f::INTEGER AS fold, (n - f + 4) // 5 AS "rows" FROM k, range(5) r(f)"""))
def _(spark, folder):
    return training.folded(cleaned(spark, folder), 5, TARGET).groupBy(quoted(TARGET).alias("label"), "fold").agg(
        F.count(F.lit(1)).alias("rows"))


# ---- invariants of fitted models ----

def _invariants(name: str, scored: DataFrame) -> DataFrame:
    """What must hold for the scores of any model: rows, cells that add up to the labels, and classes that follow from the probability."""
    rated = metrics.rates(metrics.confusion(scored))
    facts = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("long").alias("positives"),
        F.bool_and((F.col("probability") >= 0) & (F.col("probability") <= 1)).alias("probabilities_fit"),
        F.bool_and((F.col("probability") > 0.5) == (F.col("prediction") == 1)).alias("classes_follow")).first()
    rows, positives = F.lit(facts["rows"]), F.lit(facts["positives"])
    add_up = (F.col("tp") + F.col("fn") == positives) & (F.col("tn") + F.col("fp") == rows - positives)
    right = F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / rows) < 1e-9
    return rated.select(
        F.lit(name).alias("model"), rows.alias("rows"), add_up.alias("cells_add_up"), right.alias("accuracy_follows"),
        F.lit(facts["probabilities_fit"]).alias("probabilities_fit"), F.lit(facts["classes_follow"]).alias("classes_follow"))


def _invariants_sql(names: list[str]) -> str:
    listed = ", ".join(f"('{n}')" for n in names)
    return over("clean", f"""SELECT m.name AS model, n - CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) AS "rows", true AS cells_add_up,
true AS accuracy_follows, true AS probabilities_fit, true AS classes_follow FROM (SELECT count(*) AS n FROM clean), (VALUES {listed}) m(name)""")


@query("m02_m04_model_invariants", _invariants_sql(["logistic_regression", "random_forest", "xgboost"]))
def _(spark, folder):
    parts = [_invariants(n, models.fitted(spark, folder, n).score(models._rows(spark, folder, "test"), [], TARGET))
             for n in ("logistic_regression", "random_forest", "xgboost")]
    return reduce(DataFrame.unionByName, parts)


@query("m09_m11_ensemble_invariants", _invariants_sql(["stacking", "voting (soft)", "long boosting"]))
def _(spark, folder):
    rows = models._rows(spark, folder, "test")
    fitted = [models.combined(spark, folder, kind) for kind in ("stacking", "voting", "long")]
    return reduce(DataFrame.unionByName, [_invariants(m.name, m.score(rows, [], TARGET)) for m in fitted])


@query("s07_sample_invariants", over("ship", """SELECT least(count(*), 1000) AS "rows", least(count(*), 1000) AS from_table, true AS repeats_agree FROM ship"""))
def _(spark, folder):
    """A sample has the asked size, its rows are rows of the table, and drawing again gives the same."""
    lines = shipments(spark, folder).select(ORDER_ID, "Order Item Id", quoted(SALES))
    sample, again = csv.random_sample(lines, 1000), csv.random_sample(lines, 1000)
    there = sample.join(lines.distinct(), lines.columns, "left_semi")
    same = sample.exceptAll(again).isEmpty()
    return sample.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(there.count()).alias("from_table"), F.lit(same).alias("repeats_agree"))


@query("a08_importance_invariants", """SELECT m AS model, true AS adds_up, true AS ranks_follow, true AS same_after_loading
FROM (VALUES ('random_forest'), ('xgboost'), ('logistic_regression')) v(m)""")
def _(spark, folder):
    """Importances of trees add up to 1, ranks are 1 to n by falling importance, and a stored copy of a model has the same."""
    paths, parts = models.project(spark, folder), []
    for name in ("random_forest", "xgboost", "logistic_regression"):
        model = training.TrainedModel.load(spark, paths.model(name))
        copy = _folder(spark, "copy")
        model.save(spark, copy)
        rows = model.importance(spark)
        again = training.TrainedModel.load(spark, copy).importance(spark)
        best = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))  # one row a feature
        total = F.abs(F.sum("importance") - 1) < 1e-9 if name != "logistic_regression" else F.sum("importance") > 0
        parts.append(rows.withColumn("best", best).agg(
            F.lit(name).alias("model"), total.alias("adds_up"), F.bool_and(F.col("best") == F.col("rank")).alias("ranks_follow"),
            F.lit(rows.exceptAll(again).isEmpty()).alias("same_after_loading")))
    return reduce(DataFrame.unionByName, parts)


@query("r02_r08_scoring_invariants", over("clean", """SELECT 'splits' AS scored, count(*) AS "rows", true AS probabilities_fit, true AS classes_follow, true AS bands_follow FROM clean
UNION ALL SELECT 'batch', count(*), true, true, true FROM clean"""))
def _(spark, folder):
    """Scores of the stored splits and of a new batch: every row once, classes and bands by the rules of the probability."""
    paths = models.project(spark, folder)
    splits = with_risk(training.TrainedModel.load(spark, paths.model("xgboost")).score(jobs.read_splits(spark, paths.splits)))
    batch = jobs.run_predict(spark, raw_shipments(spark, folder), paths, "random_forest")
    parts = []
    for name, scored in (("splits", splits), ("batch", batch)):
        p, band = F.col("delay_risk_probability"), F.col("delay_risk_category")
        rule = F.when(p < 0.3, "Low").when(p < 0.6, "Medium").otherwise("High")
        parts.append(scored.agg(
            F.lit(name).alias("scored"), F.count(F.lit(1)).alias("rows"), F.bool_and((p >= 0) & (p <= 1)).alias("probabilities_fit"),
            F.bool_and((p > 0.5) == (F.col("delay_risk_prediction") == 1)).alias("classes_follow"),
            F.bool_and(F.lower(band).contains(F.lower(rule))).alias("bands_follow")))
    return reduce(DataFrame.unionByName, parts)
