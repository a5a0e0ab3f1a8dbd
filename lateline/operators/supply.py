"""Supplier, stock and site reports over order lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted, ratio, round_half_even
from lateline.operators.ranks import with_running_totals
from lateline.operators.risk import alert_priority
from lateline.session import stage

# Cumulative value shares of the classes, delay bands and tiers.
ABC_SHARES = {"A": 0.80, "B": 0.95}
KPI_WEIGHTS = {"on_time_rate": 0.5, "delay": 0.3, "volume": 0.2}
TIERS = [("strategic", 0.75, "extend volume"), ("preferred", 0.50, "keep terms"),
         ("watch", 0.25, "agree a recovery plan"), ("exit", 0.0, "look for alternatives")]


def merge_sites(tables: Mapping[str, DataFrame], rename: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Rows of several sites under standard names; columns a site lacks are null."""
    parts = []
    for site, df in tables.items():
        names = (rename or {}).get(site, {})
        parts.append(df.select(*[quoted(c).alias(names.get(c, c)) for c in df.columns], F.lit(site).alias("site")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def inventory_by_sku(df: DataFrame, sku: str, quantity: str, value: str) -> DataFrame:
    return df.groupBy(quoted(sku).alias("sku")).agg(
        F.count(F.lit(1)).alias("order_lines"), F.sum(quoted(quantity)).alias("quantity"),
        F.sum(quoted(value)).alias("value"))


def abc_classes(inventory: DataFrame) -> DataFrame:
    """A, B or C by the share of value reached when SKUs are taken from the most valuable down."""
    inventory = stage(inventory, "inventory")  # the whole and the running sum both read it
    running = with_running_totals(inventory, [F.col("value").desc(), F.col("sku")], {"reached": F.col("value")},
                                  staged=True)
    whole = inventory.agg(F.sum("value").alias("whole")).first()["whole"]
    share = ratio(F.col("reached"), F.lit(whole))
    return running.select("sku", "quantity", "value", share.alias("cumulative_share"),
                          F.when(share <= ABC_SHARES["A"], "A").when(share <= ABC_SHARES["B"], "B")
                          .otherwise("C").alias("abc_class"))


def allocation_gaps(stock: DataFrame, demand: DataFrame, site: str, stock_column: str, demand_column: str) -> DataFrame:
    """Share of stock minus share of demand per site: positive means too much stock."""
    held = stock.groupBy(quoted(site).alias("site")).agg(F.sum(quoted(stock_column)).alias("stock"))
    asked = demand.groupBy(quoted(site).alias("site")).agg(F.sum(quoted(demand_column)).alias("demand"))
    both = held.join(asked, "site", "full_outer").na.fill(0.0, ["stock", "demand"])
    totals = both.agg(F.sum("stock").alias("s"), F.sum("demand").alias("d")).first()
    stock_share, demand_share = ratio(F.col("stock"), F.lit(totals["s"])), ratio(F.col("demand"), F.lit(totals["d"]))
    gap = stock_share - demand_share
    return both.select("site", "stock", "demand", stock_share.alias("stock_share"), demand_share.alias("demand_share"),
                       gap.alias("gap"), F.when(gap > 0.01, "reduce").when(gap < -0.01, "increase")
                       .otherwise("keep").alias("recommendation"))


def supplier_delivery(df: DataFrame, supplier: str, real: str, scheduled: str) -> DataFrame:
    """On-time rate and mean delay of each supplier."""
    delay = quoted(real) - quoted(scheduled)
    return df.groupBy(quoted(supplier).alias("supplier")).agg(
        F.count(F.lit(1)).alias("order_lines"), F.avg((delay <= 0).cast("double")).alias("on_time_rate"),
        F.avg(F.greatest(delay, F.lit(0)).cast("double")).alias("average_delay"),
        F.max(delay).alias("worst_delay"))


def delay_severity(delay: Column) -> Column:
    return F.when(delay >= 4, "high").when(delay >= 2, "medium").when(delay > 0, "low")


def delay_alerts(df: DataFrame, keep: Sequence[str], real: str, scheduled: str) -> DataFrame:
    """One alert per late line, with severity and priority."""
    delay = quoted(real) - quoted(scheduled)
    late = df.filter(delay > 0).select(*[quoted(c) for c in keep], delay.alias("delay_days"),
                                       delay_severity(delay).alias("severity"))
    return late.withColumn("alert_priority", alert_priority(F.col("severity")))


def vendor_scores(delivery: DataFrame, weights: Mapping[str, float] = KPI_WEIGHTS) -> DataFrame:
    """Weighted mean of KPIs scaled to [0, 1]; less delay scores higher."""
    spans = delivery.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
                           for c in ("on_time_rate", "average_delay", "order_lines")]).first()

    def scaled(c: str) -> Column:
        low, high = spans[c]["low"], spans[c]["high"]
        if low is None or high == low:
            return F.lit(0.0)
        return (F.col(c) - F.lit(low)) / F.lit(high - low)

    score = (scaled("on_time_rate") * weights["on_time_rate"]
             + (1 - scaled("average_delay")) * weights["delay"] + scaled("order_lines") * weights["volume"])
    return delivery.withColumn("vendor_score", round_half_even(score, 6))


def vendor_tiers(scores: DataFrame) -> DataFrame:
    """Tier and suggestion by percentile rank of the score; equal scores share a rank."""
    counts = scores.groupBy("vendor_score").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_running_totals(counts, [F.col("vendor_score")], {"upto": F.col("n")})
    vendors = scores.count()
    below = (F.col("upto") - F.col("n")).cast("double")
    ranked = ranked.select("vendor_score", (F.coalesce(ratio(below, F.lit(vendors - 1)), F.lit(0.0))).alias("percentile"))
    tier, advice = None, None
    for name, low, text in TIERS:
        test = F.col("percentile") >= low
        tier = F.when(test, name) if tier is None else tier.when(test, name)
        advice = F.when(test, text) if advice is None else advice.when(test, text)
    return scores.join(ranked, "vendor_score").withColumns({"tier": tier, "suggestion": advice})


def transfer_plan(balance: DataFrame, by: Sequence[str], site: str, units: str) -> DataFrame:
    """Moves of whole ``units`` from sites with a surplus to sites with a shortage: ``by, from_site, to_site, units``.

    ``units`` is the surplus of a site, negative for a shortage; rows of a site are added up. Within each
    group of ``by``, surpluses and shortages are laid on a line one after the other, in the order of
    their sites, and what overlaps is a move. So every unit moves once, at most one move a site has
    more than one partner at each end, and the lesser of both sums is moved. A null site is a site, last in the order; null units are zero.

    Prefix sums come from range partitions. The line of a group is cut into as many slots as it has sites, and
    intervals meet by slot, so work and rows follow the sites and not their pairs.
    """
    keys = [quoted(c).alias(f"by{i}") for i, c in enumerate(by)] or [F.lit(0).alias("by0")]
    names = [f"by{i}" for i in range(len(keys))]
    sites = stage(balance.groupBy(*keys, quoted(site).alias("site")).agg(
        F.coalesce(F.sum(quoted(units).cast("long")), F.lit(0)).alias("units")).filter("units != 0").select(
        F.struct(*names).alias("group"), "site", F.abs("units").alias("units"), (F.col("units") > 0).alias("gives")), "balance")
    line = with_running_totals(sites, [F.col("site").asc_nulls_last()], {"until": F.col("units")}, by=["group", "gives"], staged=True)
    spans = line.select("group", "site", "gives", (F.col("until") - F.col("units")).alias("begin"), "until")
    width = sites.groupBy(F.col("group").alias("g")).agg(F.greatest(F.lit(1), F.expr("sum(units) div count(1)")).cast("long").alias("width"))
    slots = F.explode(F.sequence(F.expr("begin div width"), F.expr("(until - 1) div width"))).alias("slot")
    dealt = spans.join(width, F.col("group").eqNullSafe(F.col("g"))).select("group", "site", "gives", "begin", "until", "width", slots)
    giving = dealt.filter("gives").select(F.col("group").alias("g"), "slot", F.col("site").alias("from_site"),
                                          F.col("begin").alias("b"), F.col("until").alias("u"))
    taking = dealt.filter("NOT gives").select("group", F.col("slot").alias("at"), F.col("site").alias("to_site"), "begin", "until", "width")
    low, high = F.greatest("b", "begin"), F.least("u", "until")
    met = giving.join(taking, F.col("g").eqNullSafe(F.col("group")) & (F.col("slot") == F.col("at")) & (low < high)
                      & (F.floor(low / F.col("width")) == F.col("at")))
    return met.select(*[F.col(f"group.by{i}").alias(c) for i, c in enumerate(by)], "from_site", "to_site", (high - low).alias("units"))


def fair_balance(stock: DataFrame, demand: DataFrame, by: Sequence[str], site: str, stock_column: str,
                 demand_column: str) -> DataFrame:
    """Whole units that each site has above (or below) its share of the stock by demand: ``by, site, stock, demand, units``.

    The share is rounded down, and the units that this leaves go one each to the largest remainders,
    ties to the first site, so shares add up to the stock. Without any demand nothing is to move.
    """
    keys = [quoted(c).alias(f"by{i}") for i, c in enumerate(by)] + [quoted(site).alias("site")]
    names = [f"by{i}" for i in range(len(by))]
    both = (stock.select(*keys, quoted(stock_column).cast("long").alias("stock"), F.lit(0).cast("long").alias("demand"))
            .unionByName(demand.select(*keys, F.lit(0).cast("long").alias("stock"), quoted(demand_column).cast("long").alias("demand"))))
    sites = stage(both.groupBy(*names, "site").agg(F.coalesce(F.sum("stock"), F.lit(0)).alias("stock"),
                                                   F.coalesce(F.sum("demand"), F.lit(0)).alias("demand")), "sites")
    group = F.struct(*[F.col(n) for n in names]) if names else F.struct(F.lit(0).alias("by0"))
    keyed = sites.withColumn("group", group)
    totals = keyed.groupBy("group").agg(F.sum("stock").alias("s"), F.sum("demand").alias("d"))
    wide = "cast(stock_all as decimal(19,0)) * cast(demand as decimal(19,0))"
    shared = keyed.join(totals.select(F.col("group").alias("g"), F.col("s").alias("stock_all"), F.col("d").alias("demand_all")),
                        F.col("group").eqNullSafe(F.col("g"))).filter("demand_all > 0").drop("g")
    shared = shared.withColumn("fair", F.expr(f"({wide}) div cast(demand_all as decimal(19,0))")).withColumn(
        "rest", F.expr(f"cast(({wide}) % cast(demand_all as decimal(19,0)) as decimal(38,0))"))
    shared = stage(shared, "shares")
    ranked = with_running_totals(shared, [F.desc("rest"), F.col("site").asc_nulls_last()], {"rank": F.lit(1)}, by=["group"], staged=True)
    open_ = shared.groupBy("group").agg((F.first("stock_all") - F.sum("fair")).alias("open")).withColumnRenamed("group", "g")
    fair = F.col("fair") + (F.col("rank") <= F.col("open")).cast("long")
    return ranked.join(open_, F.col("group").eqNullSafe(F.col("g"))).select(
        *[F.col(n).alias(c) for n, c in zip(names, by)], "site", "stock", "demand", (F.col("stock") - fair).alias("units"))
