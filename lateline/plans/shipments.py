"""Order-line views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.schema import (CATEGORY, CITY, COUNTRY, DISCOUNT, ITEM_PRICE, MARKET, ORDER_DATE, ORDER_ID,
                             PRICE, QUANTITY, REAL_DAYS, REGION, SALES, SCHEDULED_DAYS, SEGMENT, SHIP_DATE,
                             SHIPPING_MODE, TARGET)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _choice(column: str, cases: dict[str, object], default=None) -> Column:
    chain = None
    for key, value in cases.items():
        test = F.col(column) == key
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain if default is None else chain.otherwise(default)


def shipments(spark: SparkSession, folder: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per order line, under the order-line column names.

    Orders meet their customer before they meet the lines, so the largest table
    is shuffled for one join on the part key and one on the order key. The order key comes last:
    rows then lie by their order id, and copies of whole rows are found without another shuffle.
    """
    placed = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    priority = F.left(F.col("o_orderpriority"), F.lit(1))
    lines = lines.withColumns({
        "_priority": priority,
        "_real": F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(7)).cast("int"),
    }).withColumn("_scheduled", _choice("_priority", {"1": 0, "2": 1, "3": 2}, 4))
    late = (F.col("_real") > F.col("_scheduled")).cast("int")
    return lines.select(
        F.col("l_returnflag").alias("Type"),
        F.col("_real").alias(REAL_DAYS),
        F.col("_scheduled").alias(SCHEDULED_DAYS),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("Benefit per order"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Sales per customer"),
        F.when(late == 1, "Late delivery").otherwise("Shipping on time").alias("Delivery Status"),
        late.alias(TARGET),
        F.col("p_type").alias(CATEGORY),
        F.col("n_name").alias("Customer Country"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Customer Email"),
        F.col("c_name").alias("Customer Fname"),
        F.col("c_custkey").alias("Customer Id"),
        _choice("c_mktsegment", {
            "AUTOMOBILE": "Consumer", "HOUSEHOLD": "Consumer", "BUILDING": "Corporate",
            "MACHINERY": "Corporate", "FURNITURE": "Home Office"}).alias(SEGMENT),
        F.col("p_brand").alias("Department Name"),
        _choice("r_name", {
            "AFRICA": "Africa", "AMERICA": "USCA", "ASIA": "Pacific Asia", "EUROPE": "Europe",
            "MIDDLE EAST": "LATAM"}).alias(MARKET),
        F.concat(F.col("n_name"), F.lit(" "), (F.col("c_custkey") % 10).cast("string")).alias(CITY),
        F.col("n_name").alias(COUNTRY),
        F.col("o_orderdate").alias(ORDER_DATE),
        F.col("l_orderkey").alias(ORDER_ID),
        F.col("l_discount").alias(DISCOUNT),
        F.col("l_linenumber").alias("Order Item Id"),
        F.col("p_retailprice").alias(ITEM_PRICE),
        F.col("l_quantity").alias(QUANTITY),
        F.col("l_extendedprice").alias(SALES),
        F.col("n_name").alias(REGION),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("l_partkey").alias("Product Card Id"),
        F.col("p_name").alias("Product Name"),
        F.col("p_retailprice").alias(PRICE),
        F.col("l_shipdate").alias(SHIP_DATE),
        _choice("_priority", {"1": "Same Day", "2": "First Class", "3": "Second Class"},
                "Standard Class").alias(SHIPPING_MODE),
        *[F.col(name) for name in extra],
    )


def raw_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines with gaps, copies, outliers and untidy spellings."""
    base = shipments(spark, folder)
    item, quantity = F.col("Order Item Id"), F.col(QUANTITY)

    def gap(name: str, where: Column) -> Column:
        return F.when(~where, F.col(f"`{name}`"))

    mode = F.col(SHIPPING_MODE)
    dirty = base.withColumns({
        TARGET: gap(TARGET, (item == 7) & (quantity == 50)),
        REAL_DAYS: F.when(item == 7, None).when((item == 1) & (quantity == 50), 60)
                    .otherwise(F.col(f"`{REAL_DAYS}`")),
        SHIPPING_MODE: F.when(item == 6, None)
                        .when(item == 2, F.concat(F.lit("  "), F.upper(mode), F.lit(" ")))
                        .when(item == 1, F.lower(mode)).otherwise(mode),
        MARKET: gap(MARKET, (item == 6) & (quantity > 40)),
        SALES: F.when(item == 5, None).when(quantity == 50, F.col(SALES) * 100).otherwise(F.col(SALES)),
        DISCOUNT: gap(DISCOUNT, item == 4),
        CATEGORY: F.when(item == 3, None).when(item == 2, F.lower(F.col(CATEGORY))).otherwise(F.col(CATEGORY)),
        REGION: gap(REGION, (item == 5) & (quantity < 10)),
        QUANTITY: gap(QUANTITY, (item == 3) & (quantity < 5)),
        ORDER_DATE: gap(ORDER_DATE, (item == 7) & (quantity == 49)),
    })
    copies = F.sequence(F.lit(1), F.when(item == 1, 2).otherwise(1))
    return dirty.withColumn("_copy", F.explode(copies)).drop("_copy")
