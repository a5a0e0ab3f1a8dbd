"""Column names, value domains and fixed settings of the order-line table."""

from __future__ import annotations

from pyspark.sql import types as T

SEED = 42

TARGET = "Late_delivery_risk"
ORDER_ID = "Order Id"
ORDER_DATE = "order date (DateOrders)"
SHIP_DATE = "shipping date (DateOrders)"
DATE_COLUMNS = [ORDER_DATE, SHIP_DATE]
REAL_DAYS = "Days for shipping (real)"
SCHEDULED_DAYS = "Days for shipment (scheduled)"
SHIPPING_MODE = "Shipping Mode"
DISCOUNT = "Order Item Discount Rate"
QUANTITY = "Order Item Quantity"
ITEM_PRICE = "Order Item Product Price"
SALES = "Sales"
CATEGORY = "Category Name"
PRICE = "Product Price"
MARKET = "Market"
REGION = "Order Region"
COUNTRY = "Order Country"
CITY = "Order City"
SEGMENT = "Customer Segment"

# Columns every input table must have.
REQUIRED = [
    TARGET, REAL_DAYS, SCHEDULED_DAYS, SHIPPING_MODE, DISCOUNT, QUANTITY,
    ITEM_PRICE, SALES, CATEGORY, PRICE, MARKET, REGION, COUNTRY, CITY, SEGMENT,
    ORDER_DATE, SHIP_DATE, ORDER_ID,
]
# Columns that are standardised, and columns made numeric.
CATEGORICALS = [SHIPPING_MODE, CATEGORY, MARKET, REGION, SEGMENT]
NUMERICALS = [REAL_DAYS, SCHEDULED_DAYS, DISCOUNT, QUANTITY, ITEM_PRICE]

# Columns known only after delivery.
LEAKY = [
    REAL_DAYS, "shipping_lead_time_variance", "shipping_time_ratio",
    "order_processing_time", "Delivery Status", "Order Status",
]

# Accepted numeric ranges.
RANGES = {
    REAL_DAYS: (0, 365),
    SCHEDULED_DAYS: (0, 365),
    DISCOUNT: (0, 1),
    QUANTITY: (1, 10000),
    ITEM_PRICE: (0, 1e9),
    SALES: (0, 1e9),
}

# Accepted category spellings.
DOMAINS = {
    SHIPPING_MODE: ["Standard Class", "First Class", "Second Class", "Same Day"],
    SEGMENT: ["Consumer", "Corporate", "Home Office"],
    MARKET: ["LATAM", "Europe", "Pacific Asia", "USCA", "Africa"],
}
# Accepted dates.
DATE_RANGE = ("2010-01-01", "2030-01-01")

# Personal data, internal keys and profit columns.
UNUSED = [
    "Product Description", "Order Zipcode", "Customer Lname", "Customer Fname",
    "Customer Email", "Customer Password", "Customer Street", "Customer Zipcode",
    "Order Item Cardprod Id", "Order Item Id", "Product Card Id",
    "Product Category Id", "Department Id", "Customer Id", "Order Customer Id",
    "Product Image", "Order Profit Per Order", "Benefit per order",
]
# Rows without these are dropped.
CRITICAL = [TARGET, ORDER_ID]

# How missing values are filled.
NUMERIC_FILL = {
    REAL_DAYS: "median",
    SCHEDULED_DAYS: "median",
    DISCOUNT: "zero",
    QUANTITY: "median",
    ITEM_PRICE: "median",
    SALES: "median",
    PRICE: "median",
}
CATEGORY_FILL = {
    SHIPPING_MODE: "mode",
    CATEGORY: "Unknown",
    MARKET: "mode",
    REGION: "mode",
    COUNTRY: "mode",
    CITY: "mode",
    SEGMENT: "mode",
}

# Percentile bounds for winsorising.
WINSOR = {
    REAL_DAYS: (0.01, 0.99),
    SCHEDULED_DAYS: (0.01, 0.99),
    QUANTITY: (0.0, 0.99),
    ITEM_PRICE: (0.0, 0.99),
    SALES: (0.0, 0.99),
}

# Risk and frequency scores per category.
MODE_RISK = {"Same Day": 0.2, "First Class": 0.8, "Second Class": 0.5, "Standard Class": 0.6}
MARKET_RISK = {"USCA": 0.3, "EUROPE": 0.5, "LATAM": 0.7, "PACIFIC ASIA": 0.6, "AFRICA": 0.8}
SEGMENT_FREQUENCY = {"Consumer": 0.5, "Corporate": 0.7, "Home Office": 0.4}
WEEKDAY_RISK = {0: 0.7, 1: 0.4, 2: 0.3, 3: 0.4, 4: 0.6, 5: 0.5, 6: 0.5}
EXPEDITED = ["Same Day", "First Class"]

# Columns that never become features.
NON_FEATURES = [
    ORDER_ID, "Delivery Status", "Order Status", SHIPPING_MODE, SEGMENT, MARKET,
    REGION, CATEGORY, COUNTRY, CITY, "Order State", "Customer City",
    "Customer State", "Customer Country", "Department Name", "Product Name",
    "Product Status", "Type",
]

# Split ratios, edges of the risk bands, priorities of alerts, and gates of a model.
SPLIT_RATIOS = (0.70, 0.15, 0.15)
SPLITS = ("train", "validation", "test")
RISK_BANDS = (0.3, 0.6)
ALERT_PRIORITY = {"high": 1, "medium": 2, "low": 3}
GATES = {"accuracy": 0.80, "recall": 0.75, "roc_auc": 0.80}

# Types of the order-line columns as stored in CSV exports.
COLUMN_TYPES: dict[str, T.DataType] = {
    "Type": T.StringType(),
    "Delivery Status": T.StringType(),
    "Category Name": T.StringType(),
    "Customer City": T.StringType(),
    "Customer Country": T.StringType(),
    "Customer Email": T.StringType(),
    "Customer Fname": T.StringType(),
    "Customer Lname": T.StringType(),
    "Customer Password": T.StringType(),
    "Customer Segment": T.StringType(),
    "Customer State": T.StringType(),
    "Customer Street": T.StringType(),
    "Department Name": T.StringType(),
    "Market": T.StringType(),
    "Order City": T.StringType(),
    "Order Country": T.StringType(),
    "Order Region": T.StringType(),
    "Order State": T.StringType(),
    "Order Status": T.StringType(),
    "Product Description": T.StringType(),
    "Product Image": T.StringType(),
    "Product Name": T.StringType(),
    "Shipping Mode": T.StringType(),
    "order date (DateOrders)": T.StringType(),
    "shipping date (DateOrders)": T.StringType(),
    "Category Id": T.LongType(),
    "Customer Id": T.LongType(),
    "Department Id": T.LongType(),
    "Order Customer Id": T.LongType(),
    "Order Id": T.LongType(),
    "Order Item Cardprod Id": T.LongType(),
    "Order Item Id": T.LongType(),
    "Product Card Id": T.LongType(),
    "Product Category Id": T.LongType(),
    "Days for shipping (real)": T.IntegerType(),
    "Days for shipment (scheduled)": T.IntegerType(),
    "Late_delivery_risk": T.IntegerType(),
    "Product Status": T.IntegerType(),
    "Benefit per order": T.DoubleType(),
    "Sales per customer": T.DoubleType(),
    "Customer Zipcode": T.DoubleType(),
    "Latitude": T.DoubleType(),
    "Longitude": T.DoubleType(),
    "Order Item Discount": T.DoubleType(),
    "Order Item Discount Rate": T.DoubleType(),
    "Order Item Product Price": T.DoubleType(),
    "Order Item Profit Ratio": T.DoubleType(),
    "Order Item Quantity": T.DoubleType(),
    "Sales": T.DoubleType(),
    "Order Item Total": T.DoubleType(),
    "Order Profit Per Order": T.DoubleType(),
    "Order Zipcode": T.DoubleType(),
    "Product Price": T.DoubleType(),
}
