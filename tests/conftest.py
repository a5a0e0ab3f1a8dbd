from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lateline.schema import DOMAINS, MARKET, SEGMENT, SHIPPING_MODE  # noqa: E402
from lateline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


MODES, SEGMENTS, MARKETS = DOMAINS[SHIPPING_MODE], DOMAINS[SEGMENT], DOMAINS[MARKET]
REGIONS = ["Harbour North", "Harbour South", "Plateau"]
CATEGORIES = ["Garden", "Kitchenware", "Lighting", "Toys", "Outdoor"]

SCHEMA = """`Order Id` string, `order date (DateOrders)` timestamp_ntz, `shipping date (DateOrders)` timestamp_ntz,
`Days for shipping (real)` int, `Days for shipment (scheduled)` int, Late_delivery_risk int, `Shipping Mode` string,
`Order Item Discount Rate` double, `Order Item Quantity` int, `Order Item Product Price` double, Sales double,
`Category Name` string, `Product Price` double, Market string, `Order Region` string, `Order Country` string,
`Order City` string, `Customer Segment` string"""


def order_rows(count: int = 100) -> list[tuple]:
    """Order lines of some days, every value a function of the line number."""
    start, rows = dt.datetime(2019, 3, 4), []
    for i in range(count):
        mixed = (i * 7919 + 13) % 1009
        real, planned = mixed % 8 + 1, (i * 31) % 4 + 2
        rows.append((
            f"ln-{i:04d}", start + dt.timedelta(days=i), start + dt.timedelta(days=i + 1 + mixed % 5), real, planned,
            int(real > planned), MODES[mixed % 4], (mixed % 27) / 100, mixed % 8 + 1, 12.5 + mixed % 380,
            40.0 + (mixed * 3) % 870, CATEGORIES[mixed % 5], 12.5 + mixed % 380, MARKETS[i % 5], REGIONS[mixed % 3],
            "Norway", "Bergen", SEGMENTS[mixed % 3]))
    return rows


@pytest.fixture(scope="session")
def order_lines(spark):
    return spark.createDataFrame(order_rows(), SCHEMA).cache()
