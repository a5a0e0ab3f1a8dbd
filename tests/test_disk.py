"""What the preparation moves and leaves on disk."""

from __future__ import annotations

import os
import re

import pytest

from lateline import session
from lateline.operators.cleaning import distinct_rows, drop_unused
from lateline.plans import catalog
from lateline.plans.shipments import raw_shipments
from lateline.session import job, stage

TABLES = {
    "region": "SELECT 1 AS r_regionkey, 'ASIA' AS r_name",
    "nation": "SELECT 1 AS n_nationkey, 1 AS n_regionkey, 'JAPAN' AS n_name",
    "customer": "SELECT id AS c_custkey, 1 AS c_nationkey, concat('name ', id) AS c_name, 'BUILDING' AS c_mktsegment FROM range(5)",
    "part": "SELECT id AS p_partkey, 'small tin' AS p_type, 'brand' AS p_brand, concat('part ', id) AS p_name, 9.5D AS p_retailprice FROM range(7)",
    "orders": """SELECT id AS o_orderkey, id % 5 AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority,
        TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(id) AS o_orderdate FROM range(30)""",
    "lineitem": """SELECT id DIV 2 AS l_orderkey, id % 7 AS l_partkey, CAST(id % 2 + 1 AS INT) AS l_linenumber, CAST(id % 50 + 1 AS DOUBLE) AS l_quantity,
        CAST(id AS DOUBLE) AS l_extendedprice, 0.05D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag,
        TIMESTAMP_NTZ'2020-01-03 00:00:00' + make_dt_interval(id DIV 2) AS l_shipdate FROM range(60)"""}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, sql in TABLES.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_copies_are_found_without_a_shuffle_of_whole_rows(spark, tables):
    """As with parts too many to be sent to every task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = distinct_rows(drop_unused(raw_shipments(spark, tables)))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"hashpartitioning\((.*), \d+\)", plan)
    assert keys and all("," not in k for k in keys)
    assert rows.count() == 60 and rows.agg({"_copies": "sum"}).first()[0] == 90


def test_rows_written_on_the_way_to_the_cleaned_table_are_deleted(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(catalog, "_derived", {})
    assert catalog.cleaned(spark, tables).count() == 60
    assert [n.split("-")[0] for n in os.listdir(tmp_path)] == ["cleaned"]


def test_lasting_tables_stay_until_the_next_job_ends(spark):
    with job(spark):
        with job(spark):
            kept, gone = (stage(spark.range(3), "some", lasting=w).inputFiles()[0] for w in (True, False))
        there = [os.path.exists(f.removeprefix("file://")) for f in (kept, gone)]
        assert there == [True, False]
    assert not os.path.exists(kept.removeprefix("file://"))
