"""The same answers when a third of all lines share one part, order and supplier, and nothing is broadcast."""

import pytest

import __spark_entry__ as contract
from tests.compare import TABLES, connect, difference

QUERIES = """region_profit store_month_pnl top_products_revenue top_products_profit device_payment segment_revenue
order_cube period_week current_inventory stock_trend post_financials monthly_demand replenishment_plan
promo_profit_corr store_features sales_dedup invoice_flatten landing_ingest live_stats""".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables as folders of several files, the way a cluster holds them."""
    base = tmp_path_factory.mktemp("skewed")
    con = connect("/root/testdata/sf0.001")
    for table in TABLES:
        rows = "*"
        if table == "lineitem":
            rows = """* EXCLUDE (hot, n) REPLACE (
                                 CASE WHEN hot THEN 1 ELSE l_partkey END AS l_partkey,
                                 CASE WHEN hot THEN 1 ELSE l_orderkey END AS l_orderkey,
                                 CASE WHEN hot THEN 1 ELSE l_suppkey END AS l_suppkey,
                                 CASE WHEN hot THEN CAST(n AS INTEGER) ELSE l_linenumber END AS l_linenumber)"""
            source = "(SELECT *, n % 3 = 0 AS hot FROM (SELECT *, row_number() OVER () AS n FROM lineitem))"
        else:
            source = table
        con.execute(f"COPY (SELECT {rows} FROM {source}) TO '{base}/{table}-one.parquet' (FORMAT parquet)")
        spark.read.parquet(f"{base}/{table}-one.parquet").repartition(3).write.parquet(f"{base}/{table}.parquet")
    return str(base)


@pytest.fixture(scope="module")
def duck(folder):
    con = connect("/root/testdata/sf0.001")
    for table in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{folder}/{table}-one.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_skewed(spark, folder, duck, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(contract.queries()[name](spark, folder), duck, contract.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
