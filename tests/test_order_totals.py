"""Order totals summed up from the order items that are written."""

from datetime import datetime

import pytest

from larchmart.plans.warehouse import Warehouse
from larchmart.sources import fixtures

DAY = datetime(1996, 3, 1)
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"
PARTS = "p_partkey long, p_name string, p_type string, p_retailprice double"


@pytest.fixture
def tables(spark, tmp_path):
    folder = f"{tmp_path}/tables"

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    # 1: two lines; 2: its header twice; 3: no lines; 4: its part is missing; None: no key; 6: no quantity
    keys = (1, 2, 2, 3, 4, None, 6)
    put("orders", [(k, 7, "F", 50.25, DAY, "1-URGENT") for k in keys], ORDERS)
    lines = [(1, 1, 3.0), (1, 2, 2.0), (2, 1, 5.0), (4, 9, 1.0), (5, 1, 1.0), (None, 1, 1.0), (6, 1, None), (1, 1, 3.0)]
    put("lineitem", [(o, p, 1, i, q, 0.05, DAY) for i, (o, p, q) in enumerate(lines)], LINES)
    put("part", [(1, "one", "BOX", 10.10), (2, "two", "BAG", 3.33)], PARTS)
    put("nation", [(0, "N")], "n_nationkey int, n_name string")
    put("customer", [(7, "C#7", 0, "S")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("events", [(1, DAY, 7, "view")], "event_id long, ts timestamp_ntz, user_id long, event_type string")
    return folder


def _sorted(df):
    return sorted(df.collect(), key=repr)


def test_totals_of_written_items_are_those_of_the_lines(spark, tables, tmp_path):
    w = Warehouse.from_driver_tables(spark, tables, store=f"{tmp_path}/store")
    w.table("stg_order_items")
    plan = w.stg_orders._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan  # the lines are not priced and shuffled again
    plain = Warehouse.from_driver_tables(spark, tables).table("stg_orders")
    assert w.stg_orders.schema == plain.schema
    assert _sorted(w.table("stg_orders")) == _sorted(plain) and plain.count() == 7


def test_order_totals_have_the_same_types(spark, tables):
    items = Warehouse.from_driver_tables(spark, tables).table("stg_order_items")
    assert fixtures.orders(spark, tables, items).schema == fixtures.orders(spark, tables).schema
