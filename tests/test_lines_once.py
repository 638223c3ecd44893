"""The order lines are joined, and written, once for all that is read of them."""

import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larchmart.operators import quality as Q
from larchmart.plans import models as M
from larchmart.plans import registry
from larchmart.plans.warehouse import Warehouse

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"
PARTS = "p_partkey long, p_name string, p_type string, p_retailprice double"


def day(n):
    return datetime(1996, 3, n, 5)


@pytest.fixture
def tables(spark, tmp_path):
    folder = f"{tmp_path}/tables"

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    # order 2 has its header twice, on two days; customer 9 is none; order 6 has a line without a quantity
    heads = [(1, 10, "F", 1), (2, 10, "O", 1), (2, 7, "F", 2), (3, 9, "P", 2), (4, 7, "P", 3), (None, 7, "F", 1), (6, 8, "F", 3)]
    put("orders", [(k, c, s, 50.25, day(d), "1-URGENT" if k == 3 else "2-HIGH") for k, c, s, d in heads], ORDERS)
    lines = [(1, 1, 3.0), (1, 2, 2.0), (2, 1, 5.0), (2, 1, 5.0), (3, 2, 1.0), (4, 9, 1.0), (4, 2, 4.0), (5, 1, 1.0), (None, 1, 1.0), (6, 1, None), (6, 2, 1.0)]
    put("lineitem", [(o, p, 1, 1 if o == 2 else i, q, 0.05, day(4)) for i, (o, p, q) in enumerate(lines)], LINES)
    put("part", [(1, "one", "BOX", 10.10), (2, "two", "BAG", 3.33), (2, "two again", "BAG", 3.33)], PARTS)
    put("nation", [(k, f"N{k}") for k in range(25)], "n_nationkey int, n_name string")
    put("customer", [(k, f"C#{k}", 0, "S") for k in (7, 8, 10)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("events", [(k, day(1), 7, "view") for k in range(4)], "event_id long, ts timestamp_ntz, user_id long, event_type string")
    return folder


def _rows(df):
    return sorted(map(repr, df.collect()))


def _written(store):
    return {p.name.split("-")[0] for p in pathlib.Path(store).iterdir()}


def _two(spark, tables, tmp_path):
    return Warehouse.from_driver_tables(spark, tables, store=f"{tmp_path}/store"), Warehouse.from_driver_tables(spark, tables)


def test_daily_sales_are_summed_up_without_a_written_fact(spark, tables, tmp_path):
    w, plain = _two(spark, tables, tmp_path)
    want = M.fct_daily_sales(plain.table("fct_orders"))
    assert w.fct_daily_sales.dtypes == want.dtypes and _rows(w.table("fct_daily_sales")) == _rows(want)
    assert want.count() == 3 and _rows(w.q4()) == _rows(plain.q4())
    assert "fct_orders" not in _written(w.store)


def test_orders_of_customers_need_no_written_fact(spark, tables, tmp_path):
    w, plain = _two(spark, tables, tmp_path)
    want = M.customer_orders(M.customer_order_lines(plain.table("fct_orders"), plain.table("dim_customers")))
    assert _rows(M.customer_orders(w.order_grain())) == _rows(want) and want.count() == 4
    assert "fct_orders" not in _written(w.store)


def test_margins_and_fact_come_from_one_table_of_lines(spark, tables, tmp_path):
    w, plain = _two(spark, tables, tmp_path)
    margins, fact = w.line_part({"order_item_id", "order_id", "net_revenue"}, {"order_item_id", "fct_order_item_key", "product_key", "order_date_key", "net_revenue"})
    for got, model in ((margins, "int_order_margins"), (fact, "fct_orders")):
        want = plain.table(model).select(*got.columns)
        assert got.schema.simpleString() == want.schema.simpleString() and _rows(got) == _rows(want)
    assert fact.count() > margins.count()  # a product that is there twice
    assert w.line_part({"order_id"}, {"net_revenue"})[0] is margins
    assert len([p for p in pathlib.Path(w.store).iterdir() if p.name.startswith("order_lines-part")]) == 1
    assert _rows(w.table("mart_customer_360")) == _rows(plain.table("mart_customer_360"))


@pytest.mark.parametrize("query", ["dq_unique", "dq_report", "dq_report_faulty"])
def test_checks_write_no_fact(spark, tables, tmp_path, query, monkeypatch):
    w, plain = _two(spark, tables, tmp_path)
    monkeypatch.setattr(registry, "wh", lambda *_: w)
    got = registry.QUERIES[query](spark, tables)
    if query == "dq_unique":
        assert _rows(got) == _rows(Q.run_checks(plain.table, registry._checks_of("unique")))
    else:
        assert got.count() == 213
    assert "order_lines" in _written(w.store) and "fct_orders" not in _written(w.store)


def test_hex_keys_are_counted_as_they_are(spark):
    key = "0123456789abcdef" * 2
    values = [key, key, key.upper(), key[:31], key + "0", key + "\n", key[:31] + "g", key[:31] + "g", "", "", None, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert Q.unique_check(df, Q.Check("unique", "m", "v")).first().violations == 3
    assert df.where("v IS NOT NULL").select(*Q.compact(F.col("v"))).distinct().count() == len({v for v in values if v is not None})
    kinds = dict(df.select(*Q.compact(F.col("v"))).dtypes)
    assert kinds == {"__hex": "binary", "__text": "string"}


def test_rates_that_are_none_raise_only_on_lines_that_are_kept(spark, tables):
    lines = spark.read.parquet(f"{tables}/lineitem.parquet")
    bad = lines.withColumn("l_discount", F.when(F.col("l_partkey") == 9, F.lit(55.5)).otherwise(F.col("l_discount")))
    bad.write.parquet(f"{tables}/more/lineitem.parquet")
    for name in ("orders", "part"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tables}/more/{name}.parquet")
    from larchmart.sources import fixtures

    assert fixtures.order_items(spark, f"{tables}/more").count() == fixtures.order_items(spark, tables).count()
    worse = lines.withColumn("l_discount", F.lit(55.5))
    worse.write.parquet(f"{tables}/worse/lineitem.parquet")
    for name in ("orders", "part"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tables}/worse/{name}.parquet")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        fixtures.order_items(spark, f"{tables}/worse").collect()
