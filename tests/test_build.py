"""The build gate (a failing error check stops descendants) and metamorphic checks."""

import tempfile

import pytest

from larchmart.config import WarehouseConfig
from larchmart.operators.quality import QualityGateError
from larchmart.plans import build as warehouse_build
from larchmart.plans import models as M

CFG = WarehouseConfig(categories=("Toys",))


def _raw(raw, dup_order=False):
    customers = [{"customer_id": "C1", "email": "a@b", "state": "S", "created_at": "2024-01-01 00:00:00",
                  "updated_at": "2024-01-01 00:00:00"}]
    products = [{"product_id": "P1", "sku": "K1", "product_name": "n", "category": "Toys", "unit_cost": 1,
                 "retail_price": 2, "created_at": "2024-01-01 00:00:00"}]
    sessions = [{"session_id": "S1", "customer_id": "C1", "session_start": "2024-02-01 10:00:00",
                 "session_end": "2024-02-01 10:05:00", "duration_seconds": 300, "device_type": "mobile",
                 "traffic_source": "direct", "page_views_count": 2, "converted": True}]
    order = {"order_id": "O1", "customer_id": "C1", "session_id": "S1", "order_date": "2024-02-01 10:03:00",
             "order_status": "completed", "payment_method": "paypal", "gross_amount": 4, "discount_amount": 0,
             "net_revenue": 4}
    orders = [order, order] if dup_order else [order]
    items = [{"order_item_id": "I1", "order_id": "O1", "product_id": "P1", "quantity": 2, "unit_price": 2,
              "discount_amount": 0, "net_amount": 4}]
    return {"customers": raw(customers), "products": raw(products), "sessions": raw(sessions),
            "orders": raw(orders), "order_items": raw(items)}


def test_clean_build_passes_all_checks(spark, raw):
    out = tempfile.mkdtemp(prefix="lm-build-")
    res = warehouse_build.build(spark, _raw(raw), CFG, out)
    assert res.failed == []
    report = res.checks
    assert report.count() == 213 and report.where("status = 'fail'").count() == 0
    row = res.tables["mart_customer_360"].first()
    # a single purchaser is alone in every quintile: NTILE(5) = 1 for all three
    assert (row.recency_score, row.frequency_score, row.monetary_score, row.rfm_segment) == (1, 1, 1, "Hibernating")


def test_failing_check_stops_descendants(spark, raw):
    out = tempfile.mkdtemp(prefix="lm-build-")
    with pytest.raises(QualityGateError, match="stg_orders") as caught:
        warehouse_build.build(spark, _raw(raw, dup_order=True), CFG, out)
    # nothing downstream of the failed model was written
    import os

    assert os.path.isdir(f"{out}/staging/stg_orders")
    assert not os.path.exists(f"{out}/marts/fct_orders")
    # what does not descend from it is built and tested
    result = caught.value.result
    assert os.path.isdir(f"{out}/marts/dim_customers") and os.path.isdir(f"{out}/marts/dim_products")
    assert result.failed == ["stg_orders"]
    assert set(result.skipped) == {"int_order_margins", "int_sessions", "fct_orders", "fct_sessions", "fct_daily_sales", "mart_customer_360"}
    assert result.checks.where("model = 'dim_customers'").count() > 0


def test_results_independent_of_partitioning(spark):
    """Metamorphic: the customer mart is identical with 1 and 8 shuffle partitions."""
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = E.queries()["customer_360"].__call__(spark, sf)
        from larchmart.plans.warehouse import Warehouse

        one = Warehouse.from_driver_tables(spark, sf).table("mart_customer_360").collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = Warehouse.from_driver_tables(spark, sf).table("mart_customer_360").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a is not None
    assert sorted(map(tuple, one)) == sorted(map(tuple, eight))


def test_dimension_independent_of_input_order(spark):
    """Metamorphic: reshuffling the profile events leaves dim_customers unchanged."""
    from pyspark.sql import functions as F

    from larchmart.config import FIXTURE_CONFIG
    from larchmart.plans import models as M
    from larchmart.plans.warehouse import Warehouse

    stg = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001").table("stg_customers")
    a = M.dim_customers(stg, FIXTURE_CONFIG)
    b = M.dim_customers(stg.repartition(7).orderBy(F.rand(seed=3)), FIXTURE_CONFIG)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_malformed_documents_are_set_apart_and_counted(spark, raw):
    import json

    tables = _raw(raw)
    good = [r.payload for r in tables["order_items"].collect()]
    bad = json.loads(good[0]) | {"order_item_id": "I2", "quantity": "two", "net_amount": "4,0"}
    tables["order_items"] = raw([*good, json.dumps(bad), "{broken", "[1]"])
    out = tempfile.mkdtemp(prefix="lm-build-")
    # the configuration allows them: the build goes through with a warning
    res = warehouse_build.build(spark, tables, CFG.with_(max_reject_share=0.75), out)
    assert res.failed == [] and res.tables["fct_orders"].count() == 1
    row = res.checks.where("check_name = 'parses'").first()
    assert (row.model, row.violations, row.severity, row.status) == ("stg_order_items", 3, "warn", "warn")
    apart = {r.payload: r.bad_keys for r in res.rejects["stg_order_items"].collect()}
    assert apart == {json.dumps(bad): ["quantity", "net_amount"], "{broken": [], "[1]": []}
    # by default any malformed document fails its model, and what descends from it is not built
    with pytest.raises(QualityGateError, match="parses") as caught:
        warehouse_build.build(spark, tables, CFG, tempfile.mkdtemp(prefix="lm-build-"))
    assert caught.value.result.failed == ["stg_order_items"]
    assert set(caught.value.result.skipped) == {"int_order_margins", "fct_orders", "fct_daily_sales", "mart_customer_360"}
    assert caught.value.result.rejects["stg_order_items"].count() == 3


def test_stale_source_stops_its_descendants(spark, raw):
    from datetime import datetime

    tables = _raw(raw)
    sessions = [(r.payload, "2024-12-25 00:00:00") for r in tables["sessions"].collect()]
    tables["sessions"] = raw(sessions)
    out = tempfile.mkdtemp(prefix="lm-build-")
    with pytest.raises(QualityGateError, match="raw_sessions: stale") as caught:
        warehouse_build.build(spark, tables, CFG, out, as_of=datetime(2025, 1, 1, 12))
    res = caught.value.result
    assert res.failed == ["raw_sessions"]
    assert set(res.skipped) == {"stg_sessions", "int_sessions", "fct_sessions", "mart_customer_360"}
    assert res.tables["fct_daily_sales"].count() == 1
    assert {r["source"]: r["status"] for r in res.freshness}["raw_orders"] == "pass"
    # a warning stops nothing
    res = warehouse_build.build(spark, _raw(raw), CFG, tempfile.mkdtemp(prefix="lm-build-"), as_of=datetime(2025, 1, 2, 12))
    assert res.failed == [] and {r["status"] for r in res.freshness} == {"warn"}


def test_margins_are_joined_once(spark, raw):
    """Checks and fact read the written margins; the same rows as without."""
    out = tempfile.mkdtemp(prefix="lm-build-")
    once = warehouse_build.build(spark, _raw(raw), CFG, out)
    twice = warehouse_build.build(spark, _raw(raw), CFG, tempfile.mkdtemp(prefix="lm-build-"), materialize_views=False)
    assert "Join" not in once.tables["int_order_margins"]._jdf.queryExecution().executedPlan().toString()
    for model in ("fct_orders", "mart_customer_360"):
        assert once.tables[model].collect() == twice.tables[model].collect()
    plain = M.int_order_margins(*[twice.tables[f"stg_{e}"] for e in ("order_items", "orders", "products")])
    assert once.tables["int_order_margins"].columns == plain.columns
    assert once.tables["int_order_margins"].collect() == plain.collect()
