"""Built models by name, and damaged rows for every check."""

import tempfile

import pytest
from test_build import CFG, _raw

from larchmart.operators import quality as Q
from larchmart.operators.faults import fault_of, faults_of, with_faults
from larchmart.plans import build as warehouse_build
from larchmart.plans.catalog import register_tables


def test_build_then_read_by_name_and_swap(spark, raw):
    base = tempfile.mkdtemp(prefix="lm-cat-")
    cfg = CFG.with_(prod_targets=())
    warehouse_build.build(spark, _raw(raw), cfg, f"{base}/one", target="cat", register=f"{base}/db")
    assert spark.table("cat_marts.fct_orders").count() == 1
    assert {t.name for t in spark.catalog.listTables("cat_staging")} == {f"stg_{e}" for e in ("customers", "products", "sessions", "orders", "order_items")}
    # a build that fails leaves the tables as they are
    with pytest.raises(Q.QualityGateError):
        warehouse_build.build(spark, _raw(raw, dup_order=True), cfg, f"{base}/two", target="cat", register=f"{base}/db")
    assert spark.table("cat_staging.stg_orders").count() == 1
    # other files, and other columns, under the same name
    spark.table("cat_marts.fct_orders").union(spark.table("cat_marts.fct_orders")).write.parquet(f"{base}/three")
    register_tables(spark, [("fct_orders", "marts", f"{base}/three")], f"{base}/db", cfg, "cat")
    assert spark.table("cat_marts.fct_orders").count() == 2
    spark.range(3).write.parquet(f"{base}/four")
    register_tables(spark, [("fct_orders", "marts", f"{base}/four")], f"{base}/db", cfg, "cat")
    assert spark.table("cat_marts.fct_orders").columns == ["id"] and spark.table("cat_marts.fct_orders").count() == 3


def test_every_check_has_a_fault_that_breaks_it(spark, raw):
    """On the rows of a small build each fault alone makes its check find something."""
    from pyspark.sql import functions as F

    checks = Q.declared_checks(CFG)
    for model in ("stg_orders", "stg_products"):
        clean = spark.createDataFrame(
            [(f"O{i}", "C", None, "completed", "paypal", 5, 1, 4) for i in range(10)],
            "order_id string, customer_id string, session_id string, order_status string, payment_method string, gross_amount int, discount_amount int, net_revenue int",
        ) if model == "stg_orders" else spark.createDataFrame(
            [(f"P{i}", f"S{i}", "n", "Toys", 1, 2) for i in range(10)],
            "product_id string, sku string, product_name string, category string, unit_cost int, retail_price int",
        )
        own = [c for c in checks if c.model == model and c.kind != "relationships" and set(fault_of(c)) <= set(clean.columns)]
        assert sum(r.violations for r in Q.run_checks(lambda m: clean, own).collect()) == 0
        for c in own:
            bad = with_faults(clean, model, [c])
            assert bad.count() == clean.count() + 1, c
            assert Q.run_checks(lambda m: bad, [c]).first().violations > 0, c
    assert len(faults_of("fct_orders", checks)) == len({str(f) for f in faults_of("fct_orders", checks)})
    assert F is not None


def test_faulty_report_finds_something_for_every_kind(spark):
    import __spark_entry__ as E

    rows = E.queries()["dq_report_faulty"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 213
    silent = [(r.check_name, r.model, r.column_name) for r in rows if r.violations == 0]
    assert silent == []


def test_faulty_report_writes_no_damaged_copies(spark, monkeypatch):
    """The checks on damaged rows read them as they are made."""
    from larchmart.plans import registry

    rows = spark.createDataFrame([(f"S{i}", "C1") for i in range(20)], "session_id string, customer_id string")
    names = []
    monkeypatch.setattr(registry, "BUILD_ORDER", [("stg_sessions", "staging", "table")])
    monkeypatch.setattr(registry, "_DECLARED", [registry.Q.Check("not_null", "stg_sessions", "customer_id"), registry.Q.Check("unique", "stg_sessions", "session_id")])
    monkeypatch.setattr(registry, "_SINGULAR_KEYS", {})
    monkeypatch.setattr(registry, "work_dir", lambda s: names.append("folder"))
    monkeypatch.setattr(registry, "wh", lambda s, d: type("W", (), {"table": staticmethod(lambda m: rows)})())
    report = {r.check_name: r.violations for r in registry.dq_report_faulty(spark, "nowhere").collect()}
    assert report == {"not_null": 2, "unique": 4} and not names
