"""Each check reports exactly its violation on deliberately damaged input."""

from pyspark.sql import functions as F

from larchmart.operators import quality as Q


def res(df):
    return {(r.check_name, r.column_name): r.violations for r in df.collect()}


def test_scan_checks_fold_and_null_predicate(spark):
    df = spark.createDataFrame(
        [("a", "completed", 5), (None, "completed", None), ("c", "bogus", -1), ("d", "weird", 2), ("e", "weird", 3)],
        "id string, status string, price int",
    )
    checks = [
        Q.Check("not_null", "m", "id"),
        Q.Check("accepted_values", "m", "status", values=("completed",)),
        Q.Check("expression", "m", "price", expression="> 0"),
    ]
    got = res(Q.run_checks(lambda _: df, checks))
    # NULL price passes the predicate; two distinct bad statuses
    assert got == {("not_null", "id"): 1, ("accepted_values", "status"): 2, ("expression", "price"): 1}


def test_unique_and_relationships(spark):
    child = spark.createDataFrame([("a", "p1"), ("a", "p2"), ("b", "zz"), ("c", None), ("d", "zz")], "id string, fk string")
    parent = spark.createDataFrame([("p1",), ("p2",)], "pk string")
    tables = {"child": child, "parent": parent}
    checks = [Q.Check("unique", "child", "id"), Q.Check("relationships", "child", "fk", to_model="parent", to_field="pk")]
    got = res(Q.run_checks(tables.__getitem__, checks))
    assert got == {("unique", "id"): 1, ("relationships", "fk"): 2}


def test_scd2_singular_checks(spark):
    dim = spark.sql(
        """select * from values
        ('k1', 'C1', timestamp_ntz'1900-01-01', timestamp_ntz'2024-06-01', true),
        ('k2', 'C1', timestamp_ntz'2024-03-01', cast(null as timestamp_ntz), true),
        ('k3', 'C2', timestamp_ntz'2024-05-01', timestamp_ntz'2024-05-01', false),
        ('k4', 'C2', timestamp_ntz'2024-05-02', cast(null as timestamp_ntz), true)
        as t(customer_key, customer_id, valid_from, valid_to, is_current)"""
    )
    assert Q.scd2_invalid_intervals(dim).count() == 1
    assert Q.scd2_overlaps(dim).count() == 1
    assert Q.scd2_current_not_single(dim).count() == 1


def test_fact_ties_to_source_detects_fan_out(spark):
    fct = spark.sql("select * from values ('O1', 5.00bd), ('O1', 5.00bd), ('O2', 3.00bd) as t(order_id, net_revenue)")
    stg = spark.sql("select * from values ('O1', 5.00bd), ('O2', 3.00bd) as t(order_id, net_revenue)")
    assert Q.fact_not_tied_to_source(fct, stg).select("order_id").collect()[0][0] == "O1"


def test_freshness_cases(spark):
    raw = {"x": spark.sql("select timestamp_ntz'2025-01-01 00:00:00' as _ingested_at")}
    from datetime import datetime

    from larchmart.config import WarehouseConfig

    cfg = WarehouseConfig()
    got = [Q.freshness(raw, datetime(2025, 1, 1, h), cfg).first().status for h in (1,)]
    got += [Q.freshness(raw, F.lit("2025-01-02 06:00:00").cast("timestamp_ntz"), cfg).first().status]
    got += [Q.freshness(raw, F.lit("2025-01-03 02:00:00").cast("timestamp_ntz"), cfg).first().status]
    assert got == ["pass", "warn", "error"]


def test_declared_check_counts():
    from larchmart.config import WarehouseConfig

    checks = Q.declared_checks(WarehouseConfig())
    kinds = {}
    for c in checks:
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert kinds == {"not_null": 147, "unique": 20, "expression": 18, "accepted_values": 11, "relationships": 11}
    assert len(checks) + len(Q.SINGULAR) == 213


def test_warn_severity_does_not_fail(spark):
    from larchmart.config import WarehouseConfig

    df = spark.createDataFrame([(5, 4), (3, 4)], "retail_price int, unit_cost int")
    checks = [c for c in Q.declared_checks(WarehouseConfig()) if c.model == "stg_products" and c.severity == "warn"]
    assert len(checks) == 1
    r = Q.with_status(Q.run_checks(lambda _: df, checks)).first()
    assert (r.violations, r.severity, r.status) == (1, "warn", "warn")


def test_folded_unique_checks_match_single(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("b", 2, None), ("c", 3, None), ("c", 4, "y"), (None, 4, "y")],
        "s string, n int, t string",
    )
    checks = [Q.Check("unique", "m", c) for c in ("s", "n", "t")]
    folded = res(Q.unique_checks(df, checks))
    single = {k: v for c in checks for k, v in res(Q.unique_check(df, c)).items()}
    assert folded == single == {("unique", "s"): 2, ("unique", "n"): 2, ("unique", "t"): 2}


def test_unique_checks_shuffle_before_they_count(spark):
    """No count per value in the map tasks, which would hold every value of a split."""
    df = spark.range(100).selectExpr("cast(id as string) as s", "cast(id % 60 as string) as t")
    for columns, dupes in ((["s"], {("unique", "s"): 0}), (["s", "t"], {("unique", "s"): 0, ("unique", "t"): 40})):
        found = Q.unique_checks(df, [Q.Check("unique", "m", c) for c in columns])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_COL" in plan and "Aggregate" not in plan[plan.index("REPARTITION_BY_COL"):]
        assert res(found) == dupes
