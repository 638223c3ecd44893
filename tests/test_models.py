"""Model semantics on hand-written rows (edge cases of the original contract)."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from larchmart.config import WarehouseConfig
from larchmart.functions.columns import surrogate_key
from larchmart.operators.staging import parse_entity
from larchmart.plans import models as M

CFG = WarehouseConfig()


def cust(cid, updated, city="A", state="S1"):
    return {"customer_id": cid, "email": f"{cid}@x", "city": city, "state": state,
            "created_at": "2023-01-01 00:00:00", "updated_at": updated}


def dim(raw, docs):
    return M.dim_customers(parse_entity(raw(docs), "customers"), CFG)


def test_replayed_event_latest_ingest_wins(raw):
    docs = [(cust("C1", "2024-01-01 00:00:00", city="old"), "2025-01-01 00:00:00"),
            (cust("C1", "2024-01-01 00:00:00", city="new"), "2025-01-02 00:00:00")]
    rows = dim(raw, docs).where("customer_id = 'C1'").collect()
    assert len(rows) == 1 and rows[0].city == "new"


def test_replay_tie_is_deterministic(raw):
    a = (cust("C1", "2024-01-01 00:00:00", city="x"), "2025-01-01 00:00:00")
    b = (cust("C1", "2024-01-01 00:00:00", city="y"), "2025-01-01 00:00:00")
    c1 = dim(raw, [a, b]).where("customer_id = 'C1'").first().city
    c2 = dim(raw, [b, a]).where("customer_id = 'C1'").first().city
    assert c1 == c2


def test_versions_anchor_and_intervals(raw):
    d = dim(raw, [cust("C1", "2024-01-01 00:00:00", state="S1"), cust("C1", "2024-06-01 00:00:00", state="S2")])
    rows = d.where("customer_id = 'C1'").orderBy("valid_from").collect()
    assert rows[0].valid_from == datetime(1900, 1, 1) and rows[0].valid_to == datetime(2024, 6, 1)
    assert rows[0].effective_updated_at == datetime(2024, 1, 1) and not rows[0].is_current
    assert rows[1].valid_from == datetime(2024, 6, 1) and rows[1].valid_to is None and rows[1].is_current
    unknown = d.where("customer_key = '-1'").first()
    assert unknown.state == "XX" and unknown.is_current and unknown.valid_to is None


def _fact(spark, raw, orders):
    d = dim(raw, [cust("C1", "2024-01-01 00:00:00", state="S1"), cust("C1", "2024-06-01 00:00:00", state="S2")])
    items = parse_entity(raw([{"order_item_id": f"I{i}", "order_id": o["order_id"], "product_id": "P1", "quantity": 1,
                               "unit_price": 10, "discount_amount": 0} for i, o in enumerate(orders)]), "order_items")
    hdr = parse_entity(raw(orders), "orders")
    prod = parse_entity(raw([{"product_id": "P1", "sku": "S", "unit_cost": 4, "retail_price": 10}]), "products")
    margins = M.int_order_margins(items, hdr, M.keyed_products(prod, M.dim_products(prod, CFG)))
    fct = M.fct_orders(margins, d, CFG)
    return fct.join(d.select("customer_key", "state"), "customer_key", "left")


def test_point_in_time_resolution(spark, raw):
    orders = [
        {"order_id": "early", "customer_id": "C1", "order_date": "2023-05-01 00:00:00"},
        {"order_id": "boundary", "customer_id": "C1", "order_date": "2024-06-01 00:00:00"},
        {"order_id": "v1", "customer_id": "C1", "order_date": "2024-03-01 00:00:00"},
        {"order_id": "nobody", "customer_id": "C9", "order_date": "2024-03-01 00:00:00"},
        {"order_id": "nodate", "customer_id": "C1"},
    ]
    got = {r.order_id: (r.customer_key, r.state, r.order_date_key) for r in _fact(spark, raw, orders).collect()}
    assert got["early"][1] == "S1" and got["v1"][1] == "S1"
    assert got["boundary"][1] == "S2"
    assert got["nobody"][0] == "-1"
    assert got["nodate"][0] == "-1" and got["nodate"][2] == 19000101


def test_margins_orphans_free_and_loss_lines(raw):
    items = parse_entity(raw([
        {"order_item_id": "free", "order_id": "O1", "product_id": "P1", "quantity": 1, "unit_price": 10, "discount_amount": 10},
        {"order_item_id": "loss", "order_id": "O1", "product_id": "P1", "quantity": 1, "unit_price": 10, "discount_amount": 8},
        {"order_item_id": "orphan_order", "order_id": "O9", "product_id": "P1", "quantity": 1, "unit_price": 10, "discount_amount": 0},
        {"order_item_id": "orphan_product", "order_id": "O1", "product_id": "P9", "quantity": 1, "unit_price": 10, "discount_amount": 0},
    ]), "order_items")
    hdr = parse_entity(raw([{"order_id": "O1", "customer_id": "C1", "order_date": "2024-01-01 00:00:00"}]), "orders")
    prod = parse_entity(raw([{"product_id": "P1", "unit_cost": 4, "retail_price": 10}]), "products")
    rows = {r.order_item_id: r for r in M.int_order_margins(items, hdr, prod).collect()}
    assert set(rows) == {"free", "loss"}
    assert rows["free"].profit_margin_pct is None and rows["free"].net_revenue == Decimal("0.00")
    assert rows["loss"].gross_profit == Decimal("-2.00") and rows["loss"].profit_margin_pct == Decimal("-100.00")
    kept = M.int_order_margins(items, hdr, prod, keep_orphans=True)
    assert kept.count() == 4


def test_session_rollup(raw):
    sessions = parse_entity(raw([{"session_id": "S1", "duration_seconds": 125}, {"session_id": "S2", "duration_seconds": 60}]), "sessions")
    orders = parse_entity(raw([
        {"order_id": "O2", "session_id": "S1", "net_revenue": 5},
        {"order_id": "O1", "session_id": "S1", "net_revenue": 7.5},
        {"order_id": "O3", "net_revenue": 1},
    ]), "orders")
    rows = {r.session_id: r for r in M.int_sessions(sessions, orders).collect()}
    assert rows["S1"].order_count == 2 and rows["S1"].converted_order_id == "O1"
    assert rows["S1"].session_attributed_revenue == Decimal("12.50") and rows["S1"].duration_minutes == Decimal("2.08")
    assert rows["S2"].order_count == 0 and rows["S2"].session_attributed_revenue == Decimal("0.00")
    assert rows["S2"].converted_order_id is None


def test_dim_date_calendar(spark):
    d = M.dim_date(spark, CFG)
    assert d.count() == 1461 + 1
    sunday = d.where("full_date = date'2024-01-07'").first()
    assert sunday.day_of_week == 7 and sunday.is_weekend and sunday.day_name == "Sunday"
    r = d.agg(F.min(F.when(F.col("date_key") != 19000101, F.col("full_date"))), F.max("full_date")).first()
    assert str(r[0]) == "2023-01-01" and str(r[1]) == "2026-12-31"
    assert d.where("full_date = date'2024-02-29'").first().fiscal_quarter == "Q1"


def test_daily_sales_status_columns(spark, raw):
    orders = [
        {"order_id": "a", "customer_id": "C1", "order_date": "2024-03-01 10:00:00", "order_status": "completed"},
        {"order_id": "b", "customer_id": "C1", "order_date": "2024-03-01 11:00:00", "order_status": "processing"},
    ]
    daily = M.fct_daily_sales(_fact(spark, raw, orders).drop("state")).first()
    assert daily.order_count == 2 and daily.customer_count == 1 and daily.net_revenue == Decimal("20.00")
    assert daily.completed_net_revenue == Decimal("10.00") and daily.returned_net_revenue == Decimal("0.00")
    assert daily.profit_margin_pct == Decimal("60.00")


def test_range_versions_equal_single_window(spark):
    """Hot key with many same-day and cross-day events, NULL instants and NULL keys."""
    from larchmart.operators.scd2 import interval_versions

    df = spark.sql(
        """select case when id % 50 = 0 then null when id % 3 = 0 then 'hot' else concat('k', id % 7) end as k,
                  case when id % 41 = 0 then null
                       else timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 97 as int) * 5, 0, 0) end as ts
           from range(3000)"""
    ).dropDuplicates(["k", "ts"])
    anchor = datetime(1900, 1, 1)
    a = interval_versions(df, "k", "ts", anchor=anchor)
    b = interval_versions(df, "k", "ts", anchor=anchor, strategy="window")
    cols = ["k", "ts", "valid_from", "valid_to", "is_current"]
    assert a.count() == df.count()
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_range_lead_splits_one_hot_key_and_day(spark):
    """A single key and a single day holding every row: still exact, still sliced."""
    from larchmart.operators.scd2 import lead_within_key

    df = spark.sql(
        "select 'hot' as k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id as int)) as ts "
        "from range(5000) union all select 'cold', timestamp_ntz'2024-01-01 00:00:00'"
    )
    a = lead_within_key(df, "k", "ts", "nxt", partitions=8)
    b = lead_within_key(df, "k", "ts", "nxt", strategy="window")
    cols = ["k", "ts", "nxt", "__first"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and a.count() == 5001
    assert a.where("__first").count() == 2


def test_hot_product_is_split(spark):
    """A product that holds most lines is split by adaptive execution inside the order fact."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        ts = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
        n = 120_000
        items = spark.range(0, n, 1, 16).select(
            F.md5(F.col("id").cast("string")).alias("order_item_id"), (F.col("id") % 5000).cast("string").alias("order_id"),
            F.when(F.col("id") % 10 > 0, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 97)).alias("product_id"),
            F.lit(1).alias("quantity"), F.lit("2.00").cast("decimal(12,2)").alias("unit_price"), F.lit("0.00").cast("decimal(12,2)").alias("discount_amount"))
        orders = spark.range(5000).select(
            F.col("id").cast("string").alias("order_id"), (F.col("id") % 50).cast("string").alias("customer_id"), F.lit("S").alias("session_id"),
            ts.alias("order_date"), F.lit("completed").alias("order_status"), F.lit("card").alias("payment_method"))
        products = spark.range(97).select(
            F.concat(F.lit("P"), F.col("id")).alias("product_id"), F.lit("s").alias("sku"), F.lit("n").alias("product_name"),
            F.lit("c").alias("category"), F.lit("1.00").cast("decimal(12,2)").alias("unit_cost"))
        customers = spark.range(50).select(
            F.col("id").cast("string").alias("customer_id"), F.col("id").cast("string").alias("customer_key"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
        catalog = M.keyed_products(products, products.select(surrogate_key("product_id").alias("product_key")))
        fact = M.fct_orders(M.int_order_margins(items, orders, catalog), customers, CFG)
        assert len(fact.collect()) == n
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true) [product_id" in plan.split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fact_over_keyed_orders_is_the_fact(spark, raw):
    """The version found per header gives the rows that the version found per line gives:
    overlapping versions, repeated headers, no date, no customer, orphans."""
    customers = spark.sql(
        """select * from values
        ('k1', 'C1', timestamp_ntz'1900-01-01', timestamp_ntz'2024-06-01'), ('k2', 'C1', timestamp_ntz'2024-03-01', null),
        ('k3', 'C2', timestamp_ntz'1900-01-01', null) as t(customer_key, customer_id, valid_from, valid_to)""")
    hdr = parse_entity(raw([
        {"order_id": "O1", "customer_id": "C1", "order_date": "2024-04-01 00:00:00"},
        {"order_id": "O2", "customer_id": "C2", "order_date": "2024-04-01 00:00:00"},
        {"order_id": "O2", "customer_id": "C9", "order_date": "2024-04-01 00:00:00"},
        {"order_id": "O3", "customer_id": "C2"}, {"order_id": "O4", "order_date": "2024-04-01 00:00:00"}, {"customer_id": "C1"}]), "orders")
    items = parse_entity(raw([
        {"order_item_id": f"I{i}", "order_id": o, "product_id": p, "quantity": 2, "unit_price": 10, "discount_amount": 1}
        for i, (o, p) in enumerate([("O1", "P1"), ("O1", "P2"), ("O2", "P1"), ("O3", "P1"), ("O4", "P2"), ("O9", "P1"), ("O1", "P9"), (None, None)])]), "order_items")
    prod = parse_entity(raw([{"product_id": "P1", "sku": "S", "unit_cost": 4}, {"product_id": "P2", "sku": "T", "unit_cost": 4}]), "products")
    catalog = M.keyed_products(prod, M.dim_products(prod, CFG).where("product_id <> 'P2'"))
    for orphans in (False, True):
        by_line = M.fct_orders(M.int_order_margins(items, hdr, catalog, orphans), customers, CFG)
        margins = M.int_order_margins(items, M.keyed_orders(hdr, customers), catalog, orphans)
        by_header = M.fct_orders(margins, customers, CFG)
        assert by_header.columns == by_line.columns
        got = sorted(map(str, by_header.collect()))
        assert got == sorted(map(str, by_line.collect())) and len(got) == (12 if orphans else 8)
        assert {r.product_key for r in by_header.where("order_id = 'O4'").collect()} == {"-1"}


def test_only_tables_asked_for_are_written(spark, raw, tmp_path):
    """Staging parses the documents without a raw table between, and a check that reads
    the order fact once does not write it."""
    from larchmart.operators import quality as Q
    from larchmart.plans.warehouse import Warehouse

    docs = {
        "customers": [cust("C1", "2024-01-01 00:00:00")],
        "products": [{"product_id": "P1", "sku": "S", "unit_cost": 4, "retail_price": 10}],
        "sessions": [{"session_id": "S1", "customer_id": "C1", "session_start": "2024-02-01 00:00:00"}],
        "orders": [{"order_id": "O1", "customer_id": "C1", "order_date": "2024-02-01 00:00:00"}],
        "order_items": [{"order_item_id": f"I{n}", "order_id": "O1", "product_id": "P1", "quantity": 1, "unit_price": 10, "discount_amount": n} for n in (1, 11, 12)],
    }
    w = Warehouse(spark, {e: raw(d) for e, d in docs.items()}, CFG, store=str(tmp_path))
    assert Q.singular_check("net_revenue_non_negative", w.once).first().violations == 2
    assert not (tmp_path / "fct_orders").exists() and not (tmp_path / "raw").exists()
    assert w.table("fct_orders").where("net_revenue < 0").count() == 2 and (tmp_path / "fct_orders").exists()


def test_order_totals_count_lines_once_per_header(spark, tmp_path):
    """Repeated headers, lines without a header or a part, headers without lines, no keys."""
    from larchmart.sources import fixtures

    spark.sql("""select * from values (1L, 1L, 'F', 9.0D, timestamp_ntz'1995-01-01', 'a'), (1L, 2L, 'O', 9.0D, timestamp_ntz'1995-01-01', 'a'),
        (2L, 1L, 'F', 7.5D, timestamp_ntz'1995-01-01', 'a'), (3L, 1L, 'F', 9.0D, timestamp_ntz'1995-01-01', 'a'), (null, 1L, 'F', 4.0D, timestamp_ntz'1995-01-01', 'a')
        as t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select l_orderkey, l_partkey, 1L as l_suppkey, 1 as l_linenumber, q as l_quantity, 0.1D as l_discount, timestamp_ntz'1995-01-01' as l_shipdate
        from values (1L, 1L, 2.0D), (1L, 1L, 3.0D), (3L, 1L, 1.0D), (3L, 9L, 1.0D), (4L, 1L, 1.0D), (null, 1L, 1.0D), (2L, null, 1.0D)
        as t(l_orderkey, l_partkey, q)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select 1L as p_partkey, 10.0D as p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    found = fixtures.orders(spark, str(tmp_path)).selectExpr("order_id", "cast(gross_amount as string) g", "cast(discount_amount as string) d").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("ORD-1", "100.00", "10.00")] * 2 + [("ORD-2", "7.50", "0.00"), ("ORD-3", "10.00", "1.00"), (None, "4.00", "0.00")], key=str)


def test_session_rollup_shuffles_before_it_sums(raw):
    """The rollup to sessions holds no sessions in the map tasks."""
    orders = parse_entity(raw([{"order_id": f"O{i}", "session_id": f"S{i % 3}", "net_revenue": i} for i in range(9)]), "orders")
    rolled = M.session_orders(orders)
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "Aggregate" not in plan[plan.index("REPARTITION_BY_COL"):]
    assert {r.session_id: (r.first_order_id, r.order_count, str(r.attributed_revenue)) for r in rolled.collect()} == {
        "S0": ("O0", 3, "9.00"), "S1": ("O1", 3, "12.00"), "S2": ("O2", 3, "15.00")}


FACT_DOCS = {
    "customers": [cust("C1", "2024-01-01 00:00:00"), cust("C1", "2024-03-01 00:00:00"), cust("C2", "2024-01-01 00:00:00")],
    "products": [{"product_id": f"P{n}", "sku": f"S{n}", "product_name": "N", "category": "A", "unit_cost": 4, "retail_price": 10} for n in (1, 2)],
    "sessions": [{"session_id": "S1", "customer_id": "C1", "session_start": "2024-02-01 00:00:00", "page_views_count": 3}],
    "orders": [
        {"order_id": f"O{n}", "customer_id": c, "session_id": "S1", "order_date": f"2024-0{n}-01 00:00:00", "order_status": "completed", "net_revenue": 10}
        for n, c in ((2, "C1"), (4, "C1"), (5, "C2"), (6, "C9"))
    ],
    "order_items": [
        {"order_item_id": f"I{o}{n}", "order_id": f"O{o}", "product_id": f"P{n}", "quantity": 1, "unit_price": 10 + n, "discount_amount": 1}
        for o in (2, 4, 5, 6)
        for n in (1, 2)
    ],
}


def _stored(spark, raw, tmp_path, extra=None):
    from larchmart.config import FIXTURE_CONFIG
    from larchmart.plans.warehouse import Warehouse

    docs = {e: d + (extra or {}).get(e, []) for e, d in FACT_DOCS.items()}
    return Warehouse(spark, {e: raw(d) for e, d in docs.items()}, FIXTURE_CONFIG, store=str(tmp_path))


def test_mart_reads_the_fact_as_a_plan(spark, raw, tmp_path):
    """The customer mart reads the fact once: it is not written for that, and its lines are
    summed up where the join by order leaves them.  The rows are those over the written fact."""
    plan, table = _stored(spark, raw, tmp_path / "plan"), _stored(spark, raw, tmp_path / "table")
    table.table("fct_orders"), table.table("fct_sessions")
    rows = lambda w: sorted(map(tuple, w.table("mart_customer_360").drop("customer_key").collect()), key=str)
    assert rows(plan) == rows(table) and len(rows(plan)) == 2
    assert not (tmp_path / "plan" / "fct_orders").exists() and (tmp_path / "table" / "fct_orders").exists()
    found = {r.customer_id: (r.lifetime_order_count, str(r.lifetime_net_revenue), r.session_count) for r in plan.table("mart_customer_360").collect()}
    assert found == {"C1": (2, "42.00", 1), "C2": (1, "21.00", 0)}
    fact = M.fct_orders(plan.fact_lines, plan.table("dim_customers"), plan.cfg)
    for by_order in (True, False):
        text = M.customer_order_lines(fact, plan.table("dim_customers"), by_order)._jdf.queryExecution().optimizedPlan().toString()
        assert ("RepartitionByExpression" in text) is not by_order


def test_relationships_write_the_fact_in_the_columns_read(spark, raw, tmp_path):
    """The checks on foreign keys write the order fact without the columns that neither they nor
    the models made of it read; violations and models are those over the whole fact."""
    from larchmart.operators import quality as Q
    from larchmart.plans import registry as G

    checks = [c for c in Q.declared_checks(CFG) if c.kind == "relationships"]
    part, table = _stored(spark, raw, tmp_path / "part"), _stored(spark, raw, tmp_path / "table")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    got, whole = rows(Q.run_checks(G._narrow_fact(part, checks), checks)), table.table("fct_orders")
    assert got == rows(Q.run_checks(table.table, checks)) and len(got) == len(checks)
    written = [p.name for p in (tmp_path / "part").iterdir() if p.name.startswith("fct_orders")]
    kept = set(spark.read.parquet(str(tmp_path / "part" / written[0])).columns)
    assert len(written) == 1 and written != ["fct_orders"] and kept < set(whole.columns) and "fct_order_item_key" not in kept
    for model in ("fct_daily_sales", "mart_customer_360"):
        assert rows(part.table(model)) == rows(table.table(model))
    assert rows(part.table("fct_orders")) == rows(whole)  # all columns where they are asked for
    # lines of an order are one pair before the shuffle
    text = M.fct_daily_sales(whole, by_order=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in text


def test_null_checks_join_the_lines_once(spark, raw, tmp_path):
    """Nulls of the order lines and of the order fact are counted while the fact is written in
    few columns; counts and models are those over the whole tables, also where the catalog has a
    product twice (its lines are two rows of the margins and four of the fact)."""
    from larchmart.operators import quality as Q
    from larchmart.plans import registry as G

    item = {"order_id": "O2", "product_id": "P1", "quantity": 1, "unit_price": 5, "discount_amount": 1}
    extra = {
        "products": [FACT_DOCS["products"][0]],
        "order_items": [item, item | {"order_item_id": "I9", "discount_amount": None}, item | {"order_item_id": "I8", "product_id": "none"}],
    }
    checks = [c for c in Q.declared_checks(CFG) if c.kind == "not_null"]
    part, table = _stored(spark, raw, tmp_path / "part", extra), _stored(spark, raw, tmp_path / "table", extra)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    counted = G._counted_lines(part, checks)
    assert set(counted) == {"int_order_margins", "fct_orders"}
    got = rows(Q.run_checks(part.table, checks, counted))
    table.table("fct_orders")
    assert G._counted_lines(table, checks) == {}  # the fact is there: its table is read
    assert got == rows(Q.run_checks(table.table, checks)) and len(got) == len(checks)
    found = {(r[1], r[2]): r[5] for r in got}
    assert found["int_order_margins", "order_item_id"] == 2 and found["fct_orders", "order_item_id"] == 4
    assert found["int_order_margins", "net_revenue"] == 2 and found["fct_orders", "net_revenue"] == 4
    written = [p.name for p in (tmp_path / "part").iterdir() if p.name.startswith("fct_orders")]
    kept = set(spark.read.parquet(str(tmp_path / "part" / written[0])).columns)
    assert len(written) == 1 and written != ["fct_orders"] and not kept & {"order_item_id", "fct_order_item_key", "unit_cost"}
    for model in ("fct_daily_sales", "mart_customer_360"):
        assert rows(part.table(model)) == rows(table.table(model))
