from decimal import Decimal

from larchmart.config import WarehouseConfig
from larchmart.operators.staging import parse_entity
from larchmart.plans import models as M

CFG = WarehouseConfig()


def build(raw, customers, orders, sessions=()):
    stg_c = parse_entity(raw(customers), "customers")
    d = M.dim_customers(stg_c, CFG)
    items = parse_entity(raw([{"order_item_id": f"I-{o['order_id']}", "order_id": o["order_id"], "product_id": "P1",
                               "quantity": 1, "unit_price": o.get("amount", 10), "discount_amount": 0} for o in orders]), "order_items")
    hdr = parse_entity(raw(orders), "orders")
    prod = parse_entity(raw([{"product_id": "P1", "unit_cost": 1, "retail_price": 10}]), "products")
    fct = M.fct_orders(M.int_order_margins(items, hdr, M.keyed_products(prod, M.dim_products(prod, CFG))), d, CFG)
    ss = parse_entity(raw(list(sessions) or [{"session_id": "S0", "customer_id": "C1", "session_start": "2024-01-01 00:00:00", "page_views_count": 3}]), "sessions")
    fs = M.fct_sessions(M.int_sessions(ss, hdr), d, CFG)
    return M.customer_360(d, fct, fs, CFG)


def c(cid, updated, state="S"):
    return {"customer_id": cid, "email": "e", "state": state, "created_at": "2023-01-01 00:00:00", "updated_at": updated}


def test_relocated_customer_single_row_with_all_orders(raw):
    customers = [c("C1", "2024-01-01 00:00:00", "A"), c("C1", "2024-06-01 00:00:00", "B"), c("C2", "2024-01-01 00:00:00")]
    orders = [
        {"order_id": "O1", "customer_id": "C1", "order_date": "2024-03-01 00:00:00", "order_status": "returned"},
        {"order_id": "O2", "customer_id": "C1", "order_date": "2024-07-01 00:00:00", "order_status": "completed"},
    ]
    rows = {r.customer_id: r for r in build(raw, customers, orders).collect()}
    r = rows["C1"]
    assert r.state == "B" and r.lifetime_order_count == 2 and r.returned_order_count == 1
    assert r.lifetime_net_revenue == Decimal("20.00") and r.avg_order_value == Decimal("10.00")
    assert r.days_since_last_order == 0 and r.session_count == 1 and r.total_page_views == 3
    never = rows["C2"]
    assert never.rfm_segment == "Never Purchased" and never.avg_order_value is None
    assert (never.recency_score, never.frequency_score, never.monetary_score) == (0, 0, 0)


def test_segment_rules(spark):
    rows = [(1, 4, 4, 1), (1, 4, 3, 1), (1, 3, 1, 5), (1, 2, 5, 4), (1, 1, 1, 3), (0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "lifetime_order_count long, recency_score int, frequency_score int, monetary_score int")
    got = [r[0] for r in df.select(M.rfm_segment()).collect()]
    assert got == ["Champion", "Promising", "Needs Attention", "At Risk (High Value)", "Hibernating", "Never Purchased"]
