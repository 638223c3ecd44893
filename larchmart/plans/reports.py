"""The published analytical queries over the star schema (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import avg_half_up, pct, pct_exact


def _money_sum(c: str) -> Column:
    return F.sum(c).cast("decimal(38,2)")


def q1_category_margin(fct: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Revenue and gross margin by product category, completed orders only.

    The distinct order count is a two-level aggregation: lines are first
    summed per (category, order) - partially, before the shuffle, and keyed
    by order so a busy category is spread - then each category counts its
    (category, order) rows.  Exact, and without the Expand that a
    ``count(distinct)`` next to other aggregates would add.
    """
    done = fct.where(F.col("order_status") == "completed")
    j = done.join(dim_prod.select("product_key", "category"), "product_key")
    per_order = j.groupBy("category", "order_id").agg(
        F.sum("quantity").alias("q"),
        F.sum("gross_amount").alias("g"),
        F.sum("discount_amount").alias("d"),
        F.sum("net_revenue").alias("n"),
        F.sum("gross_profit").alias("p"),
    )
    return (
        per_order.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("q").alias("units_sold"),
            _money_sum("g").alias("gross_sales"),
            _money_sum("d").alias("discounts"),
            _money_sum("n").alias("total_net_revenue"),
            _money_sum("p").alias("total_gross_profit"),
            pct_exact(F.sum("p"), F.sum("n")).alias("profit_margin_pct"),
        )
        .orderBy(F.col("total_net_revenue").desc(), F.col("category"))
    )


def q2_state_at_purchase(fct: DataFrame, dim_cust: DataFrame, k: int = 10) -> DataFrame:
    """Top-k customer states (as recorded when the order was placed) by revenue.

    Lines are first collapsed to (version, order) so the join to the
    dimension moves one row per order instead of one per line.
    """
    per_order = fct.groupBy("customer_key", "order_id").agg(F.sum("net_revenue").alias("net_revenue"))
    j = per_order.join(dim_cust.select("customer_key", "state"), "customer_key")
    # two-level distinct count: one row per (state, order), then count rows
    per_state_order = j.groupBy("state", "order_id").agg(F.sum("net_revenue").alias("net_revenue"))
    return (
        per_state_order.groupBy(F.col("state").alias("customer_state_at_purchase"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            _money_sum("net_revenue").alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("customer_state_at_purchase"))
        .limit(k)
    )


def q3_conversion(fct_sess: DataFrame) -> DataFrame:
    """Session conversion and attributed revenue by traffic source x device."""
    agg = fct_sess.groupBy("traffic_source", "device_type").agg(
        F.count("session_id").alias("total_sessions"),
        F.count("converted_order_id").alias("converted_sessions"),
        _money_sum("session_attributed_revenue").alias("total_revenue"),
    )
    rate = pct(F.col("converted_sessions").cast("decimal(20,0)"), F.col("total_sessions").cast("decimal(20,0)"))
    return agg.select(
        "traffic_source",
        "device_type",
        "total_sessions",
        "converted_sessions",
        rate.alias("conversion_rate_pct"),
        "total_revenue",
    ).orderBy(F.col("total_revenue").desc(), "traffic_source", "device_type")


def q4_monthly(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly trading performance from the daily snapshot.

    The calendar holds one row per day of its spine - bounded by the calendar,
    not by the order volume; whether it is broadcast is left to its measured size.
    """
    cal = calendar.select("date_key", "year", "month", "month_name")
    j = daily.join(cal, "date_key")
    return (
        j.groupBy("year", "month", "month_name")
        .agg(
            F.sum("order_count").alias("orders"),
            F.sum("units_sold").alias("units"),
            _money_sum("net_revenue").alias("net_revenue"),
            _money_sum("gross_profit").alias("gross_profit"),
            pct(F.sum("gross_profit"), F.sum("net_revenue")).alias("margin_pct"),
        )
        .orderBy("year", "month")
    )


def q5_segments(c360: DataFrame) -> DataFrame:
    """Value distribution per RFM segment (averages rounded HALF_UP, 2 dp)."""
    return (
        c360.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            avg_half_up(F.col("lifetime_net_revenue"), 2).alias("avg_lifetime_revenue"),
            avg_half_up(F.col("avg_order_value"), 2).alias("avg_order_value"),
            avg_half_up(F.col("days_since_last_order"), 0).alias("avg_days_since_last_order"),
        )
        .orderBy(F.col("avg_lifetime_revenue").desc(), "rfm_segment")
    )
