"""Warehouse models: intermediate views, dimensions, facts and the customer mart.

Every model is a pure function of DataFrames (plus the config) returning a
lazy DataFrame; materialisation is decided by ``plans.build``.  Column
order follows the published model contracts.
"""

from __future__ import annotations

from collections.abc import Collection
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import WarehouseConfig
from ..functions.columns import bool_flag, date_key, days_between, money, pct, surrogate_key, ts_text
from ..operators.grouping import spread
from ..operators.joins import point_in_time_join
from ..operators.ranking import distributed_ntile
from ..operators.scd2 import interval_versions
from ..session import written

# --------------------------------------------------------------------------
# intermediate
# --------------------------------------------------------------------------


def keyed_products(products: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """The catalog with its dimension key: a join of catalog size, so that the
    order lines meet the product once.  It joins on the key, not on the id: the
    lines' join then shuffles both of its sides, and only such a join is split
    by skew handling."""
    keys = dim_prod.select("product_key")
    keyed = products.withColumn("__key", surrogate_key("product_id"))
    return keyed.join(keys, F.col("__key") == F.col("product_key"), "left").drop("__key")


def counted_products(products: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """``keyed_products``, but each product once, with the number of its rows in the
    dimension (``product_rows``)."""
    rows = dim_prod.groupBy("product_key").agg(F.count(F.lit(1)).cast("int").alias("product_rows"))
    keyed = products.withColumn("__key", surrogate_key("product_id"))
    return keyed.join(rows, F.col("__key") == F.col("product_key"), "left").drop("__key")


def per_product_row(margins: DataFrame) -> DataFrame:
    """Line economics over ``counted_products`` as they are over ``keyed_products``: a line
    once per row of its product in the dimension, once where it has none."""
    rows = F.sequence(F.lit(1), F.coalesce("product_rows", F.lit(1)))
    return margins.withColumn("product_rows", F.explode(rows)).drop("product_rows")


def product_key() -> Column:
    """The product's dimension key of line economics over ``counted_products``."""
    return F.when(F.col("product_rows").isNotNull(), surrogate_key("product_id"))


def keyed_orders(orders: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """The order headers with the key of the customer version in force: customer
    and instant are the header's, so the lines need not meet the versions."""
    versions = dim_cust.select("customer_key", "customer_id", "valid_from", "valid_to")
    return point_in_time_join(orders, versions, "customer_id", "order_date", ["customer_key"])


def int_order_margins(items: DataFrame, orders: DataFrame, products: DataFrame, keep_orphans: bool = False) -> DataFrame:
    """Order-line economics: gross, net, cost of goods, profit and margin.
    Keys that ``orders`` and ``products`` carry (``keyed_orders``, ``keyed_products``,
    ``counted_products``) are passed on.

    The lines meet the product first, while they are narrow, and of a product key
    only whether there is one moves with them: its text follows from the id."""
    how = "left" if keep_orphans else "inner"
    lines = items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_amount")
    version = [c for c in orders.columns if c == "customer_key"]
    headers = orders.select("order_id", "customer_id", "session_id", "order_date", "order_status", "payment_method", *version)
    key = [c for c in products.columns if c == "product_key"]
    count = [c for c in products.columns if c == "product_rows"]
    catalog = products.select("product_id", "sku", "product_name", "category", "unit_cost", *count, *[F.col(c).isNotNull().alias("__keyed") for c in key])
    j = lines.join(catalog, "product_id", how).join(headers, "order_id", how)
    if key:
        j = j.withColumn("product_key", F.when(F.col("__keyed"), surrogate_key("product_id")))
    gross = F.col("quantity") * F.col("unit_price")
    econ = j.select(
        "order_item_id",
        "order_id",
        "customer_id",
        "session_id",
        "order_date",
        "order_status",
        "payment_method",
        "product_id",
        "sku",
        "product_name",
        "category",
        "quantity",
        "unit_price",
        "unit_cost",
        money(gross).alias("gross_amount"),
        "discount_amount",
        money(gross - F.col("discount_amount")).alias("net_revenue"),
        money(F.col("quantity") * F.col("unit_cost")).alias("cogs"),
        *key,
        *version,
        *count,
    )
    profit = F.col("net_revenue") - F.col("cogs")
    return econ.withColumns(
        {
            "gross_profit": profit.cast("decimal(12,2)"),
            "profit_margin_pct": pct(profit, F.col("net_revenue")),
        }
    )


def session_orders(orders: DataFrame) -> DataFrame:
    """Orders rolled up to the session grain (aggregate before joining)."""
    sold = orders.where(F.col("session_id").isNotNull()).select("session_id", "order_id", "net_revenue")
    return spread(sold, "session_id").agg(
        F.min("order_id").alias("first_order_id"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("net_revenue").alias("attributed_revenue"),
    )


def int_sessions(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per session with the revenue of the orders it produced."""
    so = session_orders(orders)
    j = sessions.join(so, "session_id", "left")
    minutes = F.round(F.col("duration_seconds") / F.lit(Decimal("60.0")), 2).cast("decimal(10,2)")
    return j.select(
        "session_id",
        "customer_id",
        "session_start",
        "session_end",
        "duration_seconds",
        minutes.alias("duration_minutes"),
        "device_type",
        "traffic_source",
        "page_views_count",
        "is_converted",
        F.col("first_order_id").alias("converted_order_id"),
        F.coalesce(F.col("order_count"), F.lit(0).cast("long")).alias("order_count"),
        F.coalesce(F.col("attributed_revenue"), F.lit(0)).cast("decimal(12,2)").alias("session_attributed_revenue"),
    )


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------

CUSTOMER_ATTRS = ("first_name", "last_name", "email", "city", "state", "postal_code", "country", "created_at")


def event_tiebreak(*cols: str) -> Column:
    """Deterministic tie-break between replays ingested at the same instant."""
    rendered = [
        F.coalesce((ts_text(c) if c in ("created_at", "updated_at") else F.col(c)).cast("string"), F.lit("<null>"))
        for c in cols
    ]
    return F.md5(F.concat_ws("|", *rendered))


def dedupe_customer_events(stg_customers: DataFrame) -> DataFrame:
    """Keep the latest-ingested copy of each ``(customer_id, updated_at)``.

    ``row_number() ... = 1`` lets Spark insert a partial WindowGroupLimit
    before the shuffle, so a hot group of replayed copies is cut down on the
    map side instead of landing whole on one task.
    """
    w = Window.partitionBy("customer_id", "updated_at").orderBy(
        F.col("_ingested_at").desc(), event_tiebreak(*CUSTOMER_ATTRS).desc()
    )
    ranked = stg_customers.withColumn("event_rank", F.row_number().over(w))
    return ranked.where(F.col("event_rank") == 1).select("customer_id", *CUSTOMER_ATTRS, "updated_at")


def unknown_customer(spark: SparkSession, cfg: WarehouseConfig) -> DataFrame:
    bot = F.lit(cfg.beginning_of_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    # Fixed values of the Unknown customer member.
    return spark.range(1).select(
        F.lit(cfg.unknown_key).alias("customer_key"),
        F.lit(cfg.unknown_key).alias("customer_id"),
        F.lit("Unknown").alias("first_name"),
        F.lit("Unknown").alias("last_name"),
        F.lit("unknown@unknown.invalid").alias("email"),
        F.lit("Unknown").alias("city"),
        F.lit("XX").alias("state"),
        F.lit("00000").alias("postal_code"),
        F.lit("Unknown").alias("country"),
        bot.alias("created_at"),
        bot.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        bot.alias("effective_updated_at"),
        F.lit(True).alias("is_current"),
    )


def dim_customers(stg_customers: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """Type-2 customer dimension: one row per distinct profile ``updated_at``.

    Versions cover ``[valid_from, valid_to)``; the first is anchored to the
    beginning of time so early-arriving facts still resolve.
    """
    events = dedupe_customer_events(stg_customers)
    versioned = interval_versions(events, "customer_id", "updated_at", anchor=cfg.beginning_of_time)
    scd2 = versioned.select(
        surrogate_key("customer_id", ts_text("updated_at")).alias("customer_key"),
        "customer_id",
        *CUSTOMER_ATTRS,
        "valid_from",
        "valid_to",
        F.col("updated_at").alias("effective_updated_at"),
        "is_current",
    )
    return scd2.unionByName(unknown_customer(stg_customers.sparkSession, cfg))


def current_customers(dim: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    return dim.where(F.col("is_current") & (F.col("customer_id") != F.lit(cfg.unknown_key)))


def unknown_product(spark: SparkSession, cfg: WarehouseConfig) -> DataFrame:
    # Fixed values of the Unknown product member.
    return spark.range(1).select(
        F.lit(cfg.unknown_key).alias("product_key"),
        F.lit(cfg.unknown_key).alias("product_id"),
        F.lit("UNKNOWN").alias("sku"),
        F.lit("Unknown Product").alias("product_name"),
        F.lit("Unknown").alias("category"),
        F.lit(0).cast("decimal(10,2)").alias("unit_cost"),
        F.lit(0).cast("decimal(10,2)").alias("retail_price"),
        F.lit(None).cast("decimal(10,2)").alias("baseline_margin_pct"),
        F.lit(cfg.beginning_of_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("created_at"),
    )


def dim_products(stg_products: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """Product dimension (type 1: current attributes only) plus Unknown."""
    catalog = stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "sku",
        "product_name",
        "category",
        "unit_cost",
        "retail_price",
        pct(F.col("retail_price") - F.col("unit_cost"), F.col("retail_price")).alias("baseline_margin_pct"),
        "created_at",
    )
    return catalog.unionByName(unknown_product(stg_products.sparkSession, cfg))


def date_spine(spark: SparkSession, cfg: WarehouseConfig, activity: DataFrame | None = None) -> DataFrame:
    """Every day of the calendar spine, both ends inclusive.

    With a configured start and length the spine is ``spine_days + 1`` days
    from ``spine_start``.  Otherwise it covers whole calendar years from the
    earliest to the latest instant in ``activity`` (a frame with one
    timestamp column ``ts``): one global min/max aggregate, its years dealt
    over tasks, and every year exploded into its days there, so that a stray
    date far from the others adds tasks' worth of days, not a longer task.
    """
    if cfg.spine_start is not None and cfg.spine_days is not None:
        start = F.lit(cfg.spine_start.isoformat()).cast("date")
        return spark.range(cfg.spine_days + 1).select(F.date_add(start, F.col("id").cast("int")).alias("full_date"))
    if activity is None:
        raise ValueError("a data-derived spine needs the activity timestamps")
    bounds = activity.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    years = bounds.select(F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year")).repartition("year")
    day = lambda month, day: F.make_date(F.col("year"), F.lit(month), F.lit(day))
    return years.select(F.explode(F.sequence(day(1, 1), day(12, 31))).alias("full_date"))


def activity_instants(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    return orders.select(F.col("order_date").alias("ts")).unionByName(sessions.select(F.col("session_start").alias("ts")))


def dim_date(spark: SparkSession, cfg: WarehouseConfig, activity: DataFrame | None = None) -> DataFrame:
    """Calendar dimension over the spine plus the Unknown day.

    Its size is bounded by the calendar (one row per day of the spine), not
    by the fact volume, which is the proven bound that lets facts broadcast it.
    """
    d = F.col("full_date")
    dow = (F.weekday(d) + 1).cast("int")  # ISO: Monday = 1 ... Sunday = 7
    cal = date_spine(spark, cfg, activity).select(
        date_key(d).alias("date_key"),
        d,
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("fiscal_quarter"),
        F.year(d).alias("year"),
        bool_flag(dow.isin(6, 7)).alias("is_weekend"),
    )
    # Fixed values of the Unknown day member.
    unknown = spark.range(1).select(
        F.lit(cfg.unknown_date_key).cast("int").alias("date_key"),
        F.lit(cfg.beginning_of_time.date().isoformat()).cast("date").alias("full_date"),
        F.lit(1).alias("day_of_week"),
        F.lit("Unknown").alias("day_name"),
        F.lit(1).alias("day_of_month"),
        F.lit(1).alias("month"),
        F.lit("Unknown").alias("month_name"),
        F.lit(1).alias("quarter"),
        F.lit("Unknown").alias("fiscal_quarter"),
        F.lit(cfg.beginning_of_time.year).alias("year"),
        F.lit(False).alias("is_weekend"),
    )
    return cal.unionByName(unknown)


# --------------------------------------------------------------------------
# facts
# --------------------------------------------------------------------------


# fact column -> the column of the line economics it is made of, where names differ
FACT_INPUTS = {"fct_order_item_key": "order_item_id", "order_date_key": "order_date", "order_timestamp": "order_date"}


def fct_orders(margins: DataFrame, dim_cust: DataFrame, cfg: WarehouseConfig, columns: Collection[str] | None = None) -> DataFrame:
    """Order-line fact: customer version in force at order time, product key.

    ``margins`` are the line economics over ``keyed_products``: no second
    product join hangs on the partitioning of the first, so adaptive execution
    may split a hot product there and a hot customer here.  Margins over
    ``keyed_orders`` have their customer version already.  ``columns`` are those
    to make, all by default.
    """
    versions = dim_cust.select("customer_key", "customer_id", "valid_from", "valid_to")
    resolved = "customer_key" in margins.columns
    j = margins if resolved else point_in_time_join(margins, versions, "customer_id", "order_date", ["customer_key"])
    made = {
        "fct_order_item_key": surrogate_key("order_item_id"),
        "order_item_id": F.col("order_item_id"),
        "order_id": F.col("order_id"),
        "customer_key": F.coalesce(F.col("customer_key"), F.lit(cfg.unknown_key)),
        "product_key": F.coalesce(F.col("product_key"), F.lit(cfg.unknown_key)),
        "order_date_key": F.coalesce(date_key("order_date"), F.lit(cfg.unknown_date_key)),
        "session_id": F.col("session_id"),
        "order_timestamp": F.col("order_date"),
    }
    same = (
        "order_status",
        "payment_method",
        "quantity",
        "unit_price",
        "unit_cost",
        "gross_amount",
        "discount_amount",
        "net_revenue",
        "cogs",
        "gross_profit",
        "profit_margin_pct",
    )
    made |= {c: F.col(c) for c in same}
    return j.select(*[value.alias(c) for c, value in made.items() if columns is None or c in columns])


def fct_sessions(sessions: DataFrame, dim_cust: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """Session fact: customer version in force when the session started."""
    versions = dim_cust.select("customer_key", "customer_id", "valid_from", "valid_to")
    j = point_in_time_join(sessions, versions, "customer_id", "session_start", ["customer_key"])
    return j.select(
        surrogate_key("session_id").alias("session_key"),
        "session_id",
        F.coalesce(F.col("customer_key"), F.lit(cfg.unknown_key)).alias("customer_key"),
        F.coalesce(date_key("session_start"), F.lit(cfg.unknown_date_key)).alias("session_date_key"),
        "session_start",
        "session_end",
        "device_type",
        "traffic_source",
        "duration_seconds",
        "duration_minutes",
        "page_views_count",
        "is_converted",
        "converted_order_id",
        "order_count",
        "session_attributed_revenue",
    )


def _status_revenue(status: str) -> Column:
    return F.sum(F.when(F.col("order_status") == status, F.col("net_revenue")).otherwise(F.lit(0))).cast("decimal(14,2)")


def daily_sales_once(fct: DataFrame) -> DataFrame:
    """``fct_daily_sales`` in one pass over a plan that ends in the join by order.

    Lines are summed up by (day, order) where that join leaves them.  An order is one
    row with its measures, and one without any for each customer version it has; only
    these, by (day, version), are shuffled."""
    sums = {
        "order_line_count": F.count(F.lit(1)),
        "units_sold": F.sum("quantity"),
        **{c: F.sum(c) for c in ("gross_amount", "discount_amount", "net_revenue", "cogs", "gross_profit")},
        **{f"{s}_net_revenue": _status_revenue(s) for s in ("completed", "returned", "cancelled")},
    }
    per_order = fct.groupBy(F.col("order_date_key").alias("date_key"), "order_id").agg(
        *[m.alias(c) for c, m in sums.items()], F.collect_set("customer_key").alias("__versions")
    )
    none = F.array(F.lit(None).cast(fct.schema["customer_key"].dataType))
    rows = per_order.withColumn("__version", F.explode(F.concat(none, "__versions")))
    measured = F.col("__version").isNull()
    rows = rows.select("date_key", "__version", F.when(measured, F.col("order_id").isNotNull().cast("long")).alias("order_count"), *[F.when(measured, F.col(c)).alias(c) for c in sums])
    per_version = rows.groupBy("date_key", "__version").agg(*[F.sum(c).alias(c) for c in ("order_count", *sums)])
    total = {c: F.sum(c).cast("decimal(14,2)") for c in sums}
    margin = pct(F.sum("gross_profit").cast("decimal(22,2)"), F.sum("net_revenue").cast("decimal(22,2)"))
    return per_version.groupBy("date_key").agg(
        F.sum("order_count").alias("order_count"),
        F.count("__version").alias("customer_count"),
        F.sum("order_line_count").alias("order_line_count"),
        F.sum("units_sold").alias("units_sold"),
        *[total[c].alias(c) for c in ("gross_amount", "discount_amount", "net_revenue", "cogs", "gross_profit")],
        margin.alias("profit_margin_pct"),
        *[total[f"{s}_net_revenue"].alias(f"{s}_net_revenue") for s in ("completed", "returned", "cancelled")],
    ).where("date_key IS NOT NULL")


def fct_daily_sales(fct: DataFrame, by_order: bool = False) -> DataFrame:
    """Periodic snapshot: one row per trading day.

    The two distinct counts are computed apart from the additive measures, each
    over two narrow columns that are shuffled by (day, distinct value), which
    spreads a busy day over its orders and customers; the measures take a plain
    partial/final aggregate.  All three have at most one row per day, so their
    joins are bounded by the calendar.  ``by_order``: the lines of an order lie
    together in ``fct``, so that equal pairs are made one before they are shuffled.
    """
    by_day = F.col("order_date_key").alias("date_key")

    def distinct(column: str, out: str) -> DataFrame:
        pairs = fct.select(by_day, column).where(F.col(column).isNotNull())
        once = pairs.groupBy("date_key", column) if by_order else spread(pairs, "date_key", column)
        return once.agg(F.lit(1)).groupBy("date_key").agg(F.count(F.lit(1)).alias(out))

    measures = fct.groupBy(by_day).agg(
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("gross_amount").cast("decimal(14,2)").alias("gross_amount"),
        F.sum("discount_amount").cast("decimal(14,2)").alias("discount_amount"),
        F.sum("net_revenue").cast("decimal(14,2)").alias("net_revenue"),
        F.sum("cogs").cast("decimal(14,2)").alias("cogs"),
        F.sum("gross_profit").cast("decimal(14,2)").alias("gross_profit"),
        pct(F.sum("gross_profit"), F.sum("net_revenue")).alias("profit_margin_pct"),
        _status_revenue("completed").alias("completed_net_revenue"),
        _status_revenue("returned").alias("returned_net_revenue"),
        _status_revenue("cancelled").alias("cancelled_net_revenue"),
    )
    zero = F.lit(0).cast("long")
    days = measures.where("date_key IS NOT NULL").join(distinct("order_id", "order_count"), "date_key", "left")
    return days.join(distinct("customer_key", "customer_count"), "date_key", "left").select(
        "date_key",
        F.coalesce("order_count", zero).alias("order_count"),
        F.coalesce("customer_count", zero).alias("customer_count"),
        "order_line_count",
        "units_sold",
        "gross_amount",
        "discount_amount",
        "net_revenue",
        "cogs",
        "gross_profit",
        "profit_margin_pct",
        "completed_net_revenue",
        "returned_net_revenue",
        "cancelled_net_revenue",
    )


def daily_sales_dense(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dense daily series over the calendar; days without trade show zeros."""
    zero_l = F.lit(0).cast("long")
    zero_m = F.lit(0).cast("decimal(14,2)")
    j = calendar.select("date_key", "full_date").join(daily, "date_key", "left")
    return j.select(
        "date_key",
        "full_date",
        F.coalesce("order_count", zero_l).alias("order_count"),
        F.coalesce("order_line_count", zero_l).alias("order_line_count"),
        F.coalesce("units_sold", zero_l).alias("units_sold"),
        F.coalesce("net_revenue", zero_m).alias("net_revenue"),
        F.coalesce("gross_profit", zero_m).alias("gross_profit"),
    )


# --------------------------------------------------------------------------
# customer 360
# --------------------------------------------------------------------------


def customer_order_lines(fct: DataFrame, dim_cust: DataFrame, by_order: bool = False) -> DataFrame:
    """Orders re-keyed from the version key to the natural customer id.

    Lines are first collapsed to one row per (version, order, status), so the
    join to the versions moves one row per order instead of one per line.  Every downstream
    measure (distinct orders, sums, first/last instants) is exact over this
    grain.  ``by_order``: ``fct`` is a plan that ends in the join by order, whose lines
    are collapsed where that join leaves them, without another shuffle, or was written
    by one: the lines of an order lie together, and are collapsed before the shuffle.
    """
    versions = dim_cust.select("customer_key", "customer_id")
    lines = fct.select("customer_key", "order_id", "order_status", "net_revenue", "gross_profit", "order_timestamp")
    keys = ("customer_key", "order_id", "order_status")
    per_order = (lines.groupBy(*keys) if by_order else spread(lines, *keys)).agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        F.min("order_timestamp").alias("first_ts"),
        F.max("order_timestamp").alias("last_ts"),
    )
    return per_order.join(versions, "customer_key").drop("customer_key")


def data_watermark(orders: DataFrame) -> DataFrame:
    """Latest order instant in the warehouse (a one-row frame)."""
    return orders.agg(F.max("last_ts").alias("latest_order_timestamp"))


def customer_orders(orders: DataFrame) -> DataFrame:
    """Lifetime purchase behaviour per customer, across all their versions.

    Distinct counts are two-level: one row per (customer, order) first -
    keyed by order, so a customer with a huge history is spread - then each
    customer counts its rows (and its returned orders).  Exact, no Expand.
    """
    per_order = spread(orders, "customer_id", "order_id").agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max(F.col("order_status") == "returned").alias("returned"),
    )
    return per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lifetime_order_count"),
        F.sum("net_revenue").cast("decimal(14,2)").alias("lifetime_net_revenue"),
        F.sum("gross_profit").cast("decimal(14,2)").alias("lifetime_gross_profit"),
        F.min("first_ts").alias("first_order_at"),
        F.max("last_ts").alias("last_order_at"),
        F.count_if(F.col("returned")).alias("returned_order_count"),
    )


def customer_sessions(fct_sess: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Engagement per customer across all versions (sessions are counted per
    version first, so the join moves one row per version)."""
    versions = dim_cust.select("customer_key", "customer_id")
    per_version = fct_sess.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("page_views_count").alias("pv")
    )
    j = per_version.join(versions, "customer_key")
    return j.groupBy("customer_id").agg(
        F.sum("n").alias("session_count"),
        F.sum("pv").alias("total_page_views"),
    )


# what the daily snapshot and the customer mart read of the order fact
DAILY_READS = ("order_date_key", "order_id", "customer_key", "order_status", "quantity", "gross_amount", "discount_amount", "net_revenue", "cogs", "gross_profit")
PROFILE_READS = ("customer_key", "order_id", "order_status", "net_revenue", "gross_profit", "order_timestamp")


def customer_profile(dim_cust: DataFrame, fct: DataFrame, fct_sess: DataFrame, cfg: WarehouseConfig, by_order: bool = False) -> DataFrame:
    """Current profile + lifetime rollups + recency against the watermark.

    The per-customer rollup is computed once and written (customer grain, in
    the shared folder):
    the watermark - the latest order instant, i.e. the largest per-customer
    last order - is then a scalar subquery over that small table instead of
    a second pass over the order lines.
    """
    rollup = written(customer_orders(customer_order_lines(fct, dim_cust, by_order)), "rollup")
    # Scalar subquery: evaluated once, then inlined as a literal - no join.
    watermark = rollup.agg(F.max("last_order_at")).scalar()
    cust = current_customers(dim_cust, cfg).select(
        "customer_key", "customer_id", "first_name", "last_name", "email", "city", "state", "country", "created_at"
    )
    j = cust.join(rollup, "customer_id", "left").join(
        customer_sessions(fct_sess, dim_cust), "customer_id", "left"
    )
    n_orders = F.coalesce(F.col("lifetime_order_count"), F.lit(0).cast("long"))
    revenue = F.coalesce(F.col("lifetime_net_revenue"), F.lit(0)).cast("decimal(14,2)")
    return j.select(
        "customer_key",
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "city",
        "state",
        "country",
        F.col("created_at").alias("customer_since"),
        n_orders.alias("lifetime_order_count"),
        revenue.alias("lifetime_net_revenue"),
        F.coalesce(F.col("lifetime_gross_profit"), F.lit(0)).cast("decimal(14,2)").alias("lifetime_gross_profit"),
        (revenue / F.nullif(n_orders, F.lit(0))).cast("decimal(14,2)").alias("avg_order_value"),
        F.coalesce(F.col("returned_order_count"), F.lit(0).cast("long")).alias("returned_order_count"),
        "first_order_at",
        "last_order_at",
        days_between(F.col("last_order_at"), watermark).alias("days_since_last_order"),
        F.coalesce(F.col("session_count"), F.lit(0).cast("long")).alias("session_count"),
        F.coalesce(F.col("total_page_views"), F.lit(0).cast("long")).alias("total_page_views"),
    )


# score column -> (measure, descending?); customer_id makes every order total
SCORE_ORDERS = {
    "recency_score": ("days_since_last_order", True),
    "frequency_score": ("lifetime_order_count", False),
    "monetary_score": ("lifetime_net_revenue", False),
}


def score_order(score: str) -> list[Column]:
    measure, desc = SCORE_ORDERS[score]
    return [F.col(measure).desc() if desc else F.col(measure).asc(), F.col("customer_id").asc()]


def rfm_scores(profile: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """Quintile scores among purchasers; customers without orders score 0.

    The profile is evaluated once and written.  Each score is ranked on two
    columns only (customer, measure), so that is all the range shuffles and
    their files carry; the scores meet in one aggregation by
    customer and are joined back once.
    """
    profile = written(profile, "profile")
    buyers = profile.where(F.col("lifetime_order_count") > 0)
    scored = None
    for score, (measure, _) in SCORE_ORDERS.items():
        tiles = distributed_ntile(buyers.select("customer_id", measure), cfg.rfm_tiles, score_order(score), "__tile")
        one = tiles.select("customer_id", F.lit(score).alias("__score"), "__tile")
        scored = one if scored is None else scored.unionByName(one)
    per_customer = scored.groupBy("customer_id").agg(
        *[F.max(F.when(F.col("__score") == s, F.col("__tile"))).alias(s) for s in SCORE_ORDERS]
    )
    joined = profile.join(per_customer, "customer_id", "left")
    return joined.select(*profile.columns, *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in SCORE_ORDERS])


def rfm_segment() -> Column:
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    # Segment labels, first matching rule wins.
    return (
        F.when(F.col("lifetime_order_count") == 0, F.lit("Never Purchased"))
        .when((r >= 4) & (f >= 4), F.lit("Champion"))
        .when(r >= 4, F.lit("Promising"))
        .when(r == 3, F.lit("Needs Attention"))
        .when(m >= 4, F.lit("At Risk (High Value)"))
        .otherwise(F.lit("Hibernating"))
    )


def customer_360(dim_cust: DataFrame, fct: DataFrame, fct_sess: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    scored = rfm_scores(customer_profile(dim_cust, fct, fct_sess, cfg), cfg)
    return scored.withColumn("rfm_segment", rfm_segment())
