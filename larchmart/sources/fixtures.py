"""Map the driver's TPC-H-style tables onto the five retail source entities.

The driver tables stand in for the upstream operational systems: each entity
is derived from them with set-based DataFrame operations (no driver-side
loops), then serialised to one JSON document per row exactly like the source
feed, so the whole warehouse - JSON parsing included - runs on data that
grows with the input tables.

Mapping rules (all fixed values; see FIXTURES.md section 3):
  products    <- part; unit cost = retail price x (0.60, 0.72, 0.84, 0.96)[partkey mod 4]
  customers   <- customer x nation; version 1 for every customer, a relocation
                 (version 2) for every 5th, a second one (version 3) for every
                 10th and a replay of version 1 ingested a day later for every 7th
  order_items <- lineitem x part x orders
  orders      <- orders x (line totals per order)
  sessions    <- events
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grouping import spread
from .schemas import ENTITIES

# Fixed values of the mapping.
INGESTED_AT = "2025-01-01 00:00:00"
REPLAY_INGESTED_AT = "2025-01-02 00:00:00"
PRODUCTS_CREATED_AT = "1994-11-02 00:00:00"
CUSTOMERS_EPOCH = "1995-01-01 00:00:00"
COST_FACTORS = ("0.60", "0.72", "0.84", "0.96")  # indexed by partkey mod 4
# (version, nation shift, every n-th customer)
CUSTOMER_VERSIONS = ((1, 0, 1), (2, 1, 5), (3, 2, 10), (4, 0, 7))
PAYMENT_METHODS = ("credit_card", "paypal", "apple_pay", "debit_card")  # orderkey mod 4
DEVICE_TYPES = ("mobile", "desktop", "tablet")  # event_id mod 3
TRAFFIC_SOURCES = ("organic_search", "direct", "cpc_ad", "email_campaign", "social_media", "affiliate")  # mod 6
NATION_COUNT = 25  # nation keys of the mapping: 0 .. 24


def ts_lit(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index] as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    retail = F.col("p_retailprice").cast("decimal(10,2)")
    factor = _pick(F.pmod(k, F.lit(4)), COST_FACTORS).cast("decimal(3,2)")
    return part.select(
        F.concat(F.lit("PROD-"), k.cast("string")).alias("product_id"),
        F.concat(F.lit("SKU-"), F.upper(F.substring("p_type", 1, 3)), F.lit("-"), k.cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.round(retail * factor, 2).cast("decimal(10,2)").alias("unit_cost"),
        retail.alias("retail_price"),
        ts_lit(PRODUCTS_CREATED_AT).alias("created_at"),
        ts_lit(INGESTED_AT).alias("_ingested_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per profile event (creation, relocations, replays)."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    versions = F.array(
        *[F.struct(F.lit(v).alias("ver"), F.lit(s).alias("shift"), F.lit(e).alias("every")) for v, s, e in CUSTOMER_VERSIONS]
    )
    base = read_table(spark, sf_dir, "customer").select(
        k.alias("k"),
        F.concat(F.lit("CUST-"), k.cast("string")).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("c_nationkey").alias("n"),
        (ts_lit(CUSTOMERS_EPOCH) + F.make_dt_interval(days=F.pmod(k * 37, F.lit(300)).cast("int"))).alias("created_at"),
    )
    # Versions are generated per row (explode of a fixed 4-element array),
    # so no join is needed to fan out the profile events.
    events = base.select("*", F.explode(versions).alias("v")).where(F.pmod(F.col("k"), F.col("v.every")) == 0)
    events = events.withColumn("state_key", F.pmod(F.col("n") + F.col("v.shift"), F.lit(NATION_COUNT)))
    ver = F.col("v.ver")
    days = (
        F.when(ver == 2, F.lit(200) + F.pmod(F.col("k"), F.lit(700)))
        .when(ver == 3, F.lit(1200) + F.pmod(F.col("k"), F.lit(900)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    joined = events.join(nation, events["state_key"] == nation["n_nationkey"], "left")
    return joined.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        F.concat(F.lit("City-"), ver.cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        (F.lit(10000) + F.pmod(F.col("k"), F.lit(90000))).cast("string").alias("postal_code"),
        F.lit("USA").alias("country"),
        "created_at",
        (F.col("created_at") + F.make_dt_interval(days=days)).alias("updated_at"),
        F.when(ver == 4, ts_lit(REPLAY_INGESTED_AT)).otherwise(ts_lit(INGESTED_AT)).alias("_ingested_at"),
    )


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of parts that exist, with their price."""
    # a day and a short decimal move as few bytes; a rate that is none raises for the lines that are kept
    rate = F.col("l_discount").try_cast("decimal(3,2)")
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        rate.alias("rate"),
        F.when(rate.isNull(), F.col("l_discount")).alias("no_rate"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
    qty = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    discount = F.round(qty * price * F.coalesce("rate", F.col("no_rate").cast("decimal(3,2)")), 2).cast("decimal(10,2)")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_shipdate",
        qty.alias("quantity"),
        price.alias("unit_price"),
        discount.alias("discount_amount"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = read_table(spark, sf_dir, "orders").select("o_orderkey")
    lines = _priced_lines(spark, sf_dir)
    lines = lines.join(headers, F.col("l_orderkey") == headers["o_orderkey"])
    item_id = F.concat_ws(
        "-",
        F.lit("ITEM"),
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    )
    return lines.select(
        item_id.alias("order_item_id"),
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_id"),
        "quantity",
        "unit_price",
        "discount_amount",
        (F.col("quantity") * F.col("unit_price") - F.col("discount_amount")).cast("decimal(10,2)").alias("net_amount"),
        ts_lit(INGESTED_AT).alias("_ingested_at"),
    )


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, g, d): gross amount and discount of an order's lines, each line once
    per header of its order."""
    lines = _priced_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("key"), (F.col("quantity") * F.col("unit_price")).alias("g"), F.col("discount_amount").alias("d"), F.lit(0).alias("n")
    )
    none = {c: F.lit(None).cast(lines.schema[c].dataType) for c in ("g", "d")}
    headers = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), none["g"].alias("g"), none["d"].alias("d"), F.lit(1).alias("n"))
    both = spread(lines.unionByName(headers).where("key IS NOT NULL"), "key")
    totals = both.agg(F.sum("g").alias("g"), F.sum("d").alias("d"), F.sum("n").alias("n"))
    return totals.select(F.col("key").alias("l_orderkey"), *[(F.col(c) * F.col("n")).cast(totals.schema[c].dataType).alias(c) for c in ("g", "d")])


def _item_totals(items: DataFrame) -> DataFrame:
    """``_line_totals`` from the order items as they are written: a line is there once
    per header of its order, and the lines of an order lie together, so that they are
    summed up before they are shuffled."""
    key = F.substring("order_id", len("ORD-") + 1, 20).cast("long")
    return items.groupBy(key.alias("l_orderkey")).agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("g"), F.sum("discount_amount").alias("d"))


def orders(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """Order headers; totals are the sums of their lines, or the header's own total
    where there are no lines (without a discount).  ``items``: the order items of the
    same tables, where they are written; the lines are then not priced again."""
    totals = _line_totals(spark, sf_dir) if items is None else _item_totals(items)
    hdr = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    j = hdr.join(totals, hdr["o_orderkey"] == totals["l_orderkey"], "left")
    own = {"g": F.col("o_totalprice").cast("decimal(12,2)"), "d": F.lit(0)}
    j = j.withColumns({c: F.coalesce(F.col(c), other.cast(j.schema[c].dataType)) for c, other in own.items()})
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("processing"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("cancelled"))
        .otherwise(F.lit("returned"))
    )
    return j.select(
        F.concat(F.lit("ORD-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.pmod(k, F.lit(10)) != 0, F.concat(F.lit("SESS-"), F.expr("o_orderkey div 2").cast("string"))).alias("session_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("order_status"),
        _pick(F.pmod(k, F.lit(4)), PAYMENT_METHODS).alias("payment_method"),
        F.col("g").cast("decimal(12,2)").alias("gross_amount"),
        F.col("d").cast("decimal(12,2)").alias("discount_amount"),
        (F.col("g") - F.col("d")).cast("decimal(12,2)").alias("net_revenue"),
        ts_lit(INGESTED_AT).alias("_ingested_at"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    e = F.col("event_id")
    duration = (F.lit(35) + F.pmod(e, F.lit(1466))).cast("int")
    return ev.select(
        F.concat(F.lit("SESS-"), e.cast("string")).alias("session_id"),
        F.concat(F.lit("CUST-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("ts").alias("session_start"),
        (F.col("ts") + F.make_dt_interval(secs=duration)).alias("session_end"),
        duration.alias("duration_seconds"),
        _pick(F.pmod(e, F.lit(3)), DEVICE_TYPES).alias("device_type"),
        _pick(F.pmod(e, F.lit(6)), TRAFFIC_SOURCES).alias("traffic_source"),
        (F.lit(1) + F.pmod(e, F.lit(14))).cast("int").alias("page_views_count"),
        (F.col("event_type") == "purchase").alias("converted"),
        ts_lit(INGESTED_AT).alias("_ingested_at"),
    )


BUILDERS = {
    "customers": customers,
    "products": products,
    "sessions": sessions,
    "orders": orders,
    "order_items": order_items,
}


def source_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Typed source rows per entity (with their ``_ingested_at``)."""
    return {name: BUILDERS[name](spark, sf_dir) for name in ENTITIES}


def to_documents(typed: DataFrame) -> DataFrame:
    """One JSON text per row; timestamps rendered with microseconds so they
    round-trip exactly (``to_json`` alone would truncate to milliseconds).
    NULL fields are omitted, as the source feed omits missing keys."""
    fields = []
    for f in typed.schema.fields:
        if f.name == "_ingested_at":
            continue
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp_ntz", "timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        fields.append(c.alias(f.name))
    return typed.select(F.to_json(F.struct(*fields)).alias("payload"), "_ingested_at")


def to_raw(typed: DataFrame) -> DataFrame:
    """Typed rows -> raw table shape ``(id, payload, _ingested_at)``."""
    docs = to_documents(typed)
    return docs.select(F.monotonically_increasing_id().alias("id"), "payload", "_ingested_at")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: to_raw(df) for name, df in source_entities(spark, sf_dir).items()}


__all__ = ["raw_tables", "source_entities", "to_documents", "to_raw", "read_table"]
