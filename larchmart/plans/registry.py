"""Registered queries: one per operator/model, each with its DuckDB oracle.

Every Spark query starts from the driver's tables in ``sf_dir``, goes
through the JSON documents and the staging parser, and builds the model it
needs on the whole input.  ``ORACLE[name]`` is the independent SQL.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..config import FIXTURE_CONFIG
from ..functions.columns import date_key, days_between, surrogate_key, ts_text
from ..operators.joins import point_in_time_join
from ..operators.scd2 import interval_versions
from ..operators.staging import json_extract
from ..session import work_dir, written
from ..sources import fixtures
from ..sources.schemas import ENTITIES
from . import models as M
from .warehouse import TABLE_MODELS, Warehouse, shared  # noqa: F401

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse over ``sf_dir``: each table model is built once
    (from the raw documents) and re-read by every later query."""
    return shared(spark, sf_dir, FIXTURE_CONFIG)


# ---------------------------------------------------------------- sources --

_RAW_SCAN_ORACLE = " union all ".join(
    f"select '{e}' as entity, count(*) as documents, count(*) as parsed_documents, "
    f"min(_ingested_at) as first_ingested_at, max(_ingested_at) as last_ingested_at from stg_{e}"
    for e in ENTITIES
)


@register("raw_scan", O.with_ctes(_RAW_SCAN_ORACLE, *[f"stg_{e}" for e in ENTITIES]))
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables: documents, documents that parse as JSON objects, ingest span."""
    parts = []
    w = wh(spark, sf_dir)
    for entity in ENTITIES:
        raw = w.raw_table(entity)
        parsed = F.from_json("payload", "map<string,string>").isNotNull()
        parts.append(
            raw.agg(
                F.count(F.lit(1)).alias("documents"),
                F.count_if(parsed).alias("parsed_documents"),
                F.min("_ingested_at").alias("first_ingested_at"),
                F.max("_ingested_at").alias("last_ingested_at"),
            ).select(F.lit(entity).alias("entity"), "*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "json_extract",
    O.with_ctes(
        "select order_id, customer_id, session_id, order_date, order_status, net_revenue from stg_orders", "stg_orders"
    ),
)
def json_extract_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-key extraction from the raw order documents, then cast."""
    raw = wh(spark, sf_dir).raw_table("orders")
    p = F.col("payload")
    return raw.select(
        json_extract(p, "order_id").alias("order_id"),
        json_extract(p, "customer_id").alias("customer_id"),
        json_extract(p, "session_id").alias("session_id"),
        json_extract(p, "order_date").cast("timestamp_ntz").alias("order_date"),
        json_extract(p, "order_status").alias("order_status"),
        json_extract(p, "net_revenue").cast("decimal(12,2)").alias("net_revenue"),
    )


_COUNTS_ORACLE = " union all ".join(f"select '{e}' as entity, count(*) as {{col}} from stg_{e}" for e in ENTITIES)


@register(
    "land_manifest",
    O.with_ctes(
        "select entity, record_count, 'filesystem' as storage from ("
        + _COUNTS_ORACLE.format(col="record_count")
        + ") t",
        *[f"stg_{e}" for e in ENTITIES],
    ),
)
def land_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every entity as JSON Lines and return the manifest of the landing."""
    from ..sources import landing

    root = landing.new_run_folder(spark, "bronze")
    w = wh(spark, sf_dir)
    manifest = landing.land({e: w.raw_table(e) for e in ENTITIES}, root)
    return manifest.select("entity", "record_count", "storage")


@register(
    "load_audit",
    O.with_ctes(
        "select entity, loaded_rows from (" + _COUNTS_ORACLE.format(col="loaded_rows") + ") t",
        *[f"stg_{e}" for e in ENTITIES],
    ),
)
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, load bronze -> raw under a new run, publish it, and audit the counts."""
    from ..sources import landing

    bronze = landing.new_run_folder(spark, "bronze")
    w = wh(spark, sf_dir)
    landing.land({e: w.raw[e] for e in ENTITIES}, bronze)  # read once: no raw table of the warehouse between
    raw_root = landing.new_run_folder(spark, "raw")
    landing.load_raw(spark, bronze, raw_root, run_id="r1")
    return landing.load_audit(spark, raw_root)


# ---------------------------------------------------------------- staging --

for _e in ENTITIES:
    _name = f"stg_{_e}"

    def _mk(name: str) -> QueryFn:
        def q(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wh(spark, sf_dir).table(name)

        q.__name__ = name
        return q

    register(_name, O.with_ctes(f"select * from {_name}", _name))(_mk(_name))


# ----------------------------------------------------------- intermediate --

register("order_margins", O.with_ctes("select * from int_order_margins", "int_order_margins"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("int_order_margins")
)
register("session_orders", O.with_ctes("select * from session_orders", "session_orders"))(
    lambda spark, sf_dir: M.session_orders(wh(spark, sf_dir).table("stg_orders"))
)
register("int_sessions", O.with_ctes("select * from int_sessions", "int_sessions"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("int_sessions")
)

# ------------------------------------------------------------- dimensions --

register("dedupe_events", O.with_ctes("select * from dedupe_events", "dedupe_events"))(
    lambda spark, sf_dir: M.dedupe_customer_events(wh(spark, sf_dir).table("stg_customers"))
)
register("dim_customers", O.with_ctes("select * from dim_customers", "dim_customers"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("dim_customers")
)
register(
    "current_customers",
    O.with_ctes("select * from dim_customers where is_current and customer_id <> '-1'", "dim_customers"),
)(lambda spark, sf_dir: M.current_customers(wh(spark, sf_dir).table("dim_customers"), FIXTURE_CONFIG))
register("dim_products", O.with_ctes("select * from dim_products", "dim_products"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("dim_products")
)
register("dim_date", O.with_ctes("select * from dim_date", "dim_date"))(lambda spark, sf_dir: wh(spark, sf_dir).table("dim_date"))
register("date_spine", O.with_ctes("select * from date_spine", "date_spine"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("date_spine")
)


@register(
    "date_keys",
    O.with_ctes(
        "select order_id, cast(strftime(order_date, '%Y%m%d') as integer) as order_date_key, "
        "cast(strftime(_ingested_at, '%Y%m%d') as integer) as ingested_date_key from stg_orders",
        "stg_orders",
    ),
)
def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = wh(spark, sf_dir).table("stg_orders")
    return o.select("order_id", date_key("order_date").alias("order_date_key"), date_key("_ingested_at").alias("ingested_date_key"))


@register(
    "days_between",
    O.with_ctes(
        "select order_id, cast(date_diff('day', cast(order_date as date), cast(_ingested_at as date)) as integer) "
        "as days_to_ingest from stg_orders",
        "stg_orders",
    ),
)
def days_between_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = wh(spark, sf_dir).table("stg_orders")
    return o.select("order_id", days_between("order_date", "_ingested_at").alias("days_to_ingest"))


_SKEY_ORACLE = f"""
select 'order_item' as entity, order_item_id as natural_key, {O.skey('order_item_id')} as surrogate_key from stg_order_items
union all select 'session', session_id, {O.skey('session_id')} from stg_sessions
union all select 'product', product_id, {O.skey('product_id')} from stg_products
union all select 'customer_version', concat_ws('-', customer_id, {O.ts_text('updated_at')}),
                 {O.skey('customer_id', O.ts_text('updated_at'))} from dedupe_events"""


@register("surrogate_keys", O.with_ctes(_SKEY_ORACLE, "stg_order_items", "stg_sessions", "stg_products", "dedupe_events"))
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wh(spark, sf_dir)

    def keyed(df: DataFrame, entity: str, *parts) -> DataFrame:
        return df.select(
            F.lit(entity).alias("entity"),
            F.concat_ws("-", *parts).alias("natural_key"),
            surrogate_key(*parts).alias("surrogate_key"),
        )

    return (
        keyed(w.table("stg_order_items"), "order_item", F.col("order_item_id"))
        .unionByName(keyed(w.table("stg_sessions"), "session", F.col("session_id")))
        .unionByName(keyed(w.table("stg_products"), "product", F.col("product_id")))
        .unionByName(
            keyed(M.dedupe_customer_events(w.table("stg_customers")), "customer_version", F.col("customer_id"), ts_text("updated_at"))
        )
    )


_UNKNOWN_ORACLE = """
select 'dim_customers' as dimension, customer_key as member_key, first_name as label from dim_customers where customer_key = '-1'
union all select 'dim_products', product_key, product_name from dim_products where product_key = '-1'
union all select 'dim_date', cast(date_key as varchar), day_name from dim_date where date_key = 19000101"""


@register("unknown_members", O.with_ctes(_UNKNOWN_ORACLE, "dim_customers", "dim_products", "dim_date"))
def unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, cfg = wh(spark, sf_dir), FIXTURE_CONFIG
    c = w.table("dim_customers").where(F.col("customer_key") == cfg.unknown_key).select(
        F.lit("dim_customers").alias("dimension"), F.col("customer_key").alias("member_key"), F.col("first_name").alias("label")
    )
    p = w.table("dim_products").where(F.col("product_key") == cfg.unknown_key).select(
        F.lit("dim_products").alias("dimension"), F.col("product_key").alias("member_key"), F.col("product_name").alias("label")
    )
    d = w.table("dim_date").where(F.col("date_key") == cfg.unknown_date_key).select(
        F.lit("dim_date").alias("dimension"), F.col("date_key").cast("string").alias("member_key"), F.col("day_name").alias("label")
    )
    return c.unionByName(p).unionByName(d)


# ---------------------------------------------------------- point in time --

_PIT_ORACLE = """
with sv as (
  select user_id, ts, max(event_id) as signup_event_id from events where event_type = 'signup' group by user_id, ts
), iv as (
  select user_id, signup_event_id,
         case when row_number() over w = 1 then timestamp '1900-01-01 00:00:00' else ts end as valid_from,
         lead(ts) over w as valid_to
  from sv window w as (partition by user_id order by ts)
)
select e.event_id, e.user_id, e.ts, coalesce(iv.signup_event_id, -1) as signup_event_id
from events e
left join iv on e.user_id = iv.user_id and e.ts >= iv.valid_from and (e.ts < iv.valid_to or iv.valid_to is null)
where e.event_type <> 'signup'"""


@register("pit_join", _PIT_ORACLE)
def pit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events resolved to the signup (profile version) in force at event time."""
    ev = fixtures.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    signups = (
        ev.where(F.col("event_type") == "signup")
        .groupBy("user_id", "ts")
        .agg(F.max("event_id").alias("signup_event_id"))
    )
    versions = interval_versions(signups, "user_id", "ts", anchor=FIXTURE_CONFIG.beginning_of_time)
    facts = ev.where(F.col("event_type") != "signup").select("event_id", "user_id", "ts")
    j = point_in_time_join(facts, versions, "user_id", "ts", ["signup_event_id"])
    return j.select("event_id", "user_id", "ts", F.coalesce("signup_event_id", F.lit(-1).cast("long")).alias("signup_event_id"))


_PIT_HOT_ORACLE = """
select f.event_id, f.ts, coalesce(v.signup_event_id, -1) as signup_event_id, v.ts as signup_ts
from (select event_id, ts from events where event_type <> 'signup') f
asof left join (select ts, max(event_id) as signup_event_id from events where event_type = 'signup' group by ts) v on f.ts >= v.ts"""


@register("pit_join_hot", _PIT_HOT_ORACLE)
def pit_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event resolved to the last signup of any user: one key has all versions
    and all facts, which meet in time bins."""
    ev = fixtures.read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.lit("all").alias("key"))
    signups = ev.where("event_type = 'signup'").groupBy("key", "ts").agg(F.max("event_id").alias("signup_event_id"))
    versions = interval_versions(signups, "key", "ts").withColumn("signup_ts", F.col("ts")).drop("ts")
    j = point_in_time_join(ev.where("event_type <> 'signup'"), versions, "key", "ts", ["signup_event_id", "signup_ts"])
    return j.select("event_id", "ts", F.coalesce("signup_event_id", F.lit(-1).cast("long")).alias("signup_event_id"), "signup_ts")


# ------------------------------------------------------------------ facts --

register("fct_orders", O.with_ctes("select * from fct_orders", "fct_orders"))(lambda spark, sf_dir: wh(spark, sf_dir).table("fct_orders"))
register("fct_sessions", O.with_ctes("select * from fct_sessions", "fct_sessions"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("fct_sessions")
)
register("daily_sales", O.with_ctes("select * from fct_daily_sales", "fct_daily_sales"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("fct_daily_sales")
)

_DENSE_ORACLE = """
select d.date_key, d.full_date, coalesce(f.order_count, 0) as order_count,
       coalesce(f.order_line_count, 0) as order_line_count, coalesce(f.units_sold, 0) as units_sold,
       coalesce(f.net_revenue, cast(0 as decimal(14,2))) as net_revenue,
       coalesce(f.gross_profit, cast(0 as decimal(14,2))) as gross_profit
from dim_date d left join fct_daily_sales f on f.date_key = d.date_key"""


@register("daily_sales_dense", O.with_ctes(_DENSE_ORACLE, "dim_date", "fct_daily_sales"))
def daily_sales_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wh(spark, sf_dir)
    return M.daily_sales_dense(w.table("fct_daily_sales"), w.table("dim_date"))


_CONFIGURED_ORACLE = """
select s.full_date, ifnull(f.order_count, 0) as order_count, ifnull(f.net_revenue, 0)::decimal(14,2) as net_revenue
from (select unnest(range(timestamp '1995-01-01', timestamp '1995-01-01' + interval 10958 day, interval 1 day))::date as full_date
      union all select date '1900-01-01') s
left join fct_daily_sales f on strptime(f.date_key::varchar, '%Y%m%d')::date = s.full_date"""


@register("daily_sales_configured", O.with_ctes(_CONFIGURED_ORACLE, "fct_daily_sales"))
def daily_sales_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense daily series over the configured spine (a start and a length)."""
    cfg = FIXTURE_CONFIG.with_(spine_start=date(1995, 1, 1), spine_days=10957)
    dense = M.daily_sales_dense(wh(spark, sf_dir).table("fct_daily_sales"), M.dim_date(spark, cfg))
    return dense.select("full_date", "order_count", "net_revenue")


# ------------------------------------------------------------ customer 360 --

@register("data_watermark", O.with_ctes("select * from data_watermark", "data_watermark"))
def data_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.data_watermark(wh(spark, sf_dir).order_grain())


@register("customer_orders", O.with_ctes("select * from customer_orders", "customer_orders"))
def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_orders(wh(spark, sf_dir).order_grain())


@register("customer_sessions", O.with_ctes("select * from customer_sessions", "customer_sessions"))
def customer_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wh(spark, sf_dir)
    return M.customer_sessions(w.table("fct_sessions"), w.table("dim_customers"))


@register(
    "rfm_scores",
    O.with_ctes("select customer_id, recency_score, frequency_score, monetary_score from rfm_scores", "rfm_scores"),
)
def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh(spark, sf_dir).table("mart_customer_360").select("customer_id", "recency_score", "frequency_score", "monetary_score")


@register("rfm_segments", O.with_ctes("select customer_id, rfm_segment from mart_customer_360", "mart_customer_360"))
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh(spark, sf_dir).table("mart_customer_360").select("customer_id", "rfm_segment")


register("customer_360", O.with_ctes("select * from mart_customer_360", "mart_customer_360"))(
    lambda spark, sf_dir: wh(spark, sf_dir).table("mart_customer_360")
)

# ---------------------------------------------------------------- reports --

_Q1 = f"""
select category, count(*) as total_orders, sum(units)::bigint as units_sold, sum(gross)::decimal(38,2) as gross_sales,
       sum(discount)::decimal(38,2) as discounts, sum(net)::decimal(38,2) as total_net_revenue,
       sum(profit)::decimal(38,2) as total_gross_profit, {O.pct('sum(profit)', 'sum(net)')} as profit_margin_pct
from (select category, order_id, sum(quantity) as units, sum(gross_amount) as gross, sum(discount_amount) as discount,
             sum(net_revenue) as net, sum(gross_profit) as profit
      from fct_orders join dim_products using (product_key) where order_status = 'completed' group by all) per_order
group by category order by total_net_revenue desc, category"""

_Q2 = """
select state as customer_state_at_purchase, sum(n)::bigint as order_count, sum(net)::decimal(38,2) as total_revenue
from (select customer_key, count(*) as n, sum(net) as net from order_totals group by all)
join dim_customers using (customer_key)
group by state order by total_revenue desc, customer_state_at_purchase limit 10"""

_Q3 = f"""
select traffic_source, device_type, count(session_id) as total_sessions,
       count(converted_order_id) as converted_sessions,
       {O.pct_counts('count(converted_order_id)', 'count(session_id)')} as conversion_rate_pct,
       cast(sum(session_attributed_revenue) as decimal(38,2)) as total_revenue
from fct_sessions group by traffic_source, device_type
order by total_revenue desc, traffic_source, device_type"""

_Q4 = f"""
select names.* exclude (ym), months.* exclude (ym), {O.pct('gross_profit', 'net_revenue')} as margin_pct
from (select date_key // 100 as ym, sum(order_count)::bigint as orders, sum(units_sold)::bigint as units,
             sum(net_revenue)::decimal(38,2) as net_revenue, sum(gross_profit)::decimal(38,2) as gross_profit
      from fct_daily_sales where date_key in (select date_key from dim_date) group by all) months
join (select date_key // 100 as ym, any_value(year) as year, any_value(month) as month, any_value(month_name) as month_name
      from dim_date group by all) names using (ym)
order by year, month"""

_Q5 = f"""
select rfm_segment, count(*) as customers,
       {O.hundredths(O.hu_div('sum(' + O.cents('lifetime_net_revenue') + ')', 'count(lifetime_net_revenue)'), 14)} as avg_lifetime_revenue,
       {O.hundredths(O.hu_div('sum(' + O.cents('avg_order_value') + ')', 'count(avg_order_value)'), 14)} as avg_order_value,
       {O.hundredths(O.hu_div('sum(cast(days_since_last_order as hugeint)) * 100', 'count(days_since_last_order)'), 14)} as avg_days_since_last_order
from mart_customer_360 group by rfm_segment order by avg_lifetime_revenue desc, rfm_segment"""

register("q1", O.with_ctes(_Q1, "fct_orders", "dim_products"))(lambda spark, sf_dir: wh(spark, sf_dir).q1())
register("q2", O.with_ctes(_Q2, "order_totals", "dim_customers"))(lambda spark, sf_dir: wh(spark, sf_dir).q2())
register("q3", O.with_ctes(_Q3, "fct_sessions"))(lambda spark, sf_dir: wh(spark, sf_dir).q3())
register("q4", O.with_ctes(_Q4, "fct_daily_sales", "dim_date"))(lambda spark, sf_dir: wh(spark, sf_dir).q4())
register("q5", O.with_ctes(_Q5, "mart_customer_360"))(lambda spark, sf_dir: wh(spark, sf_dir).q5())

# ---------------------------------------------------------- data quality --

from ..operators import faults as X  # noqa: E402
from ..operators import quality as Q  # noqa: E402

_DECLARED = Q.declared_checks(FIXTURE_CONFIG)


def _checks_of(kind: str) -> list:
    return [c for c in _DECLARED if c.kind == kind]


def _narrow_fact(w: Warehouse, checks: list) -> Callable[[str], DataFrame]:
    """The models of ``w``, the order fact written in the columns that ``checks``, the
    daily snapshot and the customer mart read."""
    columns = {c.column for c in checks if c.model == "fct_orders"}.union(M.DAILY_READS, M.PROFILE_READS)
    w.fact_part(columns)  # before the models made of it
    return lambda name: w.fact_part(columns) if name == "fct_orders" else w.table(name)


def _counted_lines(w: Warehouse, checks: list) -> dict[str, DataFrame]:
    """The counts of null checks on the order lines and the order fact, made while the fact is
    written in the columns that the daily snapshot and the customer mart read."""
    of = {m: [c for c in checks if c.model == m] for m in ("int_order_margins", "fct_orders")}
    seen = w.counted_fact_part({*M.DAILY_READS, *M.PROFILE_READS}, *[Q.scan_measures(cs) for cs in of.values()])
    if seen is None:
        return {}
    row = lambda cs, n: w.spark.range(1).select(*[F.lit(n.get(f"__c{i}", 0)).cast("long").alias(f"__c{i}") for i in range(len(cs))])
    return {m: row(cs, n) for (m, cs), n in zip(of.items(), seen, strict=True)}


def _lines_once(w: Warehouse, checks: list) -> Callable[[str], DataFrame]:
    """The models of ``w``, the order lines and the order fact from one written table, in the
    columns that ``checks``, the daily snapshot and the customer mart read."""

    def read(model: str) -> set[str]:
        of = [c for c in checks if c.model == model]
        return {word for c in of for word in (c.column or "", *re.findall(r"\w+", c.expression or ""))} | {X.KEYS[model]}

    lines: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in ("int_order_margins", "fct_orders", "fct_daily_sales", "mart_customer_360"):
            return w.table(name)
        if not lines:  # once, before the models made of it
            margins, fact = w.line_part(read("int_order_margins"), read("fct_orders").union(M.DAILY_READS, M.PROFILE_READS))
            lines.update({"int_order_margins": margins, "fct_orders": fact})
        return lines[name] if name in lines else w.table(name)

    return table


def _register_declared(name: str, kind: str) -> None:
    checks = _checks_of(kind)
    sql = O.with_ctes(" union all ".join(O.check_sql(c) for c in checks), *O.checks_deps(checks))

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = wh(spark, sf_dir)
        w.table("stg_order_items")  # before the orders, whose totals are those of its lines
        counted = _counted_lines(w, checks) if kind == "not_null" else {}
        narrow = {"relationships": _narrow_fact, "unique": _lines_once}.get(kind)
        return Q.run_checks(narrow(w, checks) if narrow else w.table, checks, counted)

    q.__name__ = name
    register(name, sql)(q)


_register_declared("dq_not_null", "not_null")
_register_declared("dq_unique", "unique")
_register_declared("dq_accepted_values", "accepted_values")
_register_declared("dq_relationships", "relationships")
_register_declared("dq_expression", "expression")

_SINGULAR_KEYS = {
    "dq_net_revenue": "net_revenue_non_negative",
    "dq_scd2_dates": "scd2_valid_interval",
    "dq_scd2_overlap": "scd2_no_overlap",
    "dq_scd2_current": "scd2_single_current",
    "dq_ties_to_source": "fact_ties_to_source",
    "dq_c360_covers": "c360_covers_facts",
}


def _register_singular(key: str, check: str) -> None:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = wh(spark, sf_dir)
        return Q.singular_check(check, w.once if check in Q.ONE_SCAN else w.table)

    q.__name__ = key
    register(key, O.with_ctes(O.singular_sql(check), *O.checks_deps([], [check])))(q)


for _k, _c in _SINGULAR_KEYS.items():
    _register_singular(_k, _c)

FRESHNESS_OFFSETS_H = (1, 30, 50)  # pass / warn / error cases


def _freshness_oracle() -> str:
    parts = " union all ".join(f"select 'raw_{e}' as source, max(_ingested_at) as max_loaded_at from stg_{e}" for e in ENTITIES)
    cfg = FIXTURE_CONFIG
    hour = 3600 * 1_000_000
    offsets = ", ".join(str(h) for h in FRESHNESS_OFFSETS_H)
    q = f"""
select m.source, m.max_loaded_at, g.latest + to_hours(o.h) as as_of,
       case when m.max_loaded_at is null then 'error'
            when date_diff('microsecond', m.max_loaded_at, g.latest + to_hours(o.h)) > {cfg.freshness_error_hours * hour} then 'error'
            when date_diff('microsecond', m.max_loaded_at, g.latest + to_hours(o.h)) > {cfg.freshness_warn_hours * hour} then 'warn'
            else 'pass' end as status
from ({parts}) m, (select max(max_loaded_at) as latest from ({parts}) x) g, (select unnest([{offsets}]) as h) o"""
    return O.with_ctes(q, *[f"stg_{e}" for e in ENTITIES])


@register("dq_freshness", _freshness_oracle())
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of the five raw sources at three evaluation instants:
    1, 30 and 50 hours after the latest load."""
    w = wh(spark, sf_dir)
    loaded = Q.last_loads({e: w.raw_table(e) for e in ENTITIES})
    latest = loaded.agg(F.max("max_loaded_at")).scalar()
    hours = F.explode(F.array(*[F.lit(h) for h in FRESHNESS_OFFSETS_H]))
    cases = loaded.withColumn("__hours", hours).withColumn("as_of", latest + F.make_dt_interval(hours=F.col("__hours")))
    return Q.freshness_status(cases.drop("__hours"), FIXTURE_CONFIG)


def _report_oracle() -> str:
    rows = [O.check_sql(c) for c in _DECLARED] + [O.singular_sql(s) for s in _SINGULAR_KEYS.values()]
    deps = O.checks_deps(_DECLARED, list(_SINGULAR_KEYS.values()))
    q = (
        "select *, case when violations = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from ("
        + " union all ".join(rows)
        + ") r"
    )
    return O.with_ctes(q, *deps)


def _views_once(w: Warehouse) -> Callable[[str], DataFrame]:
    """The models of ``w``, a view written once for all checks on it."""
    w.table("stg_order_items")  # before the orders, whose totals are those of its lines
    lines = _lines_once(w, _DECLARED)
    views: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name in ("int_order_margins", "fct_orders") or name in TABLE_MODELS:
            return lines(name)
        if name not in views:
            views[name] = written(w.table(name), name)
        return views[name]

    return table


@register("dq_report", _report_oracle())
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 213 checks (207 declared + 6 singular) with pass / warn / fail."""
    t = _views_once(wh(spark, sf_dir))
    declared = Q.run_checks(t, _DECLARED)
    singular = [Q.singular_check(s, t) for s in _SINGULAR_KEYS.values()]
    return Q.with_status(Q.union_all([declared, *singular]))


# ------------------------------------------------------- damaged inputs --

from ..operators.staging import stage_entity  # noqa: E402
from .build import BUILD_ORDER  # noqa: E402
from .catalog import register_tables  # noqa: E402


def _faulty_oracle() -> str:
    """The report over the damaged tables: every relation of its checks is replaced."""
    import re

    models = [m for m, _, _ in BUILD_ORDER]
    rows = " union all ".join([O.check_sql(c) for c in _DECLARED] + [O.singular_sql(s) for s in _SINGULAR_KEYS.values()])
    rows = re.sub(rf"\b({'|'.join(models)})\b", r"bad_\1", rows).replace("'bad_", "'")
    q = f"select *, case when violations = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from ({rows}) r"
    bad = ",\n".join(f"bad_{m} as materialized ({X.faulty_sql(m, _DECLARED)}\n)" for m in models)
    return O.with_ctes(f"select * from (with {bad}\n{q}) report", *models)


@register("dq_report_faulty", _faulty_oracle())
def dq_report_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 213 checks over every model with damaged copies of its rows added: one
    fault per declared check, and those of the checks that are queries.  The copies
    are made in the scan of each check, of its columns only, and never written."""
    clean = _views_once(wh(spark, sf_dir))
    tables = {model: X.with_faults(clean(model), model, _DECLARED) for model, _, _ in BUILD_ORDER}
    declared = Q.run_checks(tables.__getitem__, _DECLARED)
    singular = [Q.singular_check(s, tables.__getitem__) for s in _SINGULAR_KEYS.values()]
    return Q.with_status(Q.union_all([declared, *singular]))


_UNKNOWN_FACTS_ORACLE = """
select f.order_item_id, f.net_revenue,
       if(o.customer_id like '%3', '-1', f.customer_key) as customer_key, if(i.product_id like '%5', '-1', f.product_key) as product_key
from fct_orders f join stg_order_items i using (order_item_id) join stg_orders o on o.order_id = i.order_id"""


@register("fct_orders_unknown", O.with_ctes(_UNKNOWN_FACTS_ORACLE, "fct_orders", "stg_order_items", "stg_orders"))
def fct_orders_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact over dimensions that lack some members: its lines go to the
    Unknown member, none is lost."""
    w = wh(spark, sf_dir)
    products = M.keyed_products(w.table("stg_products"), w.table("dim_products").where("product_id NOT LIKE '%5'"))
    customers = w.table("dim_customers").where("customer_id NOT LIKE '%3'")
    lines = M.int_order_margins(w.table("stg_order_items"), M.keyed_orders(w.table("stg_orders"), customers), products)
    fact = M.fct_orders(lines, customers, FIXTURE_CONFIG)
    return fact.select("order_item_id", "net_revenue", "customer_key", "product_key")


# how the order documents are damaged, by order key: cut off, a decimal comma, no date
_REJECTED_ORACLE = """
select 'ORD-' || o_orderkey as order_id, (o_orderkey % 11 <> 0) as is_object,
       case when o_orderkey % 11 = 0 then ''
            else concat_ws(',', if(o_orderkey % 13 = 0, 'order_date', null), if(o_orderkey % 7 = 0, 'gross_amount', null)) end as bad_keys,
       null::decimal(12,2) as net_revenue
from orders where o_orderkey % 11 = 0 or o_orderkey % 13 = 0 or o_orderkey % 7 = 0
union all
select order_id, true, '', net_revenue from stg_orders
where substr(order_id, 5)::bigint % 11 <> 0 and substr(order_id, 5)::bigint % 13 <> 0 and substr(order_id, 5)::bigint % 7 <> 0"""


@register("rejected_documents", O.with_ctes(_REJECTED_ORACLE, "stg_orders"))
def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents, some damaged, staged with the malformed ones set apart: every
    document is in one of the two tables, with the keys that did not cast."""
    raw = wh(spark, sf_dir).raw_table("orders")
    key = F.regexp_extract("payload", '"order_id":"ORD-([0-9]+)"', 1).cast("long")
    text = F.col("payload")
    text = F.when(key % 7 == 0, F.regexp_replace(text, '"gross_amount":[0-9.]+', '"gross_amount":"12,50"')).otherwise(text)
    text = F.when(key % 13 == 0, F.regexp_replace(text, '"order_date":"[^"]*"', '"order_date":"yesterday"')).otherwise(text)
    text = F.when(key % 11 == 0, F.expr("left(payload, length(payload) - 3)")).otherwise(text)
    folder = f"{work_dir(spark)}/rejected-{uuid.uuid4().hex}"
    staged = stage_entity(raw.withColumn("payload", text), "orders", f"{folder}/stg_orders", f"{folder}/rejects")
    good = staged.accepted.select("order_id", F.lit(True).alias("is_object"), F.lit("").alias("bad_keys"), "net_revenue")
    if staged.rejects is None:
        return good
    bad = staged.rejects.select(
        F.regexp_extract("payload", '"order_id":"(ORD-[0-9]+)"', 1).alias("order_id"),
        (F.size("bad_keys") > 0).alias("is_object"),
        F.concat_ws(",", "bad_keys").alias("bad_keys"),
        F.lit(None).cast("decimal(12,2)").alias("net_revenue"),
    )
    return good.unionByName(bad)


@register(
    "array_documents",
    O.with_ctes("select entity, loaded_rows from (" + _COUNTS_ORACLE.format(col="loaded_rows") + ") t", *[f"stg_{e}" for e in ENTITIES]),
)
def array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity landed as compressed files of one JSON array each, loaded by ranges of
    them, published, and counted."""
    from ..sources import landing

    w = wh(spark, sf_dir)
    bronze, raw_root = landing.new_run_folder(spark, "bronze"), landing.new_run_folder(spark, "raw")
    for e in ENTITIES:
        landing.land_arrays(w.raw[e], f"{bronze}/{e}")
    landing.load_raw(spark, bronze, raw_root, run_id="r1", fmt="array")
    return landing.load_audit(spark, raw_root)


_NAMED = (("dim_products", "marts"), ("dim_date", "marts"), ("stg_customers", "staging"), ("stg_orders", "staging"), ("stg_sessions", "staging"))
_NAMED_ORACLE = " union all ".join(f"select '{m}' as model, 'dev_{layer}' as namespace, count(*) as n from {m}" for m, layer in _NAMED)


@register("catalog_tables", O.with_ctes(_NAMED_ORACLE, *[m for m, _ in _NAMED]))
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models written, registered in the databases of a development target, and
    counted by name."""
    w = wh(spark, sf_dir)
    folder = f"{work_dir(spark)}/catalog-{uuid.uuid4().hex}"
    for model, _ in _NAMED:
        w.table(model).write.parquet(f"{folder}/{model}")
    names = register_tables(spark, [(m, layer, f"{folder}/{m}") for m, layer in _NAMED], folder, FIXTURE_CONFIG, target="dev")
    counts = [f"SELECT '{m}' AS model, 'dev_{layer}' AS namespace, count(*) AS n FROM {name}" for (m, layer), name in zip(_NAMED, names, strict=True)]
    return spark.sql(" UNION ALL ".join(counts))
