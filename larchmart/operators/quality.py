"""Data-quality checks (the test suite of the original build) as Spark jobs.

A check reports ``violations``: the number of rows its test query would
return (zero = pass).  Semantics per kind:

* ``not_null``        rows where the column is NULL
* ``unique``          distinct non-NULL values that occur more than once
* ``accepted_values`` distinct non-NULL values outside the list
* ``relationships``   child rows whose non-NULL key has no parent row
* ``expression``      rows where the predicate is false (NULL passes)

Cost model: all ``not_null`` and ``expression`` checks of one model are folded
into one aggregate over that model (one scan, partial aggregation, a one-row
result exploded into one row per check), its ``accepted_values`` into a second
scan that only violating values leave.  ``unique`` is a count per value behind a
shuffle by value (nearly every value is alone, so no map task sums up);
``relationships`` a left-anti join that Catalyst plans against the parent's key
column only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import WarehouseConfig
from .grouping import spread
from .scd2 import lead_within_key

RESULT_COLUMNS = ("check_name", "model", "column_name", "rule", "severity", "violations")
SCAN_KINDS = ("not_null", "accepted_values", "expression")
# checks on a few columns of the order fact
NARROW_KINDS = ("relationships",)


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    expression: str | None = None
    to_model: str | None = None
    to_field: str | None = None

    @property
    def predicate(self) -> str:
        return f"{self.column} {self.expression}" if self.column else str(self.expression)

    @property
    def rule(self) -> str:
        if self.kind == "accepted_values":
            return "in (" + ", ".join(str(v) for v in self.values) + ")"
        if self.kind == "relationships":
            return f"{self.to_model}.{self.to_field}"
        if self.kind == "expression":
            return self.predicate
        return ""


# ------------------------------------------------------------------ spec --


def declared_checks(cfg: WarehouseConfig) -> list[Check]:
    """Every declared check, model by model (fixed values of the contract)."""
    out: list[Check] = []

    def nn(model: str, *cols: str) -> None:
        out.extend(Check("not_null", model, c) for c in cols)

    def uq(model: str, *cols: str) -> None:
        out.extend(Check("unique", model, c) for c in cols)

    def av(model: str, col: str, values: Iterable) -> None:
        out.append(Check("accepted_values", model, col, values=tuple(values)))

    def ex(model: str, col: str | None, expression: str, severity: str = "error") -> None:
        out.append(Check("expression", model, col, severity=severity, expression=expression))

    def rel(model: str, col: str, to_model: str, to_field: str) -> None:
        out.append(Check("relationships", model, col, to_model=to_model, to_field=to_field))

    statuses = ("completed", "cancelled", "returned", "processing")
    scores = (0, 1, 2, 3, 4, 5)

    m = "stg_customers"
    nn(m, "customer_id", "email", "state", "created_at", "updated_at", "_ingested_at")

    m = "stg_products"
    uq(m, "product_id", "sku")
    nn(m, "product_id", "sku", "product_name", "category", "unit_cost", "retail_price", "_ingested_at")
    av(m, "category", cfg.categories)
    ex(m, "unit_cost", "> 0")
    ex(m, "retail_price", "> 0")
    ex(m, "retail_price", ">= unit_cost", "warn")

    m = "stg_sessions"
    uq(m, "session_id")
    nn(m, "session_id", "customer_id", "session_start", "session_end", "duration_seconds", "device_type")
    nn(m, "traffic_source", "page_views_count", "is_converted", "_ingested_at")
    rel(m, "customer_id", "stg_customers", "customer_id")
    ex(m, "duration_seconds", "> 0")
    av(m, "device_type", ("mobile", "desktop", "tablet"))
    av(m, "traffic_source", ("organic_search", "direct", "cpc_ad", "email_campaign", "social_media", "affiliate"))
    ex(m, "page_views_count", ">= 1")

    m = "stg_orders"
    ex(m, None, "gross_amount - discount_amount = net_revenue")
    uq(m, "order_id")
    nn(m, "order_id", "customer_id", "order_date", "order_status", "payment_method", "gross_amount")
    nn(m, "discount_amount", "net_revenue", "_ingested_at")
    rel(m, "customer_id", "stg_customers", "customer_id")
    av(m, "order_status", statuses)
    av(m, "payment_method", ("credit_card", "paypal", "apple_pay", "debit_card"))
    ex(m, "gross_amount", "> 0")
    ex(m, "discount_amount", ">= 0")
    ex(m, "net_revenue", ">= 0")

    m = "stg_order_items"
    ex(m, None, "(quantity * unit_price) - discount_amount = net_amount")
    uq(m, "order_item_id")
    nn(m, "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_amount", "net_amount")
    nn(m, "_ingested_at")
    rel(m, "order_id", "stg_orders", "order_id")
    rel(m, "product_id", "stg_products", "product_id")
    ex(m, "quantity", "> 0")
    ex(m, "unit_price", "> 0")
    ex(m, "discount_amount", ">= 0")
    ex(m, "net_amount", ">= 0")

    m = "int_sessions"
    uq(m, "session_id")
    nn(m, "session_id", "customer_id", "session_start", "duration_seconds", "device_type", "traffic_source")
    nn(m, "is_converted", "order_count", "session_attributed_revenue")
    ex(m, "order_count", ">= 0")
    ex(m, "session_attributed_revenue", ">= 0")

    m = "int_order_margins"
    uq(m, "order_item_id")
    nn(m, "order_item_id", "order_id", "customer_id", "order_date", "order_status", "product_id", "quantity")
    nn(m, "unit_price", "unit_cost", "gross_amount", "discount_amount", "net_revenue", "cogs", "gross_profit")
    ex(m, "net_revenue", ">= 0")
    ex(m, "cogs", ">= 0")

    m = "dim_customers"
    uq(m, "customer_key")
    nn(m, "customer_key", "customer_id", "email", "state", "created_at", "valid_from", "effective_updated_at", "is_current")

    m = "dim_products"
    uq(m, "product_key", "product_id", "sku")
    nn(m, "product_key", "product_id", "sku", "product_name", "category", "unit_cost", "retail_price", "created_at")

    m = "dim_date"
    uq(m, "date_key", "full_date")
    nn(m, "date_key", "full_date", "day_of_week", "day_name", "day_of_month", "month", "month_name", "quarter")
    nn(m, "fiscal_quarter", "year", "is_weekend")
    av(m, "day_of_week", (1, 2, 3, 4, 5, 6, 7))

    m = "fct_orders"
    uq(m, "fct_order_item_key", "order_item_id")
    nn(m, "fct_order_item_key", "order_item_id", "order_id", "customer_key", "product_key", "order_date_key")
    nn(m, "order_timestamp", "order_status", "payment_method", "quantity", "unit_price", "unit_cost")
    nn(m, "gross_amount", "discount_amount", "net_revenue", "cogs", "gross_profit")
    rel(m, "customer_key", "dim_customers", "customer_key")
    rel(m, "product_key", "dim_products", "product_key")
    rel(m, "order_date_key", "dim_date", "date_key")
    av(m, "order_status", statuses)

    m = "fct_sessions"
    uq(m, "session_key", "session_id")
    nn(m, "session_key", "session_id", "customer_key", "session_date_key", "session_start", "device_type")
    nn(m, "traffic_source", "duration_seconds", "page_views_count", "is_converted", "order_count")
    nn(m, "session_attributed_revenue")
    rel(m, "customer_key", "dim_customers", "customer_key")
    rel(m, "session_date_key", "dim_date", "date_key")

    m = "fct_daily_sales"
    uq(m, "date_key")
    nn(m, "date_key", "order_count", "customer_count", "order_line_count", "units_sold", "gross_amount")
    nn(m, "discount_amount", "net_revenue", "cogs", "gross_profit", "completed_net_revenue")
    nn(m, "returned_net_revenue", "cancelled_net_revenue")
    rel(m, "date_key", "dim_date", "date_key")

    m = "mart_customer_360"
    uq(m, "customer_key", "customer_id")
    nn(m, "customer_key", "customer_id", "email", "state", "customer_since", "lifetime_order_count")
    nn(m, "lifetime_net_revenue", "lifetime_gross_profit", "returned_order_count", "session_count")
    nn(m, "total_page_views", "recency_score", "frequency_score", "monetary_score", "rfm_segment")
    rel(m, "customer_key", "dim_customers", "customer_key")
    for s in ("recency_score", "frequency_score", "monetary_score"):
        av(m, s, scores)
    av(
        m,
        "rfm_segment",
        ("Champion", "Promising", "Needs Attention", "At Risk (High Value)", "Hibernating", "Never Purchased"),
    )
    return out


# ---------------------------------------------------------------- runner --


def _result(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.rule).alias("rule"),
        F.lit(check.severity).alias("severity"),
        violations.cast("long").alias("violations"),
    )


def _scan_measure(check: Check) -> Column:
    if check.kind == "not_null":
        return F.count_if(F.col(check.column).isNull())
    if check.kind == "expression":
        return F.count_if(~F.expr(check.predicate))
    raise ValueError(check.kind)


def scan_measures(checks: list[Check]) -> list[Column]:
    """The counts ``__c0``, ``__c1``, ... of null and expression checks."""
    return [_scan_measure(c).alias(f"__c{i}") for i, c in enumerate(checks)]


def scan_checks(model: DataFrame, checks: list[Check]) -> DataFrame:
    """All scan-type checks of one model: null and expression counts in one
    plain aggregate, accepted values apart, so that no row is expanded once per
    distinct count."""
    plain = [c for c in checks if c.kind != "accepted_values"]
    listed = [c for c in checks if c.kind == "accepted_values"]
    frames = []
    if plain:
        row = model.agg(*scan_measures(plain))
        frames.append(_per_check(row, plain))
    if listed:
        frames.append(accepted_values_checks(model, listed))
    return union_all(frames)


def _per_check(row: DataFrame, checks: list[Check]) -> DataFrame:
    """One result row per check from a one-row frame of counts ``__c0``, ``__c1``, ..."""
    results = F.array(*[_result(c, F.col(f"__c{i}")) for i, c in enumerate(checks)])
    return row.select(F.explode(results).alias("r")).select("r.*")


def _counts_by_index(found: DataFrame, n: int) -> DataFrame:
    """One row ``__c0`` ... from rows (``__i``, ``__n``)."""
    return found.agg(*[F.coalesce(F.sum(F.when(F.col("__i") == i, F.col("__n"))), F.lit(0)).alias(f"__c{i}") for i in range(n)])


def accepted_values_checks(model: DataFrame, checks: list[Check]) -> DataFrame:
    """Distinct values outside each check's list: only violating values leave
    the scan, as (check index, value as text), and are made distinct map side."""
    outside = F.array(
        *[
            F.when(~F.col(c.column).isin(*c.values), F.struct(F.lit(i).alias("__i"), F.col(c.column).cast("string").alias("__v")))
            for i, c in enumerate(checks)
        ]
    )
    values = model.select(F.explode(F.array_compact(outside)).alias("p")).select("p.*").distinct()
    found = values.groupBy("__i").agg(F.count(F.lit(1)).alias("__n"))
    return _per_check(_counts_by_index(found, len(checks)), checks)


def compact(text: Column) -> list[Column]:
    """``text`` in as few bytes as it needs, one to one: what is 32 lower-case hex digits,
    as surrogate keys are, is ``__hex``, its 16 bytes, anything else ``__text``."""
    is_hex = text.rlike("^[0-9a-f]{32}$") & (F.length(text) == 32)
    return [F.when(is_hex, F.unhex(text)).alias("__hex"), F.when(~is_hex, text).alias("__text")]


def unique_check(model: DataFrame, check: Check) -> DataFrame:
    c = F.col(check.column)
    values = model.select(*compact(c.cast("string"))).where("__hex IS NOT NULL OR __text IS NOT NULL")
    dupes = spread(values, "__hex", "__text").count().where(F.col("count") > 1)
    return dupes.agg(F.count(F.lit(1)).alias("v")).select(_result(check, F.col("v")).alias("r")).select("r.*")


def unique_checks(model: DataFrame, checks: list[Check]) -> DataFrame:
    """All ``unique`` checks of one model in one grouped aggregation.

    Each row emits one ``(check index, value as text)`` pair per checked
    column; counting per pair finds the duplicated values of every column at
    once.  The text form is
    exact for the key types involved (strings, integers, dates).
    """
    if len(checks) == 1:
        return unique_check(model, checks[0])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(i).alias("__i"), F.col(c.column).cast("string").alias("__v")) for i, c in enumerate(checks)])
    )
    values = model.select(pairs.alias("p")).select("p.*").where(F.col("__v").isNotNull())
    dupes = (
        spread(values.select("__i", *compact(F.col("__v"))), "__i", "__hex", "__text")
        .count()
        .where(F.col("count") > 1)
        .groupBy("__i")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    return _per_check(_counts_by_index(dupes, len(checks)), checks)


def relationship_check(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    fk = child.select(F.col(check.column).alias("__fk")).where(F.col("__fk").isNotNull())
    pk = parent.select(F.col(check.to_field).alias("__pk"))
    orphans = fk.join(pk, fk["__fk"] == pk["__pk"], "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("v")).select(_result(check, F.col("v")).alias("r")).select("r.*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def run_checks(tables: Callable[[str], DataFrame], checks: list[Check], counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Results of ``checks`` (one row each); ``tables(name)`` returns a model.  ``counted``:
    the row of ``scan_measures`` of models whose null and expression checks were
    counted while they were made."""
    frames: list[DataFrame] = []
    scans: dict[str, list[Check]] = {}
    uniques: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in SCAN_KINDS:
            scans.setdefault(c.model, []).append(c)
        elif c.kind == "unique":
            uniques.setdefault(c.model, []).append(c)
    for model, cs in scans.items():
        row = (counted or {}).get(model)
        frames.append(scan_checks(tables(model), cs) if row is None else _per_check(row, cs))
    for model, cs in uniques.items():
        frames.append(unique_checks(tables(model), cs))
    # one anti join per relationship: a small parent (e.g. the calendar) can
    # then be broadcast after its size is measured, a large one sort-merged
    for c in checks:
        if c.kind == "relationships":
            frames.append(relationship_check(tables(c.model), tables(c.to_model), c))
    return union_all(frames)


# ------------------------------------------------------- singular checks --


def _singular(name: str, model: str, violations: DataFrame) -> DataFrame:
    check = Check(name, model)
    return violations.agg(F.count(F.lit(1)).alias("v")).select(_result(check, F.col("v")).alias("r")).select("r.*")


def net_revenue_non_negative(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where(F.col("net_revenue") < 0).select("order_item_id", "net_revenue")


def scd2_invalid_intervals(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.where(F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from")))


def scd2_overlaps(dim_customers: DataFrame) -> DataFrame:
    """Versions whose interval runs past the start of the key's next version
    (``lead`` computed per (customer, day), so a hot customer is split)."""
    base = dim_customers.select("customer_id", "customer_key", "valid_from", "valid_to")
    v = lead_within_key(base, "customer_id", "valid_from", "next_valid_from").drop("__first")
    return v.where(
        F.col("next_valid_from").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_valid_from")))
    )


def scd2_current_not_single(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.where(F.col("is_current"))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("current_version_count"))
        .where(F.col("current_version_count") != 1)
    )


def fact_not_tied_to_source(fct_orders: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Orders whose line revenue differs from the header by more than a cent
    (the fan-out detector)."""
    fact = spread(fct_orders.select("order_id", "net_revenue"), "order_id").agg(F.sum("net_revenue").alias("fact_net_revenue"))
    src = stg_orders.select("order_id", F.col("net_revenue").alias("source_net_revenue"))
    j = src.join(fact, "order_id")
    return j.where(F.abs(F.col("source_net_revenue") - F.col("fact_net_revenue")) > F.lit(0.01).cast("decimal(3,2)"))


def c360_not_covering(c360: DataFrame, fct_orders: DataFrame, fct_sessions: DataFrame) -> DataFrame:
    """One row when the mart's order or session totals differ from the facts."""
    known = fct_orders.select("order_id").where(F.col("order_id").isNotNull())
    fact_orders = spread(known, "order_id").agg(F.lit(1)).agg(F.count(F.lit(1))).scalar()
    fact_sessions = fct_sessions.agg(F.count(F.lit(1))).scalar()
    m = c360.agg(F.sum("lifetime_order_count").alias("mo"), F.sum("session_count").alias("ms"))
    return m.where((F.col("mo") != fact_orders) | (F.col("ms") != fact_sessions))


SINGULAR = {
    "net_revenue_non_negative": ("fct_orders", lambda t: net_revenue_non_negative(t("fct_orders"))),
    "scd2_valid_interval": ("dim_customers", lambda t: scd2_invalid_intervals(t("dim_customers"))),
    "scd2_no_overlap": ("dim_customers", lambda t: scd2_overlaps(t("dim_customers"))),
    "scd2_single_current": ("dim_customers", lambda t: scd2_current_not_single(t("dim_customers"))),
    "fact_ties_to_source": ("fct_orders", lambda t: fact_not_tied_to_source(t("fct_orders"), t("stg_orders"))),
    "c360_covers_facts": (
        "mart_customer_360",
        lambda t: c360_not_covering(t("mart_customer_360"), t("fct_orders"), t("fct_sessions")),
    ),
}


# these read their model once, and one column of it
ONE_SCAN = ("net_revenue_non_negative",)


def singular_check(name: str, tables: Callable[[str], DataFrame]) -> DataFrame:
    model, build = SINGULAR[name]
    return _singular(name, model, build(tables))


# -------------------------------------------------------------- freshness --


def last_loads(raw: dict[str, DataFrame]) -> DataFrame:
    """source, max_loaded_at: one aggregate per raw source."""
    return union_all(
        [
            df.agg(F.max("_ingested_at").alias("max_loaded_at")).select(F.lit(f"raw_{entity}").alias("source"), "max_loaded_at")
            for entity, df in raw.items()
        ]
    )


def freshness_status(loaded: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """pass / warn / error of each ``max_loaded_at`` seen at ``as_of``; a source
    that was never loaded is an error."""
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), F.col("as_of"))
    hour_us = 3600 * 1_000_000
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age_us > F.lit(cfg.freshness_error_hours * hour_us)), F.lit("error"))
        .when(age_us > F.lit(cfg.freshness_warn_hours * hour_us), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return loaded.select("source", "max_loaded_at", "as_of", status.alias("status"))


def freshness(raw: dict[str, DataFrame], as_of: Column | datetime, cfg: WarehouseConfig) -> DataFrame:
    """Per raw source: latest ``_ingested_at`` and pass / warn / error
    against ``as_of`` (explicit, so the verdict is reproducible)."""
    if isinstance(as_of, datetime):
        as_of = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return freshness_status(last_loads(raw).withColumn("as_of", as_of), cfg)


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status",
        F.when(F.col("violations") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail")),
    )


class QualityGateError(RuntimeError):
    """Raised at the end of a gated build; ``result`` holds what was built,
    the report of every check that ran, and the failed and skipped models."""

    def __init__(self, message: str, result=None):
        super().__init__(message)
        self.result = result
