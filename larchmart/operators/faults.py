"""Damaged copies of a model's rows, so that every check can be seen to find something.

For each declared check of a model there is a fault: values for some columns, as SQL
expressions over the clean row, that break the check (none for ``unique``: the copy
itself does).  ``with_faults`` adds to a model one copy of some of its rows per fault,
in one scan; the same faults, written as SQL, damage the tables of the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import Check

# the column by whose last character rows are chosen for a fault
KEYS = {
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_sessions": "session_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "int_order_margins": "order_item_id",
    "int_sessions": "session_id",
    "dim_customers": "customer_key",
    "dim_products": "product_key",
    "dim_date": "date_key",
    "fct_orders": "fct_order_item_key",
    "fct_sessions": "session_key",
    "fct_daily_sales": "date_key",
    "mart_customer_360": "customer_key",
}
# whole numbers among the columns that a list or a key check is on
NUMBERS = {"day_of_week", "recency_score", "frequency_score", "monetary_score", "date_key", "order_date_key", "session_date_key"}
NULL = "null"


def fault_of(check: Check) -> dict[str, str]:
    """Column -> SQL expression that makes a copied row break ``check``."""
    c = check.column
    if check.kind == "not_null":
        if check.model == "dim_customers" and c in ("customer_id", "valid_from"):
            # versions of no customer, without an interval: their order is no question
            return {"customer_id": NULL, "valid_from": NULL, "valid_to": NULL}
        return {c: NULL}
    if check.kind == "accepted_values":
        return {c: "99" if c in NUMBERS else f"concat('bad-', {c})"}
    if check.kind == "relationships":
        return {c: "17000101" if c in NUMBERS else f"concat('no-', {c})"}
    if check.kind == "expression":
        if c is None:  # an arithmetic contract: the total is off by one
            total = check.predicate.rpartition("=")[2].strip()
            return {total: f"{total} + 1"}
        return {c: "unit_cost - 0.01" if "unit_cost" in check.expression else "-1"}
    return {}


# what breaks the checks that are queries of their own, besides the faults above
SINGULAR_FAULTS: dict[str, list[dict[str, str]]] = {
    "dim_customers": [{"valid_from": "valid_from + interval '1' second", "valid_to": "valid_from"}],
    "fct_orders": [{"net_revenue": "-1"}],
}


def faults_of(model: str, checks: list[Check]) -> list[dict[str, str]]:
    """The faults of a model, each once."""
    found = [fault_of(c) for c in checks if c.model == model] + SINGULAR_FAULTS.get(model, [])
    return [f for i, f in enumerate(found) if f not in found[:i]]


def chosen(model: str, number: int) -> str:
    """SQL condition on the rows that get fault ``number``: a key's last character."""
    return f"cast({KEYS[model]} as {{text}}) like '%{number % 10}'"


def with_faults(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """``df`` and its damaged copies."""
    faults = faults_of(model, checks)
    marks = [F.lit(-1)] + [F.when(F.expr(chosen(model, i).format(text="string")), F.lit(i)) for i in range(len(faults))]
    every = df.withColumn("__fault", F.explode(F.array_compact(F.array(*marks))))
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        for i, fault in enumerate(faults):
            if field.name in fault:
                value = F.when(F.col("__fault") == i, F.expr(fault[field.name]).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return every.select(*columns)


def faulty_sql(model: str, checks: list[Check]) -> str:
    """The same rows as SQL over a relation named like the model."""
    parts = [f"select * from {model}"]
    for i, fault in enumerate(faults_of(model, checks)):
        replaced = ", ".join(f"{expression} as {column}" for column, expression in fault.items())
        parts.append(f"select *{f' replace ({replaced})' if fault else ''} from {model} where {chosen(model, i).format(text='varchar')}")
    return "\nunion all ".join(parts)
