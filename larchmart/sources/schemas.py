"""Raw and staging schemas of the five landed entities.

Raw tables keep the document verbatim: ``(id, payload, _ingested_at)``.
Staging declares one typed column per top-level JSON key; nothing is
inferred, unknown keys are ignored and missing keys become NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

ENTITIES = ("customers", "products", "sessions", "orders", "order_items")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("payload", T.StringType(), True),
        T.StructField("_ingested_at", T.TimestampNTZType(), True),
    ]
)

_S = "string"
_TS = "timestamp_ntz"

# Staging contract per entity: (column, Spark type, JSON key) in column order.
# The type strings are fixed values of the original contract.
STAGING_FIELDS: dict[str, list[tuple[str, str, str]]] = {
    "customers": [
        ("customer_id", _S, "customer_id"),
        ("first_name", _S, "first_name"),
        ("last_name", _S, "last_name"),
        ("email", _S, "email"),
        ("city", _S, "city"),
        ("state", _S, "state"),
        ("postal_code", _S, "postal_code"),
        ("country", _S, "country"),
        ("created_at", _TS, "created_at"),
        ("updated_at", _TS, "updated_at"),
    ],
    "products": [
        ("product_id", _S, "product_id"),
        ("sku", _S, "sku"),
        ("product_name", _S, "product_name"),
        ("category", _S, "category"),
        ("unit_cost", "decimal(10,2)", "unit_cost"),
        ("retail_price", "decimal(10,2)", "retail_price"),
        ("created_at", _TS, "created_at"),
    ],
    "sessions": [
        ("session_id", _S, "session_id"),
        ("customer_id", _S, "customer_id"),
        ("session_start", _TS, "session_start"),
        ("session_end", _TS, "session_end"),
        ("duration_seconds", "int", "duration_seconds"),
        ("device_type", _S, "device_type"),
        ("traffic_source", _S, "traffic_source"),
        ("page_views_count", "int", "page_views_count"),
        # derived: lower(text) in ('true', '1'), see operators.staging
        ("is_converted", "boolean", "converted"),
    ],
    "orders": [
        ("order_id", _S, "order_id"),
        ("customer_id", _S, "customer_id"),
        ("session_id", _S, "session_id"),
        ("order_date", _TS, "order_date"),
        ("order_status", _S, "order_status"),
        ("payment_method", _S, "payment_method"),
        ("gross_amount", "decimal(12,2)", "gross_amount"),
        ("discount_amount", "decimal(12,2)", "discount_amount"),
        ("net_revenue", "decimal(12,2)", "net_revenue"),
    ],
    "order_items": [
        ("order_item_id", _S, "order_item_id"),
        ("order_id", _S, "order_id"),
        ("product_id", _S, "product_id"),
        ("quantity", "int", "quantity"),
        ("unit_price", "decimal(10,2)", "unit_price"),
        ("discount_amount", "decimal(10,2)", "discount_amount"),
        ("net_amount", "decimal(10,2)", "net_amount"),
    ],
}


def payload_struct(entity: str) -> T.StructType:
    """All-STRING struct of the entity's JSON keys (text first, cast after)."""
    return T.StructType([T.StructField(key, T.StringType(), True) for _, _, key in STAGING_FIELDS[entity]])


def spark_type(typ: str) -> T.DataType:
    """Type string used in ``STAGING_FIELDS`` -> DataType (no JVM needed)."""
    if typ.startswith("decimal("):
        p, s = typ[len("decimal(") : -1].split(",")
        return T.DecimalType(int(p), int(s))
    return {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "boolean": T.BooleanType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }[typ]


def staging_schema(entity: str) -> T.StructType:
    fields = [T.StructField(name, spark_type(typ), True) for name, typ, _ in STAGING_FIELDS[entity]]
    fields.append(T.StructField("_ingested_at", T.TimestampNTZType(), True))
    return T.StructType(fields)
