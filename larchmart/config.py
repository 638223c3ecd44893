"""Warehouse-wide settings (the project variables of the original build)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

# Fixed values that must equal the original project's for identical results:
# calendar spine start and length, Unknown-member sentinels, SCD2 beginning of
# time, the product categories and the freshness thresholds (hours).
DEFAULT_SPINE_START = date(2023, 1, 1)
DEFAULT_SPINE_DAYS = 1460
UNKNOWN_KEY = "-1"
UNKNOWN_DATE_KEY = 19000101
BEGINNING_OF_TIME = datetime(1900, 1, 1)
DEFAULT_CATEGORIES = (
    "Electronics",
    "Apparel",
    "Home & Kitchen",
    "Beauty & Personal Care",
    "Sports & Outdoors",
    "Books & Stationery",
)
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48


@dataclass(frozen=True)
class WarehouseConfig:
    # Calendar spine.  ``None`` for both derives it from the data: whole
    # calendar years from the first to the last order or session.
    spine_start: date | None = DEFAULT_SPINE_START
    spine_days: int | None = DEFAULT_SPINE_DAYS
    unknown_key: str = UNKNOWN_KEY
    unknown_date_key: int = UNKNOWN_DATE_KEY
    beginning_of_time: datetime = BEGINNING_OF_TIME
    categories: tuple[str, ...] = DEFAULT_CATEGORIES
    # Targets whose layer namespaces are written verbatim (no target prefix).
    prod_targets: tuple[str, ...] = ("prod",)
    freshness_warn_hours: int = FRESHNESS_WARN_HOURS
    freshness_error_hours: int = FRESHNESS_ERROR_HOURS
    # Parity default: lines without a header or product drop out (inner joins).
    keep_orphans: bool = False
    # Share of an entity's documents that may be set apart as malformed before
    # the build fails its staging model (0: any, as the original casts do).
    max_reject_share: float = 0.0
    # NTILE bucket count for the RFM scores.
    rfm_tiles: int = 5

    def with_(self, **kw) -> "WarehouseConfig":
        return replace(self, **kw)


# Settings for the warehouse built from the driver's TPC-H-style tables: the
# calendar covers the years the data covers (orders 1995-2001 and events in
# January 2024 give 1995-01-01 .. 2024-12-31) and product categories are the
# six part types.
FIXTURE_CONFIG = WarehouseConfig(
    spine_start=None,
    spine_days=None,
    categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
)
