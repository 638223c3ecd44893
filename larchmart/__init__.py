"""Spark-native retail warehouse: JSON landing, typed staging, SCD2 star schema,
customer mart and data-quality gates, all on the DataFrame API."""

from .config import FIXTURE_CONFIG, WarehouseConfig

__all__ = ["FIXTURE_CONFIG", "WarehouseConfig"]
