"""Built models as catalog tables: a database per layer, a table per model.

A build writes to a folder of its own; the tables are external and point at it.
``register_tables`` points them at a newer build, one metadata change per table, so a
reader sees a table's old version or its new one, never a part.  A build registers
only when all its checks have passed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..config import WarehouseConfig
from ..sources.landing import layer_namespace


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_tables(spark: SparkSession, models: Iterable[tuple[str, str, str]], databases: str, cfg: WarehouseConfig, target: str = "prod") -> list[str]:
    """Make every (model, layer, path of its Parquet files) readable as
    ``<database of the layer>.<model>``; returns these names.  Databases that do
    not exist are created below the folder ``databases``."""
    names = []
    for model, layer, path in models:
        database = layer_namespace(target, layer, cfg.prod_targets)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION {_literal(f'{databases}/{database}.db')}")
        name = f"{_quoted(database)}.{_quoted(model)}"
        if spark.catalog.tableExists(name):
            if spark.table(name).schema == spark.read.parquet(path).schema:
                spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(path)}")
                spark.catalog.refreshTable(name)
                names.append(name)
                continue
            spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_literal(path)}")
        names.append(name)
    return names
