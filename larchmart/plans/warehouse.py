"""A warehouse instance: raw tables in, every model available as a DataFrame.

Models are built lazily and memoised per instance, so one query plan that
needs a model twice refers to the same DataFrame (Catalyst then reuses the
exchange).  With a ``store`` folder the instance materialises like the
original build: raw, staging and mart models are written as Parquet the
first time they are needed and re-read from there (intermediate models stay
lazy views), so each model is computed once and lineage is cut at every
table.  ``shared()`` keeps one such instance per session and input folder.
``Warehouse.from_tables`` wraps models that a build has materialised.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Collection
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG, WarehouseConfig
from ..operators.staging import parse_entity
from ..session import work_dir
from ..sources import files, fixtures
from . import models as M
from . import reports as R

STAGING = ("stg_customers", "stg_products", "stg_sessions", "stg_orders", "stg_order_items")
MODELS = STAGING + (
    "int_order_margins",
    "int_sessions",
    "dim_customers",
    "dim_products",
    "dim_date",
    "fct_orders",
    "fct_sessions",
    "fct_daily_sales",
    "mart_customer_360",
)


# Models the original build stores as tables; the intermediate ones are views.
TABLE_MODELS = STAGING + (
    "dim_customers",
    "dim_products",
    "dim_date",
    "fct_orders",
    "fct_sessions",
    "fct_daily_sales",
    "mart_customer_360",
)

class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        cfg: WarehouseConfig = FIXTURE_CONFIG,
        store: str | None = None,
        sf_dir: str | None = None,
    ):
        self.spark = spark
        self.raw = dict(raw)
        self.cfg = cfg
        self.store = store
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._raw_done: set[str] = set()
        self._fact_part: DataFrame | None = None
        self._line_part: tuple[DataFrame, DataFrame] | None = None
        self._lock = threading.RLock()

    # -- construction ------------------------------------------------------
    @classmethod
    def from_driver_tables(
        cls, spark: SparkSession, sf_dir: str, cfg: WarehouseConfig = FIXTURE_CONFIG, store: str | None = None
    ) -> "Warehouse":
        return cls(spark, fixtures.raw_tables(spark, sf_dir), cfg, store, sf_dir)

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: dict[str, DataFrame], cfg: WarehouseConfig = FIXTURE_CONFIG) -> "Warehouse":
        wh = cls(spark, {}, cfg)
        wh._tables.update(tables)
        return wh

    def table(self, name: str) -> DataFrame:
        return self._get(name)

    def _write_read(self, df: DataFrame, rel: str) -> DataFrame:
        path = f"{self.store}/{rel}"
        # most bytes are keys in hex and document text, which snappy leaves as they are
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def _get(self, name: str) -> DataFrame:
        with self._lock:
            if name in self._tables:
                return self._tables[name]
            df = getattr(self, name)
            if self.store is not None and name in TABLE_MODELS:
                df = self._write_read(df, name)
                self._tables[name] = df
            return df

    def once(self, name: str) -> DataFrame:
        """A model for one scan of few columns: its table where it is written, else
        the plan that would write it, which then computes only these columns."""
        with self._lock:
            return self._tables.get(name) if name in self._tables else getattr(self, name)

    def fact_part(self, columns: Collection[str]) -> DataFrame:
        """The order fact for readers of ``columns``: its table where it is written,
        else one written in these columns only, so that the joins of the lines
        move no others."""
        with self._lock:
            if self.store is None or "fct_orders" in self._tables:
                return self._get("fct_orders")
            if self._fact_part is None or not set(columns) <= set(self._fact_part.columns):
                fact = M.fct_orders(self.fact_lines, self._get("dim_customers"), self.cfg, columns)
                self._fact_part = self._write_read(fact, f"fct_orders-part-{uuid.uuid4().hex[:12]}")
            return self._fact_part

    def counted_fact_part(self, columns: Collection[str], of_margins: list[Column], of_fact: list[Column]) -> tuple[dict, dict] | None:
        """Write the order fact in ``columns`` and count, while its lines pass, over
        ``int_order_margins`` and the whole fact.  Both come from one join of the lines: the
        versions of a customer are disjoint, so a keyed order is one row, and a product that the
        dimension has several times multiplies the lines behind the first count.  Of the
        item's id only whether there is one moves: ``columns`` and the counts may ask
        no more of it.  None where the fact is written, or a part of it."""
        with self._lock:
            if self.store is None or self._fact_part is not None or not {"fct_orders", "keyed_margins"}.isdisjoint(self._tables):
                return None
            if not {"order_item_id", "fct_order_item_key"}.isdisjoint(columns):
                raise ValueError("the item's id is not kept")
            items = self._get("stg_order_items").withColumn("order_item_id", F.when(F.col("order_item_id").isNotNull(), F.lit("")))
            catalog = M.counted_products(self._get("stg_products"), self._get("dim_products"))
            headers = M.keyed_orders(self._get("stg_orders"), self._get("dim_customers"))
            margins, fact = Observation(), Observation()
            lines = M.int_order_margins(items, headers, catalog, self.cfg.keep_orphans).observe(margins, *of_margins)
            whole = M.fct_orders(M.per_product_row(lines), self._get("dim_customers"), self.cfg).observe(fact, *of_fact)
            part = whole.select(*[c for c in whole.columns if c in columns])
            self._fact_part = self._write_read(part, f"fct_orders-part-{uuid.uuid4().hex[:12]}")
            return margins.get, fact.get

    def line_part(self, of_margins: Collection[str], of_fact: Collection[str]) -> tuple[DataFrame, DataFrame]:
        """``int_order_margins`` and the order fact in these columns, both from one table of
        the order lines that is written once: the lines are joined once for the two (see
        ``counted_fact_part``), and keys that are digests of other columns are not written."""
        with self._lock:
            part = self._line_part
            if part is None or not (set(of_margins) <= set(part[0].columns) and set(of_fact) <= set(part[1].columns)):
                items = self._get("stg_order_items")
                catalog = M.counted_products(self._get("stg_products"), self._get("dim_products"))
                headers = M.keyed_orders(self._get("stg_orders"), self._get("dim_customers"))
                lines = M.int_order_margins(items, headers, catalog, self.cfg.keep_orphans)
                read = {*of_margins, *[M.FACT_INPUTS.get(c, c) for c in of_fact], "product_id", "product_rows", "customer_key"} - {"product_key"}
                lines = lines.select(*[c for c in lines.columns if c in read])
                lines = self._write_read(lines, f"order_lines-part-{uuid.uuid4().hex[:12]}") if self.store is not None else lines
                keyed = lines.withColumn("product_key", M.product_key())
                fact = M.fct_orders(M.per_product_row(keyed), self._get("dim_customers"), self.cfg, of_fact)
                self._line_part = lines.select(*[c for c in lines.columns if c in of_margins]), fact
                if self.store is not None and "fct_orders" not in self._tables:
                    self._fact_part = fact
            return self._line_part

    def _fact_for(self, columns: Collection[str]) -> DataFrame | None:
        """The order fact as it is written, if with ``columns``."""
        with self._lock:
            part = self._fact_part
            if "fct_orders" not in self._tables and part is not None and set(columns) <= set(part.columns):
                return part
            return self._tables.get("fct_orders")

    def raw_table(self, entity: str) -> DataFrame:
        with self._lock:
            if self.store is not None and entity not in self._raw_done:
                self.raw[entity] = self._write_read(self.raw[entity], f"raw/{entity}")
                self._raw_done.add(entity)
            return self.raw[entity]

    def _stage(self, entity: str) -> DataFrame:
        # a staging table is written itself: its documents are parsed as they are
        # made, and only written where the raw table is asked for
        return parse_entity(self.raw[entity], entity)

    # -- staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._stage("customers")

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._stage("products")

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return self._stage("sessions")

    @cached_property
    def stg_orders(self) -> DataFrame:
        items = self._tables.get("stg_order_items")
        if items is not None and self.sf_dir is not None and "orders" not in self._raw_done:
            # the same documents, their totals summed up from the lines as they are written
            return parse_entity(fixtures.to_raw(fixtures.orders(self.spark, self.sf_dir, items)), "orders")
        return self._stage("orders")

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._stage("order_items")

    # -- intermediate ------------------------------------------------------
    @cached_property
    def int_order_margins(self) -> DataFrame:
        return M.int_order_margins(
            self._get("stg_order_items"), self._get("stg_orders"), self._get("stg_products"), self.cfg.keep_orphans
        )

    @cached_property
    def int_sessions(self) -> DataFrame:
        return M.int_sessions(self._get("stg_sessions"), self._get("stg_orders"))

    # -- marts -------------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return M.dim_customers(self._get("stg_customers"), self.cfg)

    @cached_property
    def dim_products(self) -> DataFrame:
        return M.dim_products(self._get("stg_products"), self.cfg)

    @cached_property
    def activity(self) -> DataFrame:
        return M.activity_instants(self._get("stg_orders"), self._get("stg_sessions"))

    @cached_property
    def date_spine(self) -> DataFrame:
        return M.date_spine(self.spark, self.cfg, self.activity)

    @cached_property
    def dim_date(self) -> DataFrame:
        return M.dim_date(self.spark, self.cfg, self.activity)

    @cached_property
    def keyed_margins(self) -> DataFrame:
        """``int_order_margins`` with the product's dimension key: what a build writes for the fact."""
        catalog = M.keyed_products(self._get("stg_products"), self._get("dim_products"))
        return M.int_order_margins(self._get("stg_order_items"), self._get("stg_orders"), catalog, self.cfg.keep_orphans)

    @cached_property
    def fact_lines(self) -> DataFrame:
        """The line economics with both dimension keys: those a build has written
        (without a customer version), or over the orders that have theirs."""
        if "keyed_margins" in self._tables:
            return self._tables["keyed_margins"]
        items = self._get("stg_order_items")  # before the orders, whose totals are those of its lines
        catalog = M.keyed_products(self._get("stg_products"), self._get("dim_products"))
        headers = M.keyed_orders(self._get("stg_orders"), self._get("dim_customers"))
        return M.int_order_margins(items, headers, catalog, self.cfg.keep_orphans)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return M.fct_orders(self.fact_lines, self._get("dim_customers"), self.cfg)

    @cached_property
    def fct_sessions(self) -> DataFrame:
        return M.fct_sessions(self._get("int_sessions"), self._get("dim_customers"), self.cfg)

    @cached_property
    def fct_daily_sales(self) -> DataFrame:
        written = self._fact_for(M.DAILY_READS)
        if written is None and self.store is not None and "keyed_margins" not in self._tables:
            return M.daily_sales_once(self.once("fct_orders"))  # the fact's one reader here
        fact = self._get("fct_orders") if written is None else written
        return M.fct_daily_sales(fact, by_order=self.store is not None)  # a store's fact is written by the join by order

    def order_grain(self) -> DataFrame:
        """``customer_order_lines`` of a fact that is written, or computed in the columns read."""
        written = self._fact_for(M.PROFILE_READS)
        by_order = self.store is not None or (written is None and "keyed_margins" not in self._tables)
        dim = self._get("dim_customers")
        return M.customer_order_lines(self.once("fct_orders") if written is None else written, dim, by_order)

    @cached_property
    def customer_profile(self) -> DataFrame:
        """Each fact is read once here: one that is not written is computed in the columns read."""
        written = self._fact_for(M.PROFILE_READS)
        by_order = self.store is not None or (written is None and "keyed_margins" not in self._tables)
        dim = self._get("dim_customers")
        fact = self.once("fct_orders") if written is None else written
        return M.customer_profile(dim, fact, self.once("fct_sessions"), self.cfg, by_order=by_order)

    @cached_property
    def mart_customer_360(self) -> DataFrame:
        scored = M.rfm_scores(self.customer_profile, self.cfg)
        return scored.withColumn("rfm_segment", M.rfm_segment())

    # -- reports -----------------------------------------------------------
    def q1(self) -> DataFrame:
        return R.q1_category_margin(self._get("fct_orders"), self._get("dim_products"))

    def q2(self) -> DataFrame:
        return R.q2_state_at_purchase(self._get("fct_orders"), self._get("dim_customers"))

    def q3(self) -> DataFrame:
        return R.q3_conversion(self._get("fct_sessions"))

    def q4(self) -> DataFrame:
        return R.q4_monthly(self._get("fct_daily_sales"), self._get("dim_date"))

    def q5(self) -> DataFrame:
        return R.q5_segments(self._get("mart_customer_360"))


# source tables of the warehouse: their files are part of a shared instance's key
SOURCES = ("nation", "customer", "part", "orders", "lineitem", "events")

_SHARED: dict[tuple, Warehouse] = {}
_SHARED_LOCK = threading.Lock()


def shared(spark: SparkSession, sf_dir: str, cfg: WarehouseConfig = FIXTURE_CONFIG) -> Warehouse:
    """The session's materialising warehouse over the tables in ``sf_dir`` as they
    are: other files there (or changed ones) make another instance."""
    found = tuple(files.listing(spark, f"{sf_dir}/{name}.parquet") for name in SOURCES)
    key = (spark.conf.get("spark.app.id", None) or id(spark), sf_dir, found, repr(cfg))
    with _SHARED_LOCK:
        wh = _SHARED.get(key)
        if wh is None:
            store = f"{work_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex[:12]}"
            wh = Warehouse.from_driver_tables(spark, sf_dir, cfg, store=store)
            _SHARED[key] = wh
        return wh
