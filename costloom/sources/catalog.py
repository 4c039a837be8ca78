"""Where the jobs read their inputs from.

A catalog maps the reference's logical table names to DataFrames. ``ParquetCatalog``
is the production form (one Parquet dataset per table, the bill partitioned by
``invoice_month``); ``FixtureCatalog`` builds the same tables over the driver testdata.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.sources import fixture_defs as FX

TABLES = (
    "cost_usage_report", "usage_transaction", "usage_transaction_estimated",
    "account_config", "price_list", "rifee", "rifee_estimated",
    "resource_user", "resource_user_estimated", "resource_tag",
    "adhoc_billing", "adhoc_billing_instance", "adhoc_billing_schedule_hours",
    "kube_monthly_namespace_usage", "kube_namespace_product_mapping",
    "upfront_purchases_amortization_schedule", "rifee_amortization_schedule",
    "azure_cost_summary",
)


class Catalog:
    spark: SparkSession

    def table(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


class ParquetCatalog(Catalog):
    """``{root}/{table}`` Parquet datasets; ``cost_usage_report`` is partitioned by
    ``invoice_month`` so a month filter becomes a partition filter."""

    def __init__(self, spark: SparkSession, root: str, paths: dict[str, str] | None = None):
        self.spark, self.root, self.paths = spark, root.rstrip("/"), paths or {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths.get(name, f"{self.root}/{name}"))


class FixtureCatalog(Catalog):
    """The reference's tables as views over ``{sf_dir}/*.parquet`` plus fixed config rows."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _derived(self, parts) -> DataFrame:
        out = None
        for p in parts:
            df = self._raw(p["source"])
            if p["where"]:
                df = df.where(F.expr(FX.expr_for(p["where"], "spark")))
            df = df.select(*[F.expr(FX.expr_for(e, "spark")).alias(n) for n, e in p["columns"]])
            out = df if out is None else out.unionByName(df)
        return out

    def _config(self, name: str) -> DataFrame:
        return self.spark.sql(FX.config_values_sql(name, "spark"))

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FX.DERIVED_VIEWS:
                self._cache[name] = self._derived(FX.DERIVED_VIEWS[name])
            elif name in FX.CONFIG_TABLES:
                self._cache[name] = self._config(name)
            else:
                raise KeyError(name)
        return self._cache[name]

    @cached_property
    def cur(self) -> DataFrame:
        return self.table("cost_usage_report")


class DictCatalog(Catalog):
    """Tables given as DataFrames (tests, notebooks); anything missing falls back to
    ``fallback`` (for example a FixtureCatalog for the configuration tables)."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], fallback: Catalog | None = None):
        self.spark, self.tables, self.fallback = spark, dict(tables), fallback

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        if self.fallback is None:
            raise KeyError(name)
        return self.fallback.table(name)
