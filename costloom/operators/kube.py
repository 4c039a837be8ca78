"""Kubernetes cost reallocation: namespace weights (KUB1) and the two job variants (KUB2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, month_of, scaled
from costloom.operators.lookup import lookup_join
from costloom.settings import DEFAULTS, Settings


def kube_weights(usage: DataFrame, mapping: DataFrame, month: Column | int, daily_notes: bool, cfg: Settings = DEFAULTS) -> DataFrame:
    """KUB1: namespace portions of the month mapped to company products; an unmapped
    namespace keeps its cost in the cluster's own product. Portions are summed per
    (cluster product, company, product, note) and used as given (not normalised, Q15)."""
    m = mapping.select(c("kube_namespace").alias("m_ns"), c("company").alias("m_company"),
                       c("company_product").alias("m_product"))
    k = (usage.where(c("month_id") == month_of(month))
         .join(m, c("kube_namespace") == c("m_ns"), "left"))
    cluster = F.upper(c("cluster_name"))
    mapped_note = F.concat(F.lit(K.NOTE_K8_DAILY_PREFIX), cluster, F.lit(")")) if daily_notes \
        else F.lit(K.NOTE_K8_SUMMARY)
    return (k.select("month_id", cluster.alias("kube_product"),
                     F.coalesce(c("m_company"), F.lit(cfg.regional_company)).alias("user_company"),
                     F.coalesce(c("m_product"), cluster).alias("user_product"),
                     "usage_portion",
                     F.when(c("m_company").isNull(), F.lit(K.NOTE_K8_UNMAPPED)).otherwise(mapped_note).alias("note"))
            .groupBy("month_id", "kube_product", "user_company", "user_product", "note")
            .agg(F.sum("usage_portion").cast(K.WEIGHT).alias("weight")))


def _weights(weights: DataFrame) -> DataFrame:
    return weights.select(c("kube_product").alias("k_product"), c("user_company").alias("k_company"),
                          c("user_product").alias("k_user_product"), c("weight").alias("k_weight"),
                          c("note").alias("k_note"), F.lit(True).alias("k_hit"))


def reallocate_kube_daily(agg: DataFrame, weights: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Daily KUB2: Regional-account, Regional-company rows whose product is a weighted
    cluster become one row per weight (company, product, note from the weight)."""
    is_kube = (c("line_item_usage_account_id") == cfg.regional_account_id) & \
              (c("resource_tags_user_company") == cfg.regional_company)
    j = lookup_join(agg, _weights(weights), [("resource_tags_user_product", "k_product")], residual=is_kube)
    hit = F.coalesce(c("k_hit"), F.lit(False))
    j = j.withColumns({
        "resource_tags_user_company": F.when(hit, c("k_company")).otherwise(c("resource_tags_user_company")),
        "resource_tags_user_product": F.when(hit, c("k_user_product")).otherwise(c("resource_tags_user_product")),
        "note": F.when(hit, c("k_note")).otherwise(c("note")),
        **{m: F.when(hit, scaled(c(m), c("k_weight"), K.MONEY)).otherwise(c(m))
           for m in ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")}})
    return j.drop("k_product", "k_company", "k_user_product", "k_weight", "k_note", "k_hit")


def reallocate_kube_summary(agg: DataFrame, weights: DataFrame, has_usage: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Summary KUB2: every Regional row with one of the two kube products is replaced by its
    weighted split; a product with no weights loses its cost (Q14). Without usage rows in the
    month (``has_usage``, a scalar of the plan) everything stays."""
    target = ((c("account_id") == cfg.regional_account_id) & (c("user_company") == cfg.regional_company)
              & c("user_product").isin(*cfg.kube_products))
    j = lookup_join(agg, _weights(weights), [("user_product", "k_product")], residual=target)
    hit = F.coalesce(c("k_hit"), F.lit(False))
    j = j.where(hit | ~F.coalesce(target, F.lit(False)) | ~has_usage)
    j = j.withColumns({
        "user_company": F.when(hit, c("k_company")).otherwise(c("user_company")),
        "user_product": F.when(hit, c("k_user_product")).otherwise(c("user_product")),
        "note": F.when(hit, c("k_note")).otherwise(c("note")),
        **{m: F.when(hit, scaled(c(m), c("k_weight"), K.DEC38_8)).otherwise(c(m)) for m in ("actual_cost", "retail_cost")}})
    return j.drop("k_product", "k_company", "k_user_product", "k_weight", "k_note", "k_hit")


def kube_guard_rows(account_col: str, company_col: str, product_col: str, cfg: Settings = DEFAULTS) -> Column:
    """The reference's entry guard: any Regional row carrying one of the two kube products."""
    return ((c(account_col) == cfg.regional_account_id) & (c(company_col) == cfg.regional_company)
            & c(product_col).isin(*cfg.kube_products))
