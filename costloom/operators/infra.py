"""Shared-infrastructure redistribution over AWS Hosting and Azure companies (INF1, INF2)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, from_units, keep_unless, month_of, scaled, times_over, units
from costloom.operators.fanout import fan_out
from costloom.settings import DEFAULTS, Settings


def with_share(g: DataFrame, col: str, name: str, dividend=K.MONEY) -> DataFrame:
    """WIN1: each row's share of the grand total. The total is a partial aggregate whose one
    row is broadcast back, and the quotient is exact (rounded once, at 16 places)."""
    total = g.agg(F.sum(col).cast(K.MONEY).alias("_total")).withColumn("_one", F.lit(1))
    share = times_over(units(c(col).cast(dividend), 12), F.lit(Decimal(10 ** 16)), units(c("_total"), 12))
    return (g.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
            .withColumn(name, from_units(share, 16, K.WEIGHT)).drop("_one", "_total"))


def infra_weights_daily(agg: DataFrame, azure: DataFrame, month: Column | int, cfg: Settings = DEFAULTS) -> DataFrame:
    """INF1, daily variant: weights per (cost source, company) from Hosting on-demand cost
    (infrastructure itself excluded) and the month's Azure retail cost (Q16)."""
    aws = (agg.where((c("bill_billing_entity") == K.AWS_ENTITY) & (c("usage_account_name") == cfg.hosting_account_name)
                     & (c("resource_tags_user_company") != cfg.infra_company))
           .groupBy(c("bill_billing_entity").alias("cost_source"), "resource_tags_user_company")
           .agg(F.sum("pricing_public_on_demand_cost").cast(K.MONEY).alias("pricing_public_on_demand_cost")))
    az = (azure.where(c("billing_period") == month_of(month))
          .groupBy(F.lit(K.AZURE_SOURCE).alias("cost_source"), c("tag_company").alias("resource_tags_user_company"))
          .agg(F.sum("retail_cost").cast(K.MONEY).alias("pricing_public_on_demand_cost")))
    g = (aws.unionByName(az).groupBy("cost_source", "resource_tags_user_company")
         .agg(F.sum("pricing_public_on_demand_cost").cast(K.MONEY).alias("pricing_public_on_demand_cost")))
    return with_share(g, "pricing_public_on_demand_cost", "retail_weight")


def infra_weights_monthly(final: DataFrame, azure: DataFrame, month: Column | int, cfg: Settings = DEFAULTS) -> DataFrame:
    """INF1, detail/summary variant: weights per company over Hosting retail cost and Azure
    (a company present in both clouds merges); dividend at 8 places."""
    aws = (final.where((c("account_name") == cfg.hosting_account_name) & (c("user_company") != cfg.infra_company))
           .select("user_company", c("retail_cost").cast(K.MONEY).alias("retail_cost")))
    az = (azure.where(c("billing_period") == month_of(month))
          .select(c("tag_company").alias("user_company"), c("retail_cost").cast(K.MONEY).alias("retail_cost")))
    g = aws.unionByName(az).groupBy("user_company").agg(F.sum("retail_cost").cast(K.MONEY).alias("retail_cost"))
    return with_share(g, "retail_cost", "weight", K.DIVIDEND)


def redistribute_infra_daily(agg: DataFrame, weights: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """INF2, daily: Hosting infrastructure rows split over every weighted company; the note
    names the cloud. Only the originals go: an Azure ``COMPANY INFRASTRUCTURE`` share stays (Q17)."""
    target = ((c("bill_billing_entity") == K.AWS_ENTITY) & (c("usage_account_name") == cfg.hosting_account_name)
              & (c("resource_tags_user_company") == cfg.infra_company))
    w = weights.select(c("cost_source").alias("w_source"), c("resource_tags_user_company").alias("w_company"),
                       c("retail_weight").alias("w_weight"))
    x = fan_out(agg, target, w, {"w_source": "string", "w_company": "string", "w_weight": K.WEIGHT})
    hit = c("_w_hit")
    x = x.withColumns({
        "resource_tags_user_company": F.when(hit, c("w_company")).otherwise(c("resource_tags_user_company")),
        **{m: F.when(hit, scaled(c(m), c("w_weight"), K.MONEY)).otherwise(c(m))
           for m in ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")},
        "note": F.when(hit, F.concat(F.lit(K.NOTE_INFRA_DAILY_PREFIX), c("w_source"), F.lit(")"))).otherwise(c("note"))})
    return x.drop("w_source", "w_company", "w_weight", "_w_hit")


def monthly_target(cfg: Settings = DEFAULTS):
    return (c("account_name") == cfg.hosting_account_name) & (c("user_company") == cfg.infra_company)


def _monthly_weights(weights: DataFrame) -> DataFrame:
    return weights.select(c("user_company").alias("w_company"), c("weight").alias("w_weight"))


def redistribute_infra_detail(final: DataFrame, weights: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """INF2, detail: split, drop rows whose retail cost rounds to zero at 8 places, then drop
    every Hosting infrastructure row (an Azure infrastructure share goes too, Q17)."""
    x = fan_out(final, monthly_target(cfg), _monthly_weights(weights), {"w_company": "string", "w_weight": K.WEIGHT})
    hit = c("_w_hit")
    x = x.withColumns({
        "user_company": F.when(hit, c("w_company")).otherwise(c("user_company")),
        "retail_cost": F.when(hit, scaled(c("retail_cost"), c("w_weight"), K.DEC38_8)).otherwise(c("retail_cost")),
        "quantity": F.when(hit, scaled(c("quantity"), c("w_weight"), K.MONEY)).otherwise(c("quantity")),
        "note": F.when(hit, F.lit(K.NOTE_INFRA_DETAIL)).otherwise(c("note"))})
    x = x.where(keep_unless(F.round(c("retail_cost"), 8) == 0)).where(keep_unless(monthly_target(cfg)))
    return x.drop("w_company", "w_weight", "_w_hit")


def redistribute_infra_summary(final: DataFrame, weights: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """INF2, summary: split the four measures, product becomes ``''``, note ``INFRA COSTS``;
    then drop every Hosting infrastructure row (Q17)."""
    x = fan_out(final, monthly_target(cfg), _monthly_weights(weights), {"w_company": "string", "w_weight": K.WEIGHT})
    hit = c("_w_hit")
    x = x.withColumns({
        "user_company": F.when(hit, c("w_company")).otherwise(c("user_company")),
        "user_product": F.when(hit, F.lit("")).otherwise(c("user_product")),
        "note": F.when(hit, F.lit(K.NOTE_INFRA_MONTHLY)).otherwise(c("note")),
        **{m: F.when(hit, scaled(c(m), c("w_weight"), t)).otherwise(c(m))
           for m, t in (("actual_cost", K.DEC38_8), ("weighted_actual_cost", K.DEC38_8),
                        ("retail_cost", K.DEC38_8), ("retail_cost_percent", K.PERCENT))}})
    return x.where(keep_unless(monthly_target(cfg))).drop("w_company", "w_weight", "_w_hit")
