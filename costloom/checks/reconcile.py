"""Reconciliation checks (CHK1-CHK10): the invariants the reference keeps as commented SQL,
as DataFrames a job run (or a test) can assert on. All are grouped aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, shifted
from costloom.settings import DEFAULTS, Settings


def adhoc_balance(before: DataFrame, after: DataFrame, alloc: DataFrame, *, account_col: str, name_col: str,
                  ts_col: str, type_col: str, measure: str, skip_types, note: str) -> DataFrame:
    """CHK1: per (account, instance, UTC+7 date, hour), original minus reallocated cost.
    Zero everywhere with account-scoped weights; the reference's instance scope (Q1)
    over-allocates where another account shares the instance name."""
    local = shifted(c(ts_col))
    keys = [c(account_col).alias("account_id"), c(name_col).alias("instance_name"),
            F.to_date(local).alias("usage_date_bkk"), F.hour(local).alias("hour_bkk")]
    slots = alloc.select("account_id", "instance_name", c("calendar_date").alias("usage_date_bkk"),
                         c("hour").alias("hour_bkk")).distinct()
    orig = (before.where(~c(type_col).isin(*skip_types)).select(*keys, c(measure).alias("m"))
            .join(slots, ["account_id", "instance_name", "usage_date_bkk", "hour_bkk"], "left_semi"))
    alloc_rows = after.where(c("note") == note).select(*keys, (-c(measure)).alias("m"))
    return (orig.unionByName(alloc_rows)
            .groupBy("account_id", "instance_name", "usage_date_bkk", "hour_bkk")
            .agg(F.round(F.sum("m"), 4).alias("difference")))


def adhoc_weight_totals(alloc: DataFrame) -> DataFrame:
    """CHK2: companies and weight total per allocation slot (1 within 1e-12 per slot
    with account-scoped weights)."""
    return (alloc.groupBy("account_id", "instance_name", "calendar_date", "weekday", "hour")
            .agg(F.count(F.lit(1)).alias("company_count"), F.sum("weight").alias("total_weight"),
                 F.array_join(F.array_sort(F.collect_set("user_company")), ",").alias("user_companies")))


def weight_total(weights: DataFrame, col: str = "weight") -> DataFrame:
    """CHK3 / CHK6 helper: the sum of a weight column (per group when given one)."""
    return weights.agg(F.sum(col).alias("total_weight"))


def kube_weight_totals(weights: DataFrame) -> DataFrame:
    """CHK6: portion total per cluster (not normalised by the jobs, Q15)."""
    return weights.groupBy("kube_product").agg(F.sum("weight").alias("total_weight"))


def infra_totals_daily(before: DataFrame, after: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """CHK4 (daily): Hosting infrastructure cost before the split vs what the split wrote."""
    target = ((c("bill_billing_entity") == K.AWS_ENTITY) & (c("usage_account_name") == cfg.hosting_account_name)
              & (c("resource_tags_user_company") == cfg.infra_company))
    cols = ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")
    orig = before.where(target).select(F.lit("ORIGINAL").alias("src"), *cols)
    alloc = after.where(c("note").startswith(K.NOTE_INFRA_DAILY_PREFIX)).select(F.lit("ALLOCATED").alias("src"), *cols)
    return orig.unionByName(alloc).groupBy("src").agg(*[F.round(F.sum(x), 4).alias(x) for x in cols])


def weighted_actual_totals(final: DataFrame) -> DataFrame:
    """CHK5: per account and invoice, actual vs weighted actual cost and the share total."""
    return (final.groupBy("account_id", "account_name", "invoice_id")
            .agg(F.sum("actual_cost").alias("actual_cost"), F.sum("weighted_actual_cost").alias("weighted_actual_cost"),
                 F.sum("retail_cost").alias("retail_cost"),
                 (F.sum("retail_cost") - F.sum("actual_cost")).alias("savings"),
                 F.round(F.sum("actual_cost") - F.sum("weighted_actual_cost"), 6).alias("actual_diff"),
                 F.sum("retail_cost_percent").alias("total_weight")))


def spot_savings(trx: DataFrame) -> DataFrame:
    """CHK7 (daily stage after spot pricing): spot usage per usage type and size with
    unit rates and the saving against on-demand."""
    ub, od, q = (F.sum("line_item_unblended_cost"), F.sum("pricing_public_on_demand_cost"),
                 F.sum("line_item_usage_amount"))
    as_d = lambda x: x.cast("double")
    return (trx.where((c("line_item_line_item_type") == K.USAGE) & c("line_item_usage_type").like("%SpotUsage%"))
            .groupBy("line_item_usage_type", "product_instance_type", "pricing_public_on_demand_rate")
            .agg(q.alias("quantity"), ub.alias("unblended_cost"), od.alias("ondemand_cost"),
                 (as_d(ub) / as_d(q)).alias("unblended_rate_calc"), (as_d(od) / as_d(q)).alias("ondemand_rate_calc"),
                 F.when(od != 0, (as_d(od) - as_d(ub)) / as_d(od)).alias("savings_percent"),
                 F.count(F.lit(1)).alias("trx_cnt")))


def zero_retail_rows(final: DataFrame) -> DataFrame:
    """CHK8 (detail): rows still at zero retail cost, cost and count per account."""
    return (final.where(c("retail_cost") == 0).groupBy("account_id")
            .agg(F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n")))


def amortized_fee_per_day(trx: DataFrame) -> DataFrame:
    """CHK9 (daily): amortised RI fee per day."""
    return (trx.where(c("note") == K.NOTE_AMORTIZED_RI)
            .groupBy(F.to_date("line_item_usage_start_date").alias("usage_date"))
            .agg(F.sum("line_item_unblended_cost").alias("amort_unblended_cost")))


def rows_per_month(target: DataFrame) -> DataFrame:
    """CHK10: rows per month and source in a written summary target."""
    return target.groupBy("invoice_month", "trx_source").agg(F.count(F.lit(1)).alias("n"))
