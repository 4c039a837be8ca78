"""Roll-ups to output grain (DLY1, DET1, SUM1/AGG4, AGG7), retail weighting (WGT1) and
upfront fees (UPF1, UPF2). Every aggregate is a partial + final hash aggregate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, from_units, month_of, ntz, rate_text_to_decimal, times_over, units
from costloom.operators.normalize import DAILY_KEYS, DAILY_MEASURES, accounts_lookup, unkept
from costloom.settings import DEFAULTS, Settings

DAILY_OUTPUT = (
    "invoice_month", "bill_billing_entity", "line_item_usage_account_id", "usage_account_name", "bill_invoice_id",
    "line_item_usage_date", "line_item_line_item_type", "line_item_usage_type", "line_item_line_item_description",
    "line_item_resource_id", "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n",
    "product_product_name", "product_instance_type", "product_instance_type_family", "resource_tags_user_company",
    "resource_tags_user_product", "resource_tags_user_company_original", "resource_tags_user_product_original",
    "resource_tags_user_stage", "resource_tags_user_name", "line_item_unblended_rate",
    "pricing_public_on_demand_rate", "pricing_unit", "line_item_unblended_cost", "pricing_public_on_demand_cost",
    "line_item_usage_amount", "note",
)
DETAIL_OUTPUT = ("invoice_month", "account_id", "account_name", "user_company", "product_name", "lineitem_type",
                 "usage_type", "pricing_unit", "retail_cost", "quantity", "note")
SUMMARY_KEYS = ("invoice_month", "invoice_id", "trx_source", "account_id", "account_name", "user_company",
                "user_product")


# ---------------------------------------------------------------------------- daily

def daily_rollup(trx: DataFrame) -> DataFrame:
    """DLY1: hour grain to day grain, the note kept as a key."""
    keys = [F.to_date("line_item_usage_start_date").alias("line_item_usage_date") if k == "line_item_usage_start_date"
            else c(k) for k in DAILY_KEYS]
    return trx.groupBy(*keys, "note").agg(*[F.sum(m).cast(K.MONEY).alias(m) for m in DAILY_MEASURES])


def upfront_fee_rows(schedule: DataFrame, accounts: DataFrame, month: Column | int, last_trx: Column | dt.datetime | None, cfg: Settings = DEFAULTS) -> DataFrame:
    """UPF1: the month's amortised upfront RI / savings-plan fees up to the last transaction
    date, as daily rows at company REGIONAL; columns the reference leaves out are NULL."""
    last_date = F.to_date(ntz(last_trx))
    sp = c("product_name").like(K.SAVINGS_PLAN_PRODUCT_PATTERN)
    s = (schedule.where((c("invoice_month") == month_of(month)) & (c("usage_date") <= last_date))
         .join(accounts_lookup(accounts), c("usage_account_id") == c("ac_account_id"), "inner"))
    return s.select(
        "invoice_month", F.lit(K.AWS_ENTITY).alias("bill_billing_entity"),
        c("usage_account_id").alias("line_item_usage_account_id"),
        c("ac_account_display_name").alias("usage_account_name"),
        c("invoice_id").alias("bill_invoice_id"), c("usage_date").alias("line_item_usage_date"),
        F.when(sp, F.lit(K.UPFRONT_SP_TYPE)).otherwise(F.lit(K.UPFRONT_RI_TYPE)).alias("line_item_line_item_type"),
        c("reservation_arn").alias("reservation_reservation_a_r_n"), c("product_name").alias("product_product_name"),
        F.lit("").alias("pricing_unit"), F.lit(cfg.regional_company).alias("resource_tags_user_company"),
        F.lit("").alias("resource_tags_user_product"), F.lit(cfg.regional_company).alias("resource_tags_user_company_original"),
        F.lit("").alias("resource_tags_user_product_original"),
        c("amount").cast(K.MONEY).alias("line_item_unblended_cost"),
        F.lit(0).cast(K.MONEY).alias("pricing_public_on_demand_cost"),
        c("quantity").cast(K.MONEY).alias("line_item_usage_amount"),
        F.when(sp, F.lit(K.NOTE_UPFRONT_SP)).otherwise(F.lit(K.NOTE_UPFRONT_RI)).alias("note"),
    )


def daily_output(agg: DataFrame) -> DataFrame:
    """The daily target's 28 data columns with the reference's output casts."""
    cols = []
    for x in DAILY_OUTPUT:
        if x in ("line_item_unblended_rate", "pricing_public_on_demand_rate"):
            cols.append(rate_text_to_decimal(c(x)).alias(x))
        elif x in DAILY_MEASURES:
            cols.append(c(x).cast(K.DEC38_15).alias(x))
        else:
            cols.append(c(x))
    return agg.select(*cols)


# ---------------------------------------------------------------------------- detail

def detail_rollup(trx: DataFrame, accounts: DataFrame) -> DataFrame:
    """DET1 (AGG3): month x account x company x product x folded type x usage type x unit x note."""
    j = trx.join(accounts_lookup(accounts), c("account_id") == c("ac_account_id"), "inner")
    folded = F.when(c("lineitem_type").like("%Usage"), F.lit(K.USAGE)).otherwise(c("lineitem_type"))
    return (j.groupBy("invoice_month", "account_id", c("ac_account_display_name").alias("account_name"),
                      "user_company", "product_name", folded.alias("lineitem_type"), "usage_type", "pricing_unit",
                      "note")
            .agg(F.sum("retail_cost").cast(K.DEC38_8).alias("retail_cost"),
                 F.sum("quantity").cast(K.MONEY).alias("quantity")))


def detail_output(final: DataFrame) -> DataFrame:
    """Rounded retail (4) and quantity (8); rows whose rounded retail is zero are not written."""
    r4 = F.round(c("retail_cost"), 4)
    return final.where(r4 != 0).select(
        "invoice_month", "account_id", "account_name", "user_company", "product_name", "lineitem_type",
        "usage_type", "pricing_unit", r4.alias("retail_cost"), F.round(c("quantity"), 8).alias("quantity"),
        F.coalesce(c("note"), F.lit("")).alias("note"))


# ---------------------------------------------------------------------------- summary

def summary_rollup(trx: DataFrame) -> DataFrame:
    """SUM1 / AGG4: drop all-zero rows (plain filter), then actual and retail cost per
    (month, invoice, source, account, company, product, type)."""
    t, ub, od = c("lineitem_type"), c("unblended_cost"), c("ondemand_cost")
    ri, nf = c("ri_normalizationfactor"), c("normalizationfactor")
    retail = (F.when(t == K.RIFEE, od).when(t == K.SP_RECURRING_FEE, od).when(t == K.CREDIT, ub)
              .when(od == 0, ub)
              .when((t == K.DISCOUNTED_USAGE) & (ri != 0), (nf / ri).cast("decimal(24,16)") * od)
              .otherwise(od))
    actual = F.when(t == K.SP_COVERED_USAGE, F.lit(0)).otherwise(ub)
    return (trx.where(~((ub == 0) & (od == 0)))
            .groupBy("invoice_month", F.coalesce(c("invoice_id"), F.lit("")).alias("invoice_id"), "trx_source",
                     "account_id", "user_company", "user_product", "lineitem_type")
            .agg(F.sum(actual).cast(K.DEC38_8).alias("actual_cost"), F.sum(retail).cast(K.DEC38_8).alias("retail_cost"))
            .withColumn("note", F.lit("")))


def weight_actual_cost(agg: DataFrame, accounts: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = unkept) -> DataFrame:
    """WGT1: within (invoice, account), retail share of each company/product and the
    actual cost spread by it. Account totals are a small aggregate joined back (JOI15),
    which stays balanced when one account holds most rows. ``keep`` stages the costs (output
    grain), which both sides read, so the flow behind them runs once."""
    cs = keep(agg.join(accounts_lookup(accounts), c("account_id") == c("ac_account_id"), "inner")
          .groupBy("invoice_month", F.coalesce(c("invoice_id"), F.lit("")).alias("invoice_id"), "trx_source",
                   "account_id", c("ac_account_display_name").alias("account_name"), "user_company", "user_product")
          .agg(F.sum("actual_cost").cast(K.DEC38_8).alias("actual_cost"),
               F.sum("retail_cost").cast(K.DEC38_8).alias("retail_cost")), "costs")
    totals = (cs.groupBy(c("invoice_id").alias("t_invoice_id"), c("account_id").alias("t_account_id"))
              .agg(F.sum("retail_cost").alias("total_retail_cost"), F.sum("actual_cost").alias("total_actual_cost")))
    j = cs.join(totals, (c("invoice_id") == c("t_invoice_id")) & (c("account_id") == c("t_account_id")), "inner")
    part, retail, actual = (units(c(x), 8) for x in ("retail_cost", "total_retail_cost", "total_actual_cost"))
    return j.select(
        *SUMMARY_KEYS, "actual_cost",
        # multiplied before it is divided, in whole numbers: exact up to the one rounding at 8 places
        from_units(times_over(part, actual, retail), 8, K.DEC38_8).alias("weighted_actual_cost"),
        "retail_cost",
        from_units(times_over(part, F.lit(Decimal(10 ** 10)), retail), 10, K.PERCENT).alias("retail_cost_percent"),
        F.lit("").alias("note"))


def upfront_fee_column(final: DataFrame, schedule: DataFrame, month: Column | int, last_trx: Column | dt.datetime | None, cfg: Settings = DEFAULTS) -> DataFrame:
    """UPF2: the month's amortised upfront RI fee per account (to the last transaction date)
    spread by retail percent; joined by account only (Q20); marketplace rows get none (Q21)."""
    last_date = F.to_date(ntz(last_trx))
    fee = (schedule.where((c("invoice_month") == month_of(month)) & (c("usage_date") <= last_date))
           .groupBy(c("account_id").alias("u_account_id"))
           .agg(F.sum("rifee").alias("u_fee"))
           .withColumn("u_hit", F.lit(True)))
    j = final.join(fee, (c("account_id") == c("u_account_id")) & (c("user_product") != cfg.marketplace_product), "left")
    val = F.when(F.coalesce(c("u_hit"), F.lit(False)),
                 F.round(c("retail_cost_percent") * c("u_fee"), 8).cast(K.DEC38_8)).otherwise(F.lit(0).cast(K.DEC38_8))
    return j.withColumn("weighted_upfront_rifee_actual_cost", val).drop("u_account_id", "u_fee", "u_hit")


def summary_output(final: DataFrame, last_trx: Column | dt.datetime | None) -> DataFrame:
    """AGG7: final grain with rounded sums and the run's last transaction time."""
    return (final.groupBy(*SUMMARY_KEYS)
            .agg(F.round(F.sum("actual_cost"), 4).alias("actual_cost"),
                 F.round(F.sum("weighted_actual_cost"), 4).alias("weighted_actual_cost"),
                 F.round(F.sum("weighted_upfront_rifee_actual_cost"), 4).alias("weighted_upfront_rifee_actual_cost"),
                 F.round(F.sum("retail_cost"), 4).alias("retail_cost"),
                 F.round(F.sum("retail_cost_percent"), 10).alias("retail_cost_percent"))
            .withColumn("t_last_trx_date", ntz(last_trx)))
