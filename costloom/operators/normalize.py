"""Scan, tag and cost normalisation of the bill and of usage transactions (NRM1-3, SRC1-2, MON2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K, session
from costloom.operators import interval as IVL
from costloom.operators.lookup import lookup_join
from costloom.functions.columns import (c, company_precedence, company_with_default, is_support,
                                        month_bounds, not_in, ntz, product_precedence, second_part)
from costloom.settings import DEFAULTS, Settings

# Grouping keys of the hourly bill stage, in the reference's order.
DAILY_KEYS = (
    "invoice_month", "bill_billing_entity", "line_item_usage_account_id", "usage_account_name",
    "bill_invoice_id", "line_item_usage_start_date", "line_item_line_item_type", "line_item_usage_type",
    "line_item_unblended_rate", "line_item_line_item_description", "line_item_resource_id",
    "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n", "product_product_name",
    "product_instance_type", "product_instance_type_family", "pricing_public_on_demand_rate", "pricing_unit",
    "resource_tags_user_company", "resource_tags_user_product", "resource_tags_user_company_original",
    "resource_tags_user_product_original", "resource_tags_user_stage", "resource_tags_user_name",
)
DAILY_MEASURES = ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")


def accounts_lookup(accounts: DataFrame, prefix: str = "ac_") -> DataFrame:
    return accounts.select(*[c(x).alias(prefix + x) for x in
                             ("account_id", "account_display_name", "default_cost_center")])


def bill_for_month(cur: DataFrame, month: int) -> DataFrame:
    """SRC1: one invoice month of the bill; a literal on the partition column prunes files."""
    return cur.where(c("invoice_month") == F.lit(int(month)))


def bill_rows(cur: DataFrame, accounts: DataFrame, month: int, cfg: Settings = DEFAULTS) -> DataFrame:
    """The month's bill rows that survive the type filters and the account join."""
    t = c("line_item_line_item_type")
    keep = (not_in(t, K.DAILY_EXCLUDED_TYPES)
            & ~((t == K.FEE) & (c("bill_bill_type") == K.PURCHASE_BILL_TYPE))
            & ~((t == K.CREDIT) & (c("line_item_line_item_description") == cfg.defensive_credit)))
    bill = bill_for_month(cur, month).where(keep)
    return bill.join(accounts_lookup(accounts), c("line_item_usage_account_id") == c("ac_account_id"), "inner")


def normalize_bill(cur: DataFrame, accounts: DataFrame, month: int, cfg: Settings = DEFAULTS) -> DataFrame:
    """NRM1 + AGG1: filter, tag with account defaults, fix costs, roll up at hour grain."""
    t = c("line_item_line_item_type")
    j = bill_rows(cur, accounts, month, cfg)
    unblended = F.when(t == K.SP_COVERED_USAGE, F.lit(0).cast(K.MONEY)).otherwise(c("line_item_unblended_cost"))
    ondemand = (F.when(is_support(c("product_product_name")), c("line_item_unblended_cost"))
                .when(t.isin(K.RIFEE, K.SP_RECURRING_FEE), c("pricing_public_on_demand_cost"))
                .when(t == K.CREDIT, c("line_item_unblended_cost"))
                .otherwise(c("pricing_public_on_demand_cost")))
    shaped = j.select(
        "invoice_month", "bill_billing_entity", "line_item_usage_account_id",
        c("ac_account_display_name").alias("usage_account_name"),
        "bill_invoice_id", "line_item_usage_start_date", "line_item_line_item_type", "line_item_usage_type",
        "line_item_unblended_rate", "line_item_line_item_description", "line_item_resource_id",
        "reservation_reservation_a_r_n", "savings_plan_savings_plan_a_r_n", "product_product_name",
        "product_instance_type", "product_instance_type_family", "pricing_public_on_demand_rate", "pricing_unit",
        company_with_default(c("resource_tags_user_company"), c("ac_default_cost_center")).alias("resource_tags_user_company"),
        F.upper("resource_tags_user_product").alias("resource_tags_user_product"),
        F.upper("resource_tags_user_company").alias("resource_tags_user_company_original"),
        F.upper("resource_tags_user_product").alias("resource_tags_user_product_original"),
        F.upper("resource_tags_user_stage").alias("resource_tags_user_stage"),
        "resource_tags_user_name",
        unblended.cast(K.MONEY).alias("line_item_unblended_cost"),
        ondemand.cast(K.MONEY).alias("pricing_public_on_demand_cost"),
        c("line_item_usage_amount").cast(K.MONEY).alias("line_item_usage_amount"),
    )
    return (shaped.groupBy(*DAILY_KEYS)
            .agg(*[F.sum(m).cast(K.MONEY).alias(m) for m in DAILY_MEASURES])
            .withColumn("note", F.lit("")))


# --------------------------------------------------------------------------------------
# usage transactions (detail / summary)
# --------------------------------------------------------------------------------------

def transactions_for_month(trx: DataFrame, month: int) -> DataFrame:
    """SRC2: the month as a timestamp range, so the predicate reaches the Parquet scan."""
    first, nxt = month_bounds(month)
    lo = dt.datetime.combine(first, dt.time())
    hi = dt.datetime.combine(nxt, dt.time())
    ts = c("usage_start_date")
    return trx.where((ts >= ntz(lo)) & (ts < ntz(hi)))


def latest_month(trx: DataFrame) -> DataFrame:
    """MON2 / SRC6: ``TO_CHAR(MAX(usage_start_date), 'yyyyMM')::int`` as a one-row frame."""
    return trx.agg(F.date_format(F.max("usage_start_date"), "yyyyMM").cast("int").alias("invoice_month"))


def transaction_rows(trx: DataFrame, accounts: DataFrame, month: int | None) -> DataFrame:
    """Transactions of the month (or all, for the estimated table) that survive the type
    filter and the account join. The later left joins never drop rows, so scalars over
    these rows equal the reference's scalars over its transaction stage."""
    base = transactions_for_month(trx, month) if month is not None else trx
    base = base.where(not_in(c("lineitem_type"), K.MONTHLY_EXCLUDED_TYPES))
    return base.join(accounts_lookup(accounts), c("linked_account_id") == c("ac_account_id"), "inner")


#: Columns that tell transactions apart; all are read anyway.
TRX_IDENTITY = ("usage_start_date", "linked_account_id", "usage_type", "usage_quantity", "unblended_cost")


def month_span(month: int) -> tuple[Column, Column]:
    """First and last moment of a month."""
    first, nxt = month_bounds(month)
    last = dt.datetime.combine(nxt, dt.time()) - dt.timedelta(microseconds=1)
    return ntz(dt.datetime.combine(first, dt.time())), ntz(last)


def unkept(df: DataFrame, name: str) -> DataFrame:
    return df


def _lookups(trx: DataFrame, accounts: DataFrame, rifee: DataFrame, ruser: DataFrame, rtag: DataFrame,
             rifee_on_invoice: bool, span: tuple[Column, Column], keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``span``: time of the data, which owners must meet. ``keep`` stages the grid of resources with
    many owners, whose file size then decides how it joins. Names are put in upper case once a lookup row."""
    ac = accounts_lookup(accounts).withColumn("ac_default_cost_center", F.upper("ac_default_cost_center"))
    ri = rifee.select(c("ri_reservationarn").alias("ri_arn"), c("invoice_id").alias("ri_invoice_id"),
                      c("ri_normalizationfactor").alias("ri_nf"))
    ru = ruser.select(c("resource_id").alias("ru_resource_id"), c("resource_start_dt").alias("ru_start"),
                      c("resource_end_dt").alias("ru_end"), c("user_name").alias("ru_user_name"),
                      F.upper("user_company").alias("ru_user_company"), F.upper(F.trim("user_product")).alias("ru_user_product"))
    rt = rtag.select(c("resource_id").alias("rt_resource_id"), c("user_company").alias("rt_user_company"),
                     c("user_product").alias("rt_user_product"))
    ri_keys = [("reservationarn", "ri_arn")] + ([("invoice_id", "ri_invoice_id")] if rifee_on_invoice else [])
    ts = c("usage_start_date")
    j = trx.join(ac, c("linked_account_id") == c("ac_account_id"), "inner")
    # JOI4: equi keys + inclusive range residual; a NULL end never matches
    ru = IVL.within_span(ru, "ru_start", "ru_end", *span)
    small = [session.under_broadcast_threshold(x) for x in (ru, rt)]
    grid = keep(IVL.dense_grid(ru, "ru_resource_id", "ru_start", "ru_end", *span), "grid")
    j = IVL.bucket_events(j, grid, "resource_id", "usage_start_date", "_bucket", TRX_IDENTITY)
    ru = IVL.bucket_intervals(ru, grid, "ru_resource_id", "ru_start", "ru_end", "ru_bucket")
    rt = IVL.bucket_all(rt, grid, "rt_resource_id", "rt_bucket")
    j = lookup_join(j, ru, [("resource_id", "ru_resource_id"), ("_bucket", "ru_bucket")], spread_by=TRX_IDENTITY, small=small[0],
                    residual=(ts >= c("ru_start")) & (ts <= c("ru_end")))
    j = lookup_join(j, rt, [("resource_id", "rt_resource_id"), ("_bucket", "rt_bucket")], spread_by=TRX_IDENTITY, small=small[1])
    return lookup_join(j, ri, ri_keys, spread_by=TRX_IDENTITY)


def normalize_detail(trx: DataFrame, accounts: DataFrame, rifee: DataFrame, ruser: DataFrame,
                     rtag: DataFrame, month: int, keep: Callable[[DataFrame, str], DataFrame] = unkept) -> DataFrame:
    """NRM2: transaction rows of one month with tags and the detail retail-cost rule (PRJ7)."""
    t = c("lineitem_type")
    base = transactions_for_month(trx, month).where(not_in(t, K.MONTHLY_EXCLUDED_TYPES))
    j = _lookups(base, accounts, rifee, ruser, rtag, rifee_on_invoice=True, span=month_span(month), keep=keep)
    od, ub = c("public_ondemand_cost"), c("unblended_cost")
    nvl0 = lambda x: F.coalesce(x, F.lit(0))
    discounted = F.lower(t) == "discountedusage"
    retail = (F.when(is_support(c("product_name")), ub)
              .when(t == K.RIFEE, od)
              .when(t == K.SP_RECURRING_FEE, od)
              .when(t == K.CREDIT, ub)
              .when(nvl0(od) == 0, ub)
              .when(discounted & (nvl0(c("ri_nf")) != 0),
                    (nvl0(c("normalizationfactor")) / nvl0(c("ri_nf"))).cast("decimal(24,16)") * nvl0(od))
              .otherwise(nvl0(od)))
    ts = c("usage_start_date")
    return j.select(
        (F.year(ts) * 100 + F.month(ts)).cast("int").alias("invoice_month"),
        c("linked_account_id").alias("account_id"),
        ts.alias("usage_date_hour"),
        F.to_date(ts).alias("usage_date"),
        company_precedence(c("rt_user_company"), c("ru_user_company"), c("ac_default_cost_center")).alias("user_company"),
        F.coalesce(c("ru_user_name"), F.lit("")).alias("user_name"),
        "product_name",
        F.when(discounted, F.lit(K.USAGE)).otherwise(t).alias("lineitem_type"),
        "usage_type", "pricing_unit",
        F.coalesce(retail, F.lit(0)).cast(K.DEC38_8).alias("retail_cost"),
        F.coalesce(c("usage_quantity"), F.lit(0)).cast(K.MONEY).alias("quantity"),
        F.lit("").alias("note"),
        second_part(c("usage_type"), ":").alias("instance_size"),
    )


def normalize_summary(trx: DataFrame, accounts: DataFrame, rifee: DataFrame, ruser: DataFrame,
                      rtag: DataFrame, source: str, month: int | None, cfg: Settings = DEFAULTS,
                      span: tuple[Column, Column] | None = None, keep: Callable[[DataFrame, str], DataFrame] = unkept) -> DataFrame:
    """NRM3: ACTUAL (one month, RI factor by ARN + invoice) or ESTIMATED (whole table, by ARN;
    ``span`` gives the time that the table covers)."""
    t = c("lineitem_type")
    actual = source == "ACTUAL"
    base = transactions_for_month(trx, month) if actual else trx
    base = base.where(not_in(t, K.MONTHLY_EXCLUDED_TYPES))
    j = _lookups(base, accounts, rifee, ruser, rtag, rifee_on_invoice=actual, span=span or month_span(month), keep=keep)
    ub = c("unblended_cost")
    ts = c("usage_start_date")
    return j.select(
        (F.year(ts) * 100 + F.month(ts)).cast("int").alias("invoice_month"),
        "invoice_id",
        c("linked_account_id").alias("account_id"),
        ts.alias("usage_date_hour"),
        F.to_date(ts).alias("usage_date"),
        c("ru_user_name").alias("user_name"),
        company_precedence(c("rt_user_company"), c("ru_user_company"), c("ac_default_cost_center")).alias("user_company"),
        product_precedence(c("item_description"), c("rt_user_product"), c("ru_user_product"), cfg).alias("user_product"),
        "lineitem_type",
        F.coalesce(ub, F.lit(0)).cast(K.MONEY).alias("unblended_cost"),
        F.coalesce(F.when(is_support(c("product_name")), ub).otherwise(c("public_ondemand_cost")),
                   F.lit(0)).cast(K.MONEY).alias("ondemand_cost"),
        F.coalesce(c("ri_nf"), F.lit(0)).alias("ri_normalizationfactor"),
        F.coalesce(c("normalizationfactor"), F.lit(0)).alias("normalizationfactor"),
        F.coalesce(c("usage_quantity"), F.lit(0)).cast(K.MONEY).alias("quantity"),
        F.lit(source).alias("trx_source"),
        F.lit(None).cast("string").alias("note"),
        "usage_type",
        second_part(c("usage_type"), ":").alias("instance_size"),
    )
