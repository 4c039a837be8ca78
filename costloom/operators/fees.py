"""Row-local fee rules: billing state, future recurring-fee cut, zero-cost drop, on-demand backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, is_blank, keep_unless, not_in, ntz


def stage_scalars(df: DataFrame, ts_col: str, type_col: str, invoice_col: str) -> DataFrame:
    """One row: the row count, the billing state (STA1) and the last transaction time, recurring
    savings-plan fees left out (AGG12)."""
    blank = F.max(F.when(is_blank(c(invoice_col)), 1).otherwise(0)) == 1
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.max(F.when(c(type_col) != K.SP_RECURRING_FEE, c(ts_col))).alias("last_trx"),
                  F.when(blank, F.lit("ESTIMATED")).otherwise(F.lit("ACTUAL")).alias("trx_source"))


def billing_state(df: DataFrame, invoice_col: str = "bill_invoice_id") -> DataFrame:
    """STA1 as a one-row frame: ``ESTIMATED`` if any row lacks an invoice, else ``ACTUAL``."""
    return df.agg(F.when(F.max(F.when(is_blank(c(invoice_col)), 1).otherwise(0)) == 1, F.lit("ESTIMATED"))
                  .otherwise(F.lit("ACTUAL")).alias("trx_source"))


def drop_future_recurring_fees(df: DataFrame, last_trx: Column | dt.datetime | None,
                               ts_col: str, type_col: str) -> DataFrame:
    """CUT1: delete recurring savings-plan fees after the last real transaction.
    A NULL last time deletes nothing (DELETE keeps NULL predicates)."""
    return df.where(keep_unless((c(type_col) == K.SP_RECURRING_FEE) & (c(ts_col) > ntz(last_trx))))


def drop_zero_cost_rows(df: DataFrame, a: str = "line_item_unblended_cost",
                        b: str = "pricing_public_on_demand_cost") -> DataFrame:
    """ZER1 (daily): delete rows whose two costs are both zero; NULL costs stay."""
    return df.where(keep_unless((c(a) == 0) & (c(b) == 0)))


def drop_rounded_zero(df: DataFrame, col: str = "retail_cost", places: int = 8) -> DataFrame:
    """FLT9 (detail): ``DELETE WHERE ROUND(x, n) = 0``."""
    return df.where(keep_unless(F.round(c(col), places) == 0))


def backfill_zero_ondemand(df: DataFrame) -> DataFrame:
    """BKF1: remaining zero on-demand cost takes the unblended cost (fee types excluded)."""
    t = c("line_item_line_item_type")
    od = c("pricing_public_on_demand_cost")
    return df.withColumn("pricing_public_on_demand_cost",
                         F.when(not_in(t, K.FEE_TYPES) & (od == 0), c("line_item_unblended_cost")).otherwise(od))
