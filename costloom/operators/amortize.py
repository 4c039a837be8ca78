"""RI-fee amortisation over the rest of the month (AMO1), as a generator, not a theta join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, first_of_next_month, ntz


def _day_slices(is_fee, days):
    """Slice index per output row: 0..days-1 for fee rows, -1 (row untouched) otherwise.
    A fee row whose day count is NULL yields no slice, so it disappears."""
    return F.explode(F.when(is_fee, F.sequence(F.lit(0), days - 1)).otherwise(F.array(F.lit(-1))))


def amortize_rifee_daily(df: DataFrame, last_trx: Column | dt.datetime | None) -> DataFrame:
    """Daily AMO1: each RIFee row becomes one row per remaining day of its month (hour kept),
    unblended cost and usage divided by the day count, on-demand cost copied whole (Q2);
    slices after the last transaction date are dropped, and the original row goes."""
    t, ts = c("line_item_line_item_type"), c("line_item_usage_start_date")
    is_fee = t == K.RIFEE
    days = F.datediff(first_of_next_month(F.to_date(ts)), F.to_date(ts))
    last_date = F.to_date(ntz(last_trx))
    x = df.withColumn("_days", days).select("*", _day_slices(F.coalesce(is_fee, F.lit(False)), c("_days")).alias("_slice"))
    sliced = c("_slice") >= 0
    new_ts = F.timestamp_add("DAY", c("_slice"), ts)
    x = x.withColumns({
        "line_item_usage_start_date": F.when(sliced, new_ts).otherwise(ts),
        "line_item_unblended_cost": F.when(sliced, (c("line_item_unblended_cost") / c("_days")).cast(K.MONEY))
                                     .otherwise(c("line_item_unblended_cost")),
        "line_item_usage_amount": F.when(sliced, (c("line_item_usage_amount") / c("_days")).cast(K.MONEY))
                                   .otherwise(c("line_item_usage_amount")),
        "note": F.when(sliced, F.lit(K.NOTE_AMORTIZED_RI)).otherwise(c("note"))})
    return x.where(~sliced | (F.to_date("line_item_usage_start_date") <= last_date)).drop("_days", "_slice")


def amortize_rifee_estimated(df: DataFrame, last_trx: Column | dt.datetime | None) -> DataFrame:
    """Summary (ESTIMATED) AMO1: day slices at midnight of each remaining day, note ``AMORTIZED``."""
    t, d = c("lineitem_type"), c("usage_date")
    is_fee = F.coalesce(t == K.RIFEE, F.lit(False))
    days = F.datediff(first_of_next_month(d), d)
    last_date = F.to_date(ntz(last_trx))
    x = df.withColumn("_days", days).select("*", _day_slices(is_fee, c("_days")).alias("_slice"))
    sliced = c("_slice") >= 0
    new_d = F.date_add(d, c("_slice"))
    x = x.withColumns({
        "usage_date_hour": F.when(sliced, new_d.cast("timestamp_ntz")).otherwise(c("usage_date_hour")),
        "usage_date": F.when(sliced, new_d).otherwise(d),
        "unblended_cost": F.when(sliced, (c("unblended_cost") / c("_days")).cast(K.MONEY)).otherwise(c("unblended_cost")),
        "quantity": F.when(sliced, (c("quantity") / c("_days")).cast(K.MONEY)).otherwise(c("quantity")),
        "note": F.when(sliced, F.lit(K.NOTE_AMORTIZED_SUMMARY)).otherwise(c("note"))})
    return x.where(~sliced | (c("usage_date") <= last_date)).drop("_days", "_slice")
