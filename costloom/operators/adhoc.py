"""Off-hours (ad hoc) billing: schedule expansion, 1/n weights (ADH1), reallocation (ADH2),
and the per-account company list (ADH3)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, month_of, scaled, shifted
from costloom.operators.lookup import lookup_join
from costloom.settings import DEFAULTS, Settings


def adhoc_schedule(billing: DataFrame, instances: DataFrame, schedule: DataFrame,
                   calendar: DataFrame, month: Column | int) -> DataFrame:
    """Billing rows of the month expanded to (instance, date, hour): equi joins on group and
    schedule ids, then the month calendar by weekday with an inclusive date range."""
    b = billing.where(c("invoice_month") == month_of(month))
    return (b.join(instances, "instance_group_id")
             .join(schedule, "schedule_id")
             .join(calendar, (c("day_of_week") == c("weekday"))
                   & c("calendar_date").between(c("start_date"), c("end_date")))
             .select("adhoc_billing_id", "invoice_month", "account_id", "user_company", "instance_name",
                     "calendar_date", "weekday", "hour"))


def adhoc_weights(adhoc: DataFrame, scope: str = "instance") -> DataFrame:
    """ADH1: weight = 1/n, n = companies scheduled on (account, instance, date, hour).

    ``scope='instance'`` reproduces the reference, whose join compares the account with
    itself, so weights of other accounts on the same instance name also match (Q1);
    ``scope='account'`` also matches the account."""
    n = (adhoc.groupBy("account_id", "instance_name", "calendar_date", "hour")
         .agg(F.count(F.lit(1)).alias("n"))
         .select(c("account_id").alias("w_account_id"), c("instance_name").alias("w_instance_name"),
                 c("calendar_date").alias("w_calendar_date"), c("hour").alias("w_hour"), "n"))
    cond = ((c("instance_name") == c("w_instance_name")) & (c("calendar_date") == c("w_calendar_date"))
            & (c("hour") == c("w_hour")))
    if scope == "instance":
        cond = cond & c("account_id").isNotNull()
    elif scope == "account":
        cond = cond & (c("account_id") == c("w_account_id"))
    else:
        raise ValueError(f"scope must be 'instance' or 'account', not {scope!r}")
    return (adhoc.join(n, cond, "inner")
            .select("account_id", "instance_name", "calendar_date", "weekday", "hour", "user_company",
                    (F.lit(Decimal("1.00")) / c("n")).cast(K.WEIGHT).alias("weight")))


def reallocate_adhoc(usage: DataFrame, alloc: DataFrame, *, account_col: str, name_col: str, ts_col: str,
                     type_col: str, company_col: str, measures: dict, skip_types, note: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """ADH2: rows whose UTC+7 (date, hour) falls in an allocation slot of their account and
    instance are replaced by one row per allocated company, measures times weight.

    One left join replaces the reference's flag / insert / delete triple. Fee-like types
    (and NULL types) never match and pass through unchanged. ``measures`` maps each
    measure column to the type it is stored in."""
    a = alloc.select(c("account_id").alias("_a_account"), c("instance_name").alias("_a_instance"),
                     c("calendar_date").alias("_a_date"), c("hour").alias("_a_hour"),
                     c("user_company").alias("_a_company"), c("weight").alias("_a_weight"),
                     F.lit(True).alias("_a_hit"))
    local = shifted(c(ts_col), cfg.off_hours_offset_hours)
    u = usage.withColumns({"_bkk_date": F.to_date(local), "_bkk_hour": F.hour(local)})
    keys = [(account_col, "_a_account"), (name_col, "_a_instance"), ("_bkk_date", "_a_date"), ("_bkk_hour", "_a_hour")]
    j = lookup_join(u, a, keys, residual=~c(type_col).isin(*skip_types))
    hit = F.coalesce(c("_a_hit"), F.lit(False))
    j = j.withColumns({
        company_col: F.when(hit, c("_a_company")).otherwise(c(company_col)),
        **{m: F.when(hit, scaled(c(m), c("_a_weight"), dtype)).otherwise(c(m)) for m, dtype in measures.items()},
        "note": F.when(hit, F.lit(note)).otherwise(c("note"))})
    return j.drop("_a_account", "_a_instance", "_a_date", "_a_hour", "_a_company", "_a_weight", "_a_hit",
                  "_bkk_date", "_bkk_hour")


def adhoc_companies(billing: DataFrame, month: Column | int) -> DataFrame:
    """ADH3: companies with an ad hoc allocation per account, distinct, sorted, comma-joined."""
    return (billing.where(c("invoice_month") == month_of(month))
            .groupBy("account_id")
            .agg(F.array_join(F.array_sort(F.collect_set("user_company")), ",").alias("user_company")))
