"""STT1 / SRC7: month statistics, read back from a target or gathered while a month is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.functions.columns import is_blank
from costloom.plans.sink import current, read_target


def stats_columns(invoice_col: str | None) -> list[Column]:
    """is_invoiced (1 if every row has an invoice), newest created time, row count;
    NULL, NULL, 0 without rows. A target without an invoice column has no is_invoiced."""
    invoiced = [F.min(F.when(~is_blank(F.col(invoice_col)), 1).otherwise(0)).alias("is_invoiced")] if invoice_col else []
    return [*invoiced, F.max("t_created_date").alias("created_date"), F.count(F.lit(1)).alias("row_count")]


def month_stats_frame(target_df: DataFrame, month: int, invoice_col: str = "bill_invoice_id") -> DataFrame:
    return target_df.where(F.col("invoice_month") == F.lit(int(month))).agg(*stats_columns(invoice_col))


def month_stats(spark: SparkSession, target: str, month: int, invoice_col: str = "bill_invoice_id") -> dict:
    """Stats of one month; a month that was never written has none, an unreadable one raises."""
    if current(spark, target, month) is None:
        return {"is_invoiced": None, "created_date": None, "row_count": 0}
    return month_stats_frame(read_target(spark, target, [month]), month, invoice_col).first().asDict()
