"""Calendar helpers (CAL1, CAL2): generated with ``range`` / ``sequence``, no number tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.functions.columns import month_of, weekday_code


def day_index(spark: SparkSession) -> DataFrame:
    """CAL1: the numbers 0..31 as ``day``."""
    return spark.range(32).select(F.col("id").cast("int").alias("day"))


def month_calendar(spark: SparkSession, month) -> DataFrame:
    """CAL2: every date of the month (a number, or a scalar of the plan) with its SUN..SAT code."""
    m = month_of(month)
    first = F.make_date(F.floor(m / 100).cast("int"), m % 100, F.lit(1))
    dates = F.sequence(first, F.last_day(first), F.expr("INTERVAL 1 DAY"))
    return (spark.range(1).select(F.explode(dates).alias("calendar_date"))
            .withColumn("day_of_week", weekday_code(F.col("calendar_date"))))
