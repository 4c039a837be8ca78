"""JOI4: left join of events to the intervals of their resource, linear in events, intervals and matches.

A resource with few intervals joins on the resource alone. One with more than ``DENSE`` of them gets a
grid: its time range is cut into buckets of equal width, its intervals are copied into the buckets they
touch, and an event only meets those of its own bucket. The width is the larger of

* the width at which ``DENSE`` intervals would begin in a bucket, and
* a seventh of the mean interval length, so intervals have at most 8 copies on average (what bounds a
  broadcast of them at 8 times Spark's threshold);

an event therefore meets at most about ``DENSE`` intervals beyond those around its own time. The exact
comparison stays as the residual of the join. The grid has one row per dense resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.functions.columns import c
from costloom.operators.lookup import lookup_join

DENSE = 32
COPIES = 7


def seconds(ts: Column) -> Column:
    """Wall-clock seconds of a TIMESTAMP_NTZ, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def within_span(intervals: DataFrame, start: str, end: str, first: Column, last: Column) -> DataFrame:
    """Intervals that meet the time of the data; one with a NULL end or one that ends before it begins
    matches nothing."""
    return intervals.where((c(start) <= last) & (c(end) >= first) & (c(start) <= c(end)))


def dense_grid(intervals: DataFrame, key: str, start: str, end: str, first: Column, last: Column) -> DataFrame:
    """(g_key, g_origin, g_width, g_buckets) of resources with more than ``DENSE`` intervals."""
    s, e = F.greatest(seconds(c(start)), seconds(first)), F.least(seconds(c(end)), seconds(last))
    per = (intervals.select(c(key).alias("g_key"), s.alias("_s"), e.alias("_e")).groupBy("g_key")
           .agg(F.count(F.lit(1)).alias("_n"), F.sum(c("_e") - c("_s") + 1).alias("_length"), F.min("_s").alias("g_origin"), F.max("_e").alias("_last"))
           .where(c("_n") > DENSE))
    span = c("_last") - c("g_origin") + 1
    width = F.greatest(F.lit(1).cast("long"), F.ceil(span * DENSE / c("_n")), F.ceil(c("_length") / (COPIES * c("_n")))).cast("long")
    return (per.withColumn("g_width", width)
            .select("g_key", "g_origin", "g_width", F.ceil(span / c("g_width")).cast("long").alias("g_buckets")))


def _bucket(at: Column) -> Column:
    return F.floor((at - c("g_origin")) / c("g_width")).cast("long")


def bucket_events(events: DataFrame, grid: DataFrame, key: str, ts: str, into: str, spread_by: tuple[str, ...] = ()) -> DataFrame:
    """``events`` with their bucket: 0 for resources without a grid, -1 outside a grid."""
    at = _bucket(seconds(c(ts)))
    found = F.when(c("g_key").isNull(), 0).when(at.between(0, c("g_buckets") - 1), at).otherwise(-1).cast("long")
    return lookup_join(events, grid, [(key, "g_key")], spread_by=spread_by).withColumn(into, found).drop(*grid.columns)


def bucket_intervals(intervals: DataFrame, grid: DataFrame, key: str, start: str, end: str, into: str) -> DataFrame:
    """``intervals`` copied into the buckets that they touch."""
    low = F.greatest(_bucket(seconds(c(start))), F.lit(0))
    high = F.least(_bucket(seconds(c(end))), c("g_buckets") - 1)
    places = F.when(c("g_key").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(low, high))
    return lookup_join(intervals, grid, [(key, "g_key")]).withColumn(into, F.explode(places)).drop(*grid.columns)


def bucket_all(rows: DataFrame, grid: DataFrame, key: str, into: str) -> DataFrame:
    """``rows`` copied into every bucket of their resource, so a join that has nothing to do with time
    can use the events' partitioning."""
    places = F.when(c("g_key").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(-1).cast("long"), c("g_buckets") - 1))
    return lookup_join(rows, grid, [(key, "g_key")]).withColumn(into, F.explode(places)).drop(*grid.columns)
