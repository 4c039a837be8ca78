"""Spot-instance on-demand pricing (SPT1, three per-job variants) and the unmapped-size report (SPT2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.columns import c, scaled, second_part
from costloom.operators.lookup import lookup_join

#: (rows, name, facts about them) -> rows: how a job gathers facts while rows pass.
Watch = Callable[..., DataFrame]


def unwatched(df: DataFrame, name: str, *facts: Column) -> DataFrame:
    return df


def unique_rows(lookup: DataFrame, key: str, what: str) -> DataFrame:
    """``lookup`` as it is, if no key stands in two rows: an update-join against a repeated key
    is ambiguous, so the plan raises where it meets one. NULL keys match nothing and go."""
    others = [x for x in lookup.columns if x != key]
    once = lookup.where(c(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(x).alias(x) for x in others])
    refused = F.raise_error(F.concat(F.lit(f"{what}: key {key}="), c(key).cast("string"), F.lit(" is not unique")))
    kept = {x: F.when(c("_n") > 1, refused.cast(lookup.schema[x].dataType)).otherwise(c(x)) for x in others}
    return once.withColumns(kept).select(*lookup.columns)


def _prices(price_list: DataFrame) -> DataFrame:
    prices = price_list.select("product_instance_type", "pricing_public_on_demand_rate", F.lit(True).alias("pl_hit"))
    return unique_rows(prices, "product_instance_type", "price_list").withColumnsRenamed(
        {"product_instance_type": "pl_type", "pricing_public_on_demand_rate": "pl_rate"})


def unpriced_sizes(type_col: str, usage_type_col: str, size_col: str) -> Column:
    """SPT2 as an aggregate over rows that were joined to the price list."""
    spot = (c(type_col) == K.USAGE) & c(usage_type_col).like("%SpotUsage%")
    return F.collect_set(F.when(spot & ~F.coalesce(c("pl_hit"), F.lit(False)), c(size_col))).alias("unmapped")


def fill_spot_daily(df: DataFrame, price_list: DataFrame, watch: Watch = unwatched) -> DataFrame:
    """Daily: spot usage (``%Spot%``) gets instance type/family from the usage type, then
    the listed on-demand rate and ``rate * usage_amount``; a missing price leaves the row."""
    t, ut = c("line_item_line_item_type"), c("line_item_usage_type")
    spot = (t == K.USAGE) & ut.like("%Spot%")
    size = second_part(ut, ":")
    df = df.withColumns({
        "product_instance_type": F.when(spot, size).otherwise(c("product_instance_type")),
        "product_instance_type_family":
            F.when(spot, F.split_part(size, F.lit("."), F.lit(1))).otherwise(c("product_instance_type_family"))})
    j = lookup_join(df, _prices(price_list), [("product_instance_type", "pl_type")], residual=spot)
    j = watch(j, "spot", unpriced_sizes("line_item_line_item_type", "line_item_usage_type", "product_instance_type"))
    hit = F.coalesce(c("pl_hit"), F.lit(False))
    return j.withColumns({
        "pricing_public_on_demand_rate": F.when(hit, c("pl_rate").cast("string")).otherwise(c("pricing_public_on_demand_rate")),
        "pricing_public_on_demand_cost": F.when(hit, scaled(c("line_item_usage_amount"), c("pl_rate").cast(K.LISTED), K.MONEY))
                                          .otherwise(c("pricing_public_on_demand_cost")),
    }).drop("pl_type", "pl_rate", "pl_hit")


def unmapped_spot_sizes(df: DataFrame, price_list: DataFrame, size_col: str = "product_instance_type",
                        type_col: str = "line_item_line_item_type",
                        usage_type_col: str = "line_item_usage_type") -> DataFrame:
    """SPT2: distinct spot sizes (``%SpotUsage%``) with no price-list row."""
    sizes = (df.where((c(type_col) == K.USAGE) & c(usage_type_col).like("%SpotUsage%"))
               .select(c(size_col).alias("instance_size")).distinct())
    return sizes.join(price_list.select(c("product_instance_type").alias("pl_type")), c("instance_size") == c("pl_type"), "left_anti")


def reprice_spot_detail(df: DataFrame, price_list: DataFrame, watch: Watch = unwatched) -> DataFrame:
    """Detail: ``retail_cost = rate * quantity`` for priced ``%SpotUsage%`` usage; else unchanged."""
    spot = (c("lineitem_type") == K.USAGE) & c("usage_type").like("%SpotUsage%")
    j = lookup_join(df, _prices(price_list), [("instance_size", "pl_type")], residual=spot)
    j = watch(j, "spot", unpriced_sizes("lineitem_type", "usage_type", "instance_size"))
    hit = F.coalesce(c("pl_hit"), F.lit(False))
    return (j.withColumn("retail_cost", F.when(hit, (c("pl_rate") * c("quantity")).cast(K.DEC38_8))
                         .otherwise(c("retail_cost")))
             .drop("pl_type", "pl_rate", "pl_hit", "instance_size"))


def reprice_spot_summary(df: DataFrame, price_list: DataFrame, watch: Watch = unwatched) -> DataFrame:
    """Summary: rate rounded to NUMERIC(8,4); spot usage costs ``rate * qty``, or the
    unblended cost when no (non-zero) rate is listed."""
    spot = (c("lineitem_type") == K.USAGE) & c("usage_type").like("%SpotUsage%")
    j = lookup_join(df, _prices(price_list), [("instance_size", "pl_type")], residual=spot)
    j = watch(j, "spot", unpriced_sizes("lineitem_type", "usage_type", "instance_size"))
    rate = F.when(F.coalesce(c("pl_hit"), F.lit(False)), c("pl_rate").cast(K.SPOT_RATE)) \
        .otherwise(F.lit(0).cast(K.SPOT_RATE))
    priced = F.when(rate != 0, (rate * c("quantity")).cast(K.MONEY)).otherwise(c("unblended_cost"))
    return (j.withColumn("ondemand_cost", F.when(spot, priced).otherwise(c("ondemand_cost")))
             .drop("pl_type", "pl_rate", "pl_hit", "usage_type", "instance_size"))
