"""Split target rows across a weight table that has no join key (every target row meets
every weight row: infra redistribution, JOI14).

The product itself is the result, so it has to be spread over tasks. A weight table that
Spark's own size estimate puts under the broadcast threshold goes to the tasks, and target
rows stay where they are. A larger one is copied once per bucket, and the target rows are
dealt over the buckets by a hash of the row: each task joins its share of the target rows
to all weights. Neither path runs an action or builds rows on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import session


def fan_out(df: DataFrame, is_target: Column, weights: DataFrame, fields: dict, buckets: int | None = None,
            broadcast: bool | None = None) -> DataFrame:
    """Rows where ``is_target`` holds become one row per weight row, carrying the weight
    columns ``fields`` (name -> type); other rows get NULLs there and ``_w_hit = False``.
    Target rows vanish when ``weights`` is empty, as in the reference. ``broadcast``
    overrides the size check (tests)."""
    target = F.coalesce(is_target, F.lit(False))
    w = weights.select(*[F.col(k).cast(t).alias(k) for k, t in fields.items()], F.lit(True).alias("_w_hit"))
    small = session.under_broadcast_threshold(weights) if broadcast is None else broadcast
    n = 1 if small else buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    w = w.withColumn("_w_b", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    deal = F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int") if n > 1 else F.lit(0)
    rows = df.where(target).withColumn("_b", deal)
    hit = rows.join(F.broadcast(w) if small else w, F.col("_b") == F.col("_w_b")).drop("_b", "_w_b")
    rest = df.where(~target).withColumns({**{k: F.lit(None).cast(t) for k, t in fields.items()},
                                          "_w_hit": F.lit(False)})
    return hit.unionByName(rest)
