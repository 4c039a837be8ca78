"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every end of ``links`` (a, b, both long); root is the smallest node
    reachable. A round takes the smallest root among a node's neighbours (summed map-side, so
    a hub is no hot group), then jumps to the root's root, so paths shrink by half at least.
    Each round is written to the shared folder; only counts reach the driver."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "cc-roots")
    for _ in range(max_rounds):
        near = (both.join(roots.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("root").alias("near")))
        hooked = materialize(roots.join(materialize(near, "cc-near"), "node", "left")
                             .select("node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root")), "cc-hooked")
        over = hooked.select(F.col("node").alias("root"), F.col("root").alias("over"))
        roots = materialize(hooked.join(over, "root", "left").select("node", "old", F.least("root", F.coalesce("over", "root")).alias("root")), "cc-roots")
        changed = roots.where("root != old").limit(1).count()
        roots = roots.select("node", "root")
        if not changed:
            return roots
    raise RuntimeError("the components did not settle")
