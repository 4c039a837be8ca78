"""Incremental trigger for the daily job: bill files dropped into a folder (the CUR's daily
delivery) are picked up by a Structured Streaming file source; each micro-batch reruns
the daily job for every invoice month it touched. The job replaces whole months, so a
replayed batch (after a failure) writes the same result again: the sink is idempotent
and the stream's checkpoint records which files were processed.

Only the distinct months of a batch reach the driver; the batch rows themselves are
never collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from costloom.sources.catalog import Catalog


def months_in_batch(batch: DataFrame) -> list[int]:
    return sorted(r.invoice_month for r in batch.select("invoice_month").distinct().collect()
                  if r.invoice_month is not None)


def watch_bill_drops(spark: SparkSession, drop_path: str, schema: StructType,
                     catalog_for_month: Callable[[int], Catalog], target: str, checkpoint_location: str,
                     available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream. ``catalog_for_month`` returns the catalog the daily job reads
    (the full bill dataset, not just the new files: a month is always recomputed whole)."""
    from costloom.plans.daily import DailyJob

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        for month in months_in_batch(batch):
            status = DailyJob(catalog_for_month(month), month).run(target)
            if status["error"]:  # the batch stays unprocessed and is tried again
                raise RuntimeError(status["error"])

    stream = spark.readStream.schema(schema).parquet(drop_path).select("invoice_month")
    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 hour")
    return writer.start()
