"""The bronze -> silver quality job on a stream of bronze files.

The reference runs daily batches; this module only re-expresses the same job
for arriving files: each micro-batch goes through ``dq_frames`` (rules,
split, cleaning, dedup inside the batch) and its valid rows and quarantine
records are written to folders named after the epoch, so a replayed epoch
overwrites its own output and nothing else (exactly-once with a checkpoint
location).  The silver snapshot over all batches is ``keep_one`` over the
accumulated changes, a batch job.

``daily_quarantine_counts`` is the streaming form of the spike alert's
input: quarantine rows per table and day with a watermark, so late records
within the allowed delay still count and state is dropped afterwards.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators import dedup
from strata.plans.jobs import Run, dq_frames


def dq_micro_batches(bronze_stream: DataFrame, rule: dict, source_table: str, out_root: str,
                     checkpoint_location: str, run_prefix: str = "stream", available_now: bool = True,
                     **dq_kw) -> StreamingQuery:
    """Start the quality job over ``bronze_stream``; returns the query."""
    root = out_root.rstrip("/")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        run = Run(f"{run_prefix}_{epoch_id:010d}", datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))
        batch.persist()
        try:
            f = dq_frames(batch, rule, source_table, run, **dq_kw)
            f.silver.write.mode("overwrite").parquet(f"{root}/silver_changes/epoch={epoch_id}")
            f.quarantine.write.mode("overwrite").parquet(f"{root}/quarantine/epoch={epoch_id}")
        finally:
            batch.unpersist()

    w = bronze_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def silver_snapshot(changes: DataFrame, keys: list[str], order_by: str, tie_breakers: list[str] | None = None
                    ) -> DataFrame:
    """Latest row per key over all micro-batch outputs (a batch read)."""
    return dedup.keep_one(changes.drop("epoch"), keys, order_by, "desc", tie_breakers)


def daily_quarantine_counts(quarantine_stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Quarantine records per table and day, finalised once the watermark
    passes the day's end (append mode)."""
    return (quarantine_stream.withWatermark("created_at", delay)
            .groupBy(F.window("created_at", "1 day").alias("day"), "source_table")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("day.start").cast("date").alias("d"), "source_table", "n"))
