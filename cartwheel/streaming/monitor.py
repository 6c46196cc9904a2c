"""Quality monitoring as a stream: one history row per arriving batch of orders.

The reference appends one quality-metrics row per manual run.  Here the same
operator (``quality_metrics_row``) runs on every micro-batch of new silver
files.  Spark's file source records in the stream's checkpoint which files
each batch read, and a batch that failed (a lost executor, a killed driver)
is replayed with the same files and the same id.  ``foreachBatch`` writes the
batch's row into its own ``stream_batch=<id>`` folder of the history table
with overwrite, so a replay rewrites that folder instead of appending a
second row: no batch is skipped or counted twice.  Each row describes the
orders that arrived in that batch; reading ``history`` returns the rows with
their ``stream_batch`` id.

With ``available_now=True`` the stream processes everything present and
stops (a scheduled incremental job); otherwise it keeps running with the
given trigger interval.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators.quality import QualityRules, quality_metrics_row
from cartwheel.plans.pipeline import layer_root


def start_quality_monitor(
    spark: SparkSession,
    source: str,
    history: str,
    checkpoint_location: str | None = None,
    as_of: _dt.date | str | None = None,
    rules: QualityRules = QualityRules(),
    available_now: bool = True,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
):
    """Start the monitor over Parquet silver files under ``source``; returns the
    ``StreamingQuery``.  The checkpoint defaults to the cluster's shared
    checkpoint folder."""
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source)
    checkpoint_location = checkpoint_location or f"{layer_root(spark)}/../streams/quality_monitor"

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        row = quality_metrics_row(batch, as_of=as_of, rules=rules)
        row.coalesce(1).write.mode("overwrite").parquet(f"{history.rstrip('/')}/stream_batch={batch_id}")

    writer = stream.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
