"""Continuous ingestion: new document files -> the same run, per micro-batch.

A file stream (Structured Streaming) picks up documents as they land; each
micro-batch goes through ``plans.pipeline.run_documents``: validate, stage,
flatten, merge, upsert, commit. The stream's checkpoint remembers which
files were taken; the batch id is written into the snapshot's commit marker,
so a micro-batch replayed after a failure is recognised and skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import run_documents


def document_stream(spark: SparkSession, source_dir: str, multiline: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (source, text) rows of the documents arriving in ``source_dir``."""
    reader = spark.readStream.format("text").option("wholetext", str(multiline).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(source_dir)
    if not multiline:
        df = df.where(F.length(F.trim("value")) > 0)
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def start_ingest(spark: SparkSession, source_dir: str, store_root: str,
                 checkpoint_location: str | None = None, mode: str = "quarantine",
                 multiline: bool = False, on_duplicate: str = "last",
                 max_files_per_trigger: int | None = None,
                 available_now: bool = True, processing_time: str | None = None,
                 layout: str = "by_day") -> StreamingQuery:
    """Start the ingestion stream; returns the running query.

    ``available_now`` processes what is there and stops (scheduled runs);
    otherwise a ``processing_time`` trigger keeps it running. The stream's
    checkpoint is kept in the store unless a place is given, so a restarted
    stream goes on where it was; a micro-batch that was already committed is
    recognised by its tag and skipped.
    """
    checkpoint = checkpoint_location or f"{store_root.rstrip('/')}/_stream"

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_documents(batch.sparkSession, batch, store_root, mode, on_duplicate, layout=layout,
                      tag=f"{checkpoint}#{batch_id}")

    writer = (document_stream(spark, source_dir, multiline, max_files_per_trigger)
              .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
