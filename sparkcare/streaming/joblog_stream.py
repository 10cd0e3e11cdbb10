"""Incremental ingestion of scheduler report files (S7 + T1 + K5 as a stream).

New report files dropped into a folder are parsed with the same ``parse_report``
as the batch path and appended to a parquet sink.  Progress (which files are
done) lives in ``checkpoint_location`` on a shared file system, so a restarted
or re-scheduled query continues exactly where it stopped (exactly-once file
sink).  ``available_now`` processes what is there and stops (batch-like runs
from a scheduler); otherwise the query keeps polling.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.runs import parse_report


def start_report_ingest(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        processing_time: str = "1 minute") -> StreamingQuery:
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir).select("value", F.col("_metadata.file_name").alias("source_file"))
    runs = parse_report(lines).withColumn("ingested_at", F.current_timestamp())
    w = (runs.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
