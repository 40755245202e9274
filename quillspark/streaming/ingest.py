"""Streaming forms of ingest and the daily comparison.

These go beyond the batch pipeline: they run the same operators on an unbounded raw folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark import schemas
from quillspark.operators import metadata
from quillspark.plans import pipeline


def raw_stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(f"meta struct<{schemas.META_DDL}>, payload struct<{schemas.PAYLOAD_DDL}>").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(root).withColumn("raw_path", F.col("_metadata.file_path"))


def bronze_stream(raw: DataFrame, late: str = "1 day") -> DataFrame:
    """Flat rows, each (run_id, record_hash) once within the watermark."""
    rows = metadata.trim_strings(metadata.with_ingest_date(metadata.normalize_raw(raw)))
    return rows.withWatermark("ingest_ts", late).dropDuplicatesWithinWatermark(["run_id", "record_hash"])


def run_silver_stream(bronze: DataFrame, write, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Silver tables of each micro-batch go to ``write(name, df, batch_id)``."""

    def each(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            for name, df in pipeline.silver(rows).items():
                write(name, df, batch_id)
        finally:
            rows.unpersist()

    out = bronze.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def windowed_comparison(events: DataFrame, time: str, keys: list[str], bad, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Rows and share of bad rows per time window and key, late rows up to the watermark."""
    grouped = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("step_count"), F.avg(F.when(bad, 1.0).otherwise(0.0)).alias("bad_rate"))
