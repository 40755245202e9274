"""Streaming ingest gives the tables that the batch gives."""

from pyspark.sql import functions as F

from quillspark.plans import pipeline
from quillspark.sources import sample
from quillspark.streaming import ingest


def test_stream_matches_batch(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path / "lake"))
    pipeline.land_raw(spark, lake, sample.feedback_rows(spark, "both", 4), "r1", "2026-01-01")
    raw = ingest.raw_stream(spark, lake.raw)
    found = []
    query = ingest.run_silver_stream(ingest.bronze_stream(raw), lambda name, df, _: found.append((name, df.count())), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    pipeline.run_bronze(spark, lake)
    batch = pipeline.run_silver(spark, lake)
    assert {n: sum(c for m, c in found if m == n) for n, _ in found} == batch


def test_windowed_comparison(spark, tmp_path, sf_dir):
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(2).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "events")).schema).parquet(str(tmp_path / "events"))
    out = ingest.windowed_comparison(stream, "ts", ["event_type"], F.col("value") > 50, late="1000 days")
    query = out.writeStream.format("memory").queryName("windowed").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert spark.table("windowed").agg(F.sum("step_count")).first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()
