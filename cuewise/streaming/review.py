"""Routing of arriving transcripts with Structured Streaming.

Scans and routing are the same expressions as in batch. A recording is one document, so its segments arrive together and no
watermark is needed; what is kept between batches is the checkpoint's list of files alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import schema
from ..operators import review
from ..sources import transcripts


def documents(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """One row per JSON document that comes into the folder, with rec, its path."""
    read = spark.readStream.schema(schema.TRANSCRIPT).option("multiLine", True).option("maxFilesPerTrigger", files_at_once)
    return read.json(folder).withColumn("rec", F.col("_metadata.file_path"))


def routed(spark: SparkSession, folder: str, cutoff_ms: int | Column = review.CUTOFF_MS) -> DataFrame:
    """Segments of arriving recognition transcripts, each with its verdict."""
    return review.route(transcripts.asr_segments(documents(spark, folder)), cutoff_ms)


def write(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Verdicts to Parquet, every document once, also after a restart from the checkpoint."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("verdict")
