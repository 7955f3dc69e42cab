"""Bridges from the driver's tables to timed segments: stand-ins for transcripts, which the tables lack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of conversations as segments of 60 ms a character, one after another."""
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("rec"), "turn", F.col("role").alias("speaker"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    w = Window.partitionBy("rec").orderBy("turn", "line")
    dur = F.char_length("text").cast("bigint") * 60
    rows = rows.withColumn("ord", F.row_number().over(w).cast("bigint") - 1).withColumn("end_ms", F.sum(dur).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("rec", "ord", (F.col("end_ms") - dur).alias("start_ms"), "end_ms", "speaker", "text")


def seg_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seg with zero and negative durations and blank texts."""
    by = lambda n: F.col("ord") % n == 0
    end = F.when(by(17), F.col("start_ms")).when(by(19), F.col("start_ms") - 10).otherwise(F.col("end_ms"))
    return seg(spark, sf_dir).withColumn("end_ms", end).withColumn("text", F.when(by(23), "  ").otherwise(F.col("text")))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as speaker turns: a recording a day, a speaker a type, value seconds long."""
    e = read(spark, sf_dir, "events")
    start = F.pmod(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint"), F.lit(DAY_MS))
    rows = e.select(F.col("ts").cast("date").alias("rec"), "event_id", F.col("event_type").alias("speaker"), start.alias("start_ms"), F.rint(F.col("value") * 1000).cast("bigint").alias("dur"))
    return rows.select("rec", F.col("event_id").alias("ord"), "start_ms", (F.col("start_ms") + F.col("dur")).alias("end_ms"), "speaker")


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("rec").distinct().withColumn("duration_ms", F.lit(DAY_MS).cast("bigint"))


def grid(spark: SparkSession, sf_dir: str, context_ms: int = 8_000, cells: int = 58, size_ms: int = 1_500_000) -> DataFrame:
    """A fixed plan of 25-minute cores for every recording."""
    i = F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("i")
    rows = turns(spark, sf_dir).select("rec").distinct().select("rec", i)
    lo = F.col("i").cast("bigint") * size_ms
    return rows.select("rec", F.col("i").cast("bigint").alias("chunk"), F.greatest(lo - context_ms, F.lit(0).cast("bigint")).alias("dec_lo_ms"), (lo + size_ms + context_ms).alias("dec_hi_ms"), lo.alias("core_lo_ms"), (lo + size_ms).alias("core_hi_ms"))


def doclines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("rec"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    return rows.withColumn("ord", F.col("ord").cast("bigint"))


#: The same bridges in DuckDB's SQL, to be put behind WITH.
SQL_SEG = """
lines AS (
  SELECT conv_id AS rec, turn, role AS speaker, unnest(string_split(text, chr(10))) AS text,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line FROM conversations
), seg AS (
  SELECT rec, (row_number() OVER w - 1)::BIGINT AS ord,
         (sum(length(text) * 60) OVER w - length(text) * 60)::BIGINT AS start_ms,
         (sum(length(text) * 60) OVER w)::BIGINT AS end_ms, speaker, text
  FROM lines WINDOW w AS (PARTITION BY rec ORDER BY turn, line ROWS UNBOUNDED PRECEDING)
)"""
SQL_DIRTY = SQL_SEG + """, dirty AS (
  SELECT rec, ord, start_ms,
         CASE WHEN ord % 17 = 0 THEN start_ms WHEN ord % 19 = 0 THEN start_ms - 10 ELSE end_ms END AS end_ms,
         speaker, CASE WHEN ord % 23 = 0 THEN '  ' ELSE text END AS text FROM seg
)"""
SQL_TURNS = """
turns AS (
  SELECT ts::DATE AS rec, event_id AS ord, (epoch_us(ts) // 1000) % 86400000 AS start_ms,
         ((epoch_us(ts) // 1000) % 86400000 + round_even(value * 1000, 0))::BIGINT AS end_ms, event_type AS speaker FROM events
)"""
SQL_GRID = SQL_TURNS + """, grid AS (
  SELECT rec, i::BIGINT AS chunk, greatest(i * 1500000 - 8000, 0)::BIGINT AS dec_lo_ms, (i * 1500000 + 1508000)::BIGINT AS dec_hi_ms,
         (i * 1500000)::BIGINT AS core_lo_ms, (i * 1500000 + 1500000)::BIGINT AS core_hi_ms
  FROM (SELECT DISTINCT rec FROM turns), range(58) r(i)
)"""
SQL_LINES = """
doclines AS (
  SELECT doc_id AS rec, unnest(string_split(text, chr(10))) AS text,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1))::BIGINT AS ord FROM documents
)"""
