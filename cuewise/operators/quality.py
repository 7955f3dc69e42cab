"""Measurements of a transcript: integrity, coverage, shares, loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textnorm


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def speaker_share(segments: DataFrame, text: str | None = None) -> DataFrame:
    """Per recording and speaker: milliseconds, their share of all, and the same for characters if there is a text."""
    w = Window.partitionBy("rec")
    out = segments.groupBy("rec", "speaker").agg(
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("voiced_ms"),
        *([F.sum(F.char_length(text)).alias("chars")] if text else []),
    )
    out = out.withColumn("share", _ratio(F.col("voiced_ms"), F.sum("voiced_ms").over(w)))
    return out.withColumn("char_share", _ratio(F.col("chars"), F.sum("chars").over(w))) if text else out


def fragmented(shares: DataFrame, below: float = 0.01) -> DataFrame:
    """Labels that hold so little that they may be pieces of another; a person decides."""
    return shares.where(F.col("share") < below)


def coverage(segments: DataFrame, recordings: DataFrame) -> DataFrame:
    """How far the last segment reaches into each recording: rec, duration_ms, last_ms, coverage."""
    last = segments.groupBy("rec").agg(F.max("end_ms").alias("last_ms"))
    return recordings.join(last, "rec", "left").withColumn("coverage", _ratio(F.coalesce("last_ms", F.lit(0)), F.col("duration_ms")))


def integrity(segments: DataFrame, duration_ms: Column, text: str | None = None) -> DataFrame:
    """Counts of doubtful rows per recording; nothing is repaired."""
    w = Window.partitionBy("rec").orderBy("ord")
    rows = segments.withColumn("_start", F.lag("start_ms").over(w)).withColumn("_end", F.lag("end_ms").over(w)).withColumn("_d", duration_ms)
    empty = [F.count_if(textnorm.strip(F.col(text)) == "").alias("n_empty")] if text else []
    return rows.groupBy("rec").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("end_ms") < F.col("start_ms")).alias("n_negative"),
        F.count_if(F.col("end_ms") == F.col("start_ms")).alias("n_zero"),
        F.count_if(F.col("start_ms") < F.col("_start")).alias("n_backward"),
        F.count_if(F.col("start_ms") < F.col("_end")).alias("n_overlapping"),
        F.count_if(F.col("end_ms") > F.col("_d")).alias("n_beyond"),
        F.every(F.col("end_ms") >= F.col("start_ms")).alias("non_negative"),
        F.every(F.col("end_ms") > F.col("start_ms")).alias("positive"),
        *empty,
    )


def _islands(rows: DataFrame, same: str) -> DataFrame:
    w = Window.partitionBy("rec").orderBy("ord")
    new = F.when(F.col(same).eqNullSafe(F.lag(same).over(w)) & (F.lag("ord").over(w)).isNotNull(), 0).otherwise(1)
    return rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def loop_runs(rows: DataFrame, least: int = 3, text: str = "text") -> DataFrame:
    """Runs of at least `least` equal neighbouring texts: flagged, never deleted."""
    runs = _islands(rows, text).groupBy("rec", "_island").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("length"), F.first(text).alias("text"))
    return runs.where(F.col("length") >= least).drop("_island")


def repeated_lines(rows: DataFrame, least: int = 3, text: str = "text") -> DataFrame:
    """Texts that a recording holds at least `least` times, wherever."""
    return rows.groupBy("rec", text).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord")).where(F.col("n") >= least)


def tail_candidates(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Where a recording ends in a loop: the first place of that run, a candidate for a cutoff."""
    last = rows.groupBy("rec").agg(F.max("ord").alias("last_ord"))
    return runs.join(last, "rec").where(F.col("first_ord") + F.col("length") - 1 == F.col("last_ord")).select("rec", "first_ord", "length")


def speaker_turns(segments: DataFrame) -> DataFrame:
    """Neighbouring segments of one speaker as one turn, numbered from 1."""
    t = _islands(segments, "speaker").groupBy("rec", F.col("_island").alias("turn")).agg(
        F.first("speaker").alias("speaker"), F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n_segments"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")
    )
    return t.withColumn("turn", F.col("turn").cast("bigint"))


def reading_speed(segments: DataFrame) -> DataFrame:
    """Characters a second of every segment of positive length."""
    d = F.col("end_ms") - F.col("start_ms")
    return segments.where(d > 0).withColumn("chars_per_s", F.char_length("text") * F.lit(1000.0) / d)


def gate(segments: DataFrame) -> DataFrame:
    """Per recording: are there segments, and is every one longer than nothing?"""
    return segments.groupBy("rec").agg((F.count(F.lit(1)) > 0).alias("non_empty"), F.every(F.col("end_ms") > F.col("start_ms")).alias("all_valid"))


def distinct_speakers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("rec").agg(F.countDistinct("speaker").alias("num_speakers"))


def run_totals(metrics: DataFrame, by: str = "model") -> DataFrame:
    """Of runs in parts: seconds add up, the peak of memory is the largest. metrics: by, audio_s, infer_s, peak_gb."""
    return metrics.groupBy(by).agg(F.sum("audio_s").alias("audio_s"), F.sum("infer_s").alias("infer_s"), F.max("peak_gb").alias("peak_gb"), F.count(F.lit(1)).alias("n_parts"))


def aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per recording: segments that both sides have with equal times, and those of either side alone."""
    on = ["rec", "start_ms", "end_ms"]
    j = first.select(*on, F.lit(1).alias("_a")).join(second.select(*on, F.lit(1).alias("_b")), on, "full")
    return j.groupBy("rec").agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"), F.count_if(F.col("_b").isNull()).alias("n_first_only"), F.count_if(F.col("_a").isNull()).alias("n_second_only")
    )
