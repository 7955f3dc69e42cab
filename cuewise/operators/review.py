"""Routing, remapping and numbering of segments for review.

Times are judged in seconds as the source has them (columns start_s and end_s, where a scan gives them), so nothing that
rounding to milliseconds would shorten or lengthen is rejected or kept by mistake.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import textnorm, timefmt

SPEECH_CUTOFF_MS, FIRST_START_MS, CUTOFF_MS = 2_158_000, 7_540, 4_809_500
REASONS = ("empty_text", "invalid_or_zero_duration", "after_cutoff")

# Names of the diarized speakers; the third label is a fragment of the second.
SPEAKER_NAMES = {"S01": "西卡", "S02": "万国", "S03": "万国"}


def route(segments: DataFrame, cutoff_ms: int | Column = CUTOFF_MS) -> DataFrame:
    """segments with verdict: the first reason that fits, or kept. Null times (NaN in the source) have no valid duration."""
    start, end = (timefmt.exact(segments.columns, side) for side in ("start", "end"))
    cutoff = timefmt.to_seconds(F.lit(cutoff_ms) if isinstance(cutoff_ms, int) else cutoff_ms)
    valid = F.coalesce(end > start, F.lit(False)) & ~F.isnan(F.coalesce(start, F.lit(0.0))) & ~F.isnan(F.coalesce(end, F.lit(0.0)))
    verdict = F.when(textnorm.strip(F.coalesce("text", F.lit(""))) == "", REASONS[0]).when(~valid, REASONS[1]).when(end > cutoff, REASONS[2]).otherwise("kept")
    return segments.withColumn("verdict", verdict)


def kept(routed: DataFrame) -> DataFrame:
    """Kept segments, numbered densely from 1 in their order, with stripped text."""
    n = F.row_number().over(Window.partitionBy("rec").orderBy("ord")).cast("bigint")
    return routed.where("verdict = 'kept'").withColumn("id", n).withColumn("text", textnorm.strip(F.col("text"))).drop("verdict")


def counters(routed: DataFrame) -> DataFrame:
    """Per recording the number of source segments, kept ones, and each reason (0 where there is none)."""
    each = [F.count_if(F.col("verdict") == r).alias(r) for r in REASONS]
    return routed.groupBy("rec").agg(F.count(F.lit(1)).alias("source_segment_count"), F.count_if(F.col("verdict") == "kept").alias("segment_count"), *each)


def remap(key: Column, names: dict[str, str]) -> Column:
    """The name of a key, or the key itself."""
    if not names:
        return key
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def remap_by(segments: DataFrame, names: DataFrame, rec: bool = True) -> DataFrame:
    """As remap, from a table [rec,] id, display_name. Catalyst broadcasts it if its size allows."""
    on = (["rec"] if rec else []) + ["speaker"]
    j = segments.join(names.select(*on[:-1], F.col("id").alias("speaker"), "display_name"), on, "left")
    return j.withColumn("original_speaker_id", F.col("speaker")).withColumn("speaker", F.coalesce("display_name", "speaker")).drop("display_name")


def diarized(segments: DataFrame, cutoff_ms: int = SPEECH_CUTOFF_MS, first_start_ms: int | None = FIRST_START_MS, names: dict[str, str] | None = None) -> DataFrame:
    """Segments that start before the cutoff; the first of the source (not of what is left) may get another start."""
    first = F.lit(first_start_ms is not None) & (F.col("ord") == 0)
    start, end = (timefmt.exact(segments.columns, side) for side in ("start", "end"))
    more = [F.when(first, F.lit((first_start_ms or 0) / 1000)).otherwise(start).alias("start_s"), end.alias("end_s")] if "start_s" in segments.columns else []
    return segments.where(start < F.lit(cutoff_ms / 1000)).select(
        "rec",
        "ord",
        F.when(first, F.lit(first_start_ms or 0).cast("bigint")).otherwise(F.col("start_ms")).alias("start_ms"),
        "end_ms",
        *more,
        remap(F.col("speaker"), SPEAKER_NAMES if names is None else names).alias("speaker"),
        F.col("speaker").alias("original_speaker_id"),
        textnorm.strip_speaker_tag(F.col("text")).alias("text"),
    )


# The notes of a diarized document; times have three decimals.
MAPPED = ("Mapped S01 to 西卡.", "Mapped S02 and fragmented S03 turns to 万国.")
STARTED = ("Corrected the first cue start to ", "s using the baseline MOSS run.")
DISCARDED = ("Discarded output beginning at ", "s or later as outro hallucination.")


def notes(first_start_ms: int = FIRST_START_MS, cutoff_ms: int = SPEECH_CUTOFF_MS, mapped: tuple[str, ...] = MAPPED) -> list[Column]:
    """What was done to a diarized transcript, as its document says it."""

    def timed(words: tuple[str, str], ms: int) -> Column:
        return F.concat(F.lit(words[0]), timefmt.fixed3(F.lit(ms / 1000)), F.lit(words[1]))

    return [*map(F.lit, mapped), timed(STARTED, first_start_ms), timed(DISCARDED, cutoff_ms)]
