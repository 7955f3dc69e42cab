"""Scans of transcript documents: one row per segment with rec (the file), ord and whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import timefmt, urls
from ..operators import chunking


def documents(spark: SparkSession, path: str, kind=schema.TRANSCRIPT) -> DataFrame:
    """One row per JSON document, with rec, its path."""
    return spark.read.schema(kind).option("multiLine", True).json(path).withColumn("rec", F.col("_metadata.file_path"))


def _needed(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit(f"no {name} in "), F.col("rec").cast("string")))).otherwise(value)


def diarized_segments(docs: DataFrame) -> DataFrame:
    """segments must be there, and in each of them start, end and text: a document without fails the query."""
    rows = docs.select("rec", F.posexplode(_needed(F.col("segments"), "segments")).alias("ord", "s"))
    start, end = _needed(F.col("s.start"), "start"), _needed(F.col("s.end"), "end")
    return rows.select(
        "rec",
        F.col("ord").cast("bigint").alias("ord"),
        timefmt.to_ms(start).alias("start_ms"),
        timefmt.to_ms(end).alias("end_ms"),
        start.alias("start_s"),
        end.alias("end_s"),
        F.coalesce("s.speaker_id", F.lit("UNKNOWN")).alias("speaker"),
        _needed(F.col("s.text"), "text").alias("text"),
    )


def asr_segments(docs: DataFrame) -> DataFrame:
    """Without segments there are no rows. Missing times are 0 and a missing text is empty; a time that is NaN stays null,
    for the router to reject."""

    def seconds(c: str) -> Column:
        return F.when(F.isnan(c), None).otherwise(F.coalesce(F.col(c), F.lit(0.0)))

    empty = F.array().cast(f"array<{schema.SEGMENT}>")
    rows = docs.select("rec", F.posexplode(F.coalesce("segments", empty)).alias("ord", "s"))
    start, end = seconds("s.start"), seconds("s.end")
    return rows.select(
        "rec",
        F.col("ord").cast("bigint").alias("ord"),
        timefmt.to_ms(start).alias("start_ms"),
        timefmt.to_ms(end).alias("end_ms"),
        start.alias("start_s"),
        end.alias("end_s"),
        F.coalesce("s.text", F.lit("")).alias("text"),
        "s.avg_logprob",
        "s.no_speech_prob",
    )


def tagged_texts(docs: DataFrame) -> DataFrame:
    """Documents of tagged text for tagged.extract; without text there are no records."""
    return docs.select("rec", F.coalesce("text", F.lit("")).alias("text"))


def silences(spark: SparkSession, path: str) -> DataFrame:
    """What a silence detector found, one JSON document a recording: rec, lo_ms, hi_ms."""
    rows = documents(spark, path, schema.SILENCES).select("rec", F.explode("silences").alias("s")).select("rec", "s.*")
    return chunking.stated_silences(rows)


def recordings(spark: SparkSession, path: str) -> DataFrame:
    """What a media probe found, one JSON document a recording: rec, duration_ms, sample_rate, channels, codec."""
    rows = documents(spark, path, schema.RECORDING)
    return rows.select("rec", timefmt.to_ms(F.col("duration")).alias("duration_ms"), "sample_rate", "channels", "codec")


def to_resample(recordings: DataFrame, rate: int = 16_000, channels: int = 1) -> DataFrame:
    """Recordings that are not yet at the rate and number of channels that models take."""
    return recordings.where(~(F.col("sample_rate").eqNullSafe(rate) & F.col("channels").eqNullSafe(channels)))


def turns(spark: SparkSession, path: str) -> DataFrame:
    """Diarization turns; a speaker given as a number reads as text."""
    rows = documents(spark, path, schema.TURNS).select("rec", F.posexplode("segments").alias("ord", "s"))
    return rows.select("rec", F.col("ord").cast("bigint").alias("ord"), timefmt.to_ms(F.col("s.start")).alias("start_ms"), timefmt.to_ms(F.col("s.end")).alias("end_ms"), "s.speaker")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return chunks(documents(spark, path, schema.MANIFEST))


def chunks(docs: DataFrame) -> DataFrame:
    rows = docs.select("rec", F.explode("chunks").alias("c"))
    ms = lambda name: timefmt.to_ms(F.col(f"c.{name}"))
    return rows.select("rec", "c.chunk", ms("decoded_start").alias("dec_lo_ms"), ms("decoded_end").alias("dec_hi_ms"), ms("core_start").alias("core_lo_ms"), ms("core_end").alias("core_hi_ms"), "c.fallback")


def reviewed(spark: SparkSession, path: str) -> DataFrame:
    return documents(spark, path, schema.REVIEWED)


def parse_cues(blocks: Column) -> Column:
    """An array of SRT blocks as an array of id, start_ms, end_ms, text."""

    def ms(block: Column, first: int) -> Column:
        part = lambda i: F.regexp_extract(block, CUE, first + i).cast("bigint")
        return ((part(0) * 60 + part(1)) * 60 + part(2)) * 1000 + part(3)

    def cue(b: Column) -> Column:
        return F.struct(F.regexp_extract(b, CUE, 1).cast("bigint").alias("id"), ms(b, 2).alias("start_ms"), ms(b, 6).alias("end_ms"), F.regexp_extract(b, CUE, 10).alias("text"))

    return F.transform(F.filter(blocks, lambda b: b.rlike(CUE)), cue)


CUE = r"(?s)^\s*(\d+)\r?\n(\d+):(\d\d):(\d\d),(\d{3}) --> (\d+):(\d\d):(\d\d),(\d{3})\r?\n(.*?)\s*$"


def srt_cues(texts: DataFrame) -> DataFrame:
    """texts: rec, text (whole SRT documents). One row per cue."""
    blocks = F.split(F.regexp_replace("text", "\r\n", "\n"), r"\n\n+")
    return texts.select("rec", F.explode(parse_cues(blocks)).alias("c")).select("rec", "c.id", "c.start_ms", "c.end_ms", "c.text")


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    return srt_cues(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("rec"), F.col("value").alias("text")))


def media(spark: SparkSession, path: str, limit: int = urls.SIZE_LIMIT) -> DataFrame:
    """Files up to the limit with their byte count and SHA-256; the content itself stays where it is."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") <= limit)
    return files.select(F.col("path").alias("rec"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
