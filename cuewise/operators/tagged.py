"""Records of tagged text, [start]Name: words[end], as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textnorm

# Fixed value: the record pattern; names hold 1 to 80 characters, the words run on over lines to the next number.
NUMBER = r"\[(\d+(?:\.\d+)?)\]"
RECORD = rf"(?s){NUMBER}([^\[\]:]{{1,80}}):{textnorm.SPACE}*(.*?){NUMBER}"


def records(text: Column) -> Column:
    part = lambda i: F.regexp_extract_all(text, F.lit(RECORD), F.lit(i))
    return F.arrays_zip(part(1).alias("start"), part(2).alias("name"), part(3).alias("words"), part(4).alias("end"))


def extract(texts: DataFrame, offset_s: Column | float = 0.0, chunk: Column | str = "") -> DataFrame:
    """texts: rec, text. One row per record, numbered from 1; times relative and with the offset."""
    offset = F.lit(offset_s) if isinstance(offset_s, float) else offset_s
    tag = F.lit(chunk) if isinstance(chunk, str) else chunk
    rows = texts.select("rec", tag.alias("chunk"), offset.alias("_offset"), F.posexplode(records(F.col("text"))).alias("pos", "r"))
    start, end = F.col("r.start").cast("double"), F.col("r.end").cast("double")
    return rows.select(
        "rec",
        "chunk",
        (F.col("pos") + 1).cast("bigint").alias("id"),
        start.alias("relative_start"),
        end.alias("relative_end"),
        (start + F.col("_offset")).alias("absolute_start"),
        (end + F.col("_offset")).alias("absolute_end"),
        textnorm.strip(F.col("r.name")).alias("model_speaker_guess"),
        textnorm.collapse(F.col("r.words")).alias("text"),
    )


def guess_counts(rows: DataFrame, speaker: str = "model_speaker_guess", order: str = "id", by: tuple[str, ...] = ("rec",)) -> DataFrame:
    """Rows per guessed name, with the place of its first appearance."""
    return rows.groupBy(*by, speaker).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_ord"))


def guess_list(counts: DataFrame, speaker: str = "model_speaker_guess") -> DataFrame:
    """Per recording the names with their counts in order of first appearance (a map would lose it)."""
    got = F.array_sort(F.collect_list(F.struct("first_ord", F.col(speaker).alias("name"), "n")))
    return counts.groupBy("rec").agg(F.transform(got, lambda x: F.struct(x["name"].alias("name"), x["n"].alias("n"))).alias("speaker_guess_counts"))
