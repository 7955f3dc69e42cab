"""Review documents: SRT, Markdown and JSON texts, one row per recording, and their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import timefmt

# The wide colon between a speaker and the words.
COLON = "："


def _who() -> Column:
    return F.coalesce("speaker", F.lit("UNKNOWN"))


def _said() -> Column:
    return F.coalesce("text", F.lit(""))


def _ordered(rows: DataFrame, text: Column, sep: str, order: str, name: str) -> DataFrame:
    got = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return rows.groupBy("rec").agg(F.array_join(F.transform(got, lambda x: x["t"]), sep).alias(name))


def _span(mark: str = ",") -> Column:
    return F.concat(timefmt.clock(F.col("start_ms"), mark), F.lit(" --> "), timefmt.clock(F.col("end_ms"), mark))


def srt_with_speakers(rows: DataFrame) -> DataFrame:
    """rows: rec, id, start_ms, end_ms, speaker, text. Every cue ends in a blank line, the last one too. A cue without a
    speaker is UNKNOWN's, and one without a text has an empty one: no number is left out."""
    cue = F.concat(F.col("id").cast("string"), F.lit("\n"), _span(), F.lit("\n"), _who(), F.lit(COLON), _said(), F.lit("\n\n"))
    return _ordered(rows, cue, "", "id", "srt")


def srt_plain(rows: DataFrame) -> DataFrame:
    """Cues without speakers, a blank line between them, one line end after the last."""
    cue = F.concat(F.col("id").cast("string"), F.lit("\n"), _span(), F.lit("\n"), _said())
    return _ordered(rows, cue, "\n\n", "id", "srt").withColumn("srt", F.concat("srt", F.lit("\n")))


def speaker_markdown(rows: DataFrame, title: str, notice: str, order: str = "id") -> DataFrame:
    one = F.concat(F.lit("**"), _who(), F.lit(f"{COLON}** "), _said(), F.lit("\n\n"))
    return _ordered(rows, one, "", order, "md").withColumn("md", F.concat(F.lit(f"# {title}\n\n> {notice}\n\n"), "md"))


def content_markdown(rows: DataFrame, title: str, notice: str, order: str = "id") -> DataFrame:
    """Title, notice, then one text a line, without clocks."""
    return _ordered(rows, _said(), "\n", order, "md").withColumn("md", F.concat(F.lit(f"# {title}\n\n> {notice}\n\n"), "md", F.lit("\n")))


def raw_markdown(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Only what was said: texts with a blank line between them."""
    return _ordered(rows, _said(), "\n\n", order, "md").withColumn("md", F.concat("md", F.lit("\n")))


def final_markdown(docs: DataFrame) -> DataFrame:
    """rec, name, md for every reviewed document: source, calibrated, translated, bilingual and review texts.

    English sources give five (source, en, zh, bilingual, review), Chinese ones two (zh and review). No clocks.
    """
    names = F.map_from_entries(F.transform(F.coalesce("speakers", F.array().cast("array<struct<id:string,display_name:string,confidence:string,evidence:string>>")), lambda s: F.struct(s["id"], F.coalesce(s["display_name"], s["id"]))))
    segments = F.coalesce("segments", F.array().cast(docs.schema["segments"].dataType))
    rows = docs.select("rec", "metadata", segments.alias("segments"), "speakers", "unresolved", names.alias("names"))
    who = lambda s: F.coalesce(F.try_element_at(F.col("names"), s["speaker"]), s["speaker"], F.lit("UNKNOWN"))

    def body(*fields: str, mark: bool = False) -> Column:
        def one(s: Column) -> Column:
            text = F.concat_ws("\n\n", *[s[f] for f in fields])
            flag = F.when(F.coalesce(s["uncertain"], F.lit(False)), F.lit(" [?]")).otherwise("") if mark else F.lit("")
            return F.concat(F.lit("**"), who(s), F.lit(f"{COLON}** "), text, flag)

        return F.concat(F.lit("# "), F.coalesce("metadata.title", F.lit("")), F.lit("\n\n"), F.array_join(F.transform("segments", one), "\n\n"), F.lit("\n"))

    def listed(column: str, one) -> Column:
        return F.coalesce(F.array_join(F.transform(column, one), ""), F.lit(""))

    people = listed("speakers", lambda s: F.concat(F.lit("- "), F.coalesce(s["display_name"], s["id"]), F.lit(" ("), F.coalesce(s["confidence"], F.lit("unknown")), F.lit("): "), F.coalesce(s["evidence"], F.lit("")), F.lit("\n")))
    open_items = listed("unresolved", lambda u: F.concat(F.lit("- "), F.coalesce(u["type"], F.lit("")), F.lit(": "), F.coalesce(u["note"], F.lit("")), F.lit("\n")))
    review = F.concat(body("calibrated", mark=True), F.lit("\n## Speakers\n\n"), people, F.lit("\n## Unresolved\n\n"), open_items)
    entry = lambda name, md: F.struct(F.lit(name).alias("name"), md.alias("md"))
    english = F.array(entry("source", body("source")), entry("en", body("calibrated")), entry("zh", body("zh")), entry("bilingual", body("calibrated", "zh")), entry("review", review))
    chinese = F.array(entry("zh", body("calibrated")), entry("review", review))
    of = F.when(F.col("metadata.source_language") == "zh", chinese).otherwise(english)
    return rows.select("rec", F.explode(of).alias("f")).select("rec", "f.name", "f.md")


def _segments(rows: DataFrame, fields: list[Column], order: str) -> DataFrame:
    got = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*fields).alias("s"))))
    return rows.groupBy("rec").agg(F.transform(got, lambda x: x["s"]).alias("segments"))


# What the documents say of themselves.
DIARIZED_STATUS = "machine transcript requiring human review"
REVIEW_STATUS = "machine transcript; human review required"
TAGGED_STATUS = "parsed machine output; human review required"
REVIEW_NOTE = "Removed empty/zero-or-negative-duration segments and segments beyond the manually verified final spoken-content cutoff; no wording was corrected."
TAGGED_WARNING = "model_speaker_guess values are untrusted generated names, not verified speaker IDs; they drift within and across chunks"


def _times(rows: DataFrame) -> list[Column]:
    return [timefmt.exact(rows.columns, side).alias(side) for side in ("start", "end")]


def diarized_json(rows: DataFrame, notes: list[Column | str]) -> DataFrame:
    """rec, json: source, status, postprocessing (see review.notes), segments (seconds)."""
    fields = [*_times(rows), F.col("speaker"), F.col("original_speaker_id"), F.col("text")]
    told = F.array(*[F.lit(n) if isinstance(n, str) else n for n in notes])
    doc = F.struct(F.col("rec").cast("string").alias("source"), F.lit(DIARIZED_STATUS).alias("status"), told.alias("postprocessing"), F.col("segments"))
    return _segments(rows, fields, "ord").select("rec", F.to_json(doc, {"ignoreNullFields": "false"}).alias("json"))


def asr_json(kept: DataFrame, counters: DataFrame, cutoff_ms: int, note: str = REVIEW_NOTE) -> DataFrame:
    """rec, json: with counts and rejections; recordings of which nothing is kept have an empty list."""
    fields = [F.col("id"), *_times(kept), F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob")]
    rows = counters.join(_segments(kept, fields, "id"), "rec", "left")
    doc = F.struct(
        F.lit(REVIEW_STATUS).alias("status"),
        F.lit(False).alias("speaker_labels"),
        F.col("rec").cast("string").alias("source"),
        F.lit(cutoff_ms / 1000).alias("cutoff_seconds"),
        F.lit(note).alias("postprocessing"),
        F.col("source_segment_count"),
        F.col("segment_count"),
        F.struct("empty_text", "invalid_or_zero_duration", "after_cutoff").alias("rejected"),
        F.coalesce("segments", F.array()).alias("segments"),
    )
    return rows.select("rec", F.to_json(doc, {"ignoreNullFields": "false"}).alias("json"))


def tagged_json(rows: DataFrame, counts: DataFrame, texts: DataFrame, warning: str = TAGGED_WARNING) -> DataFrame:
    """rec, json of parsed records; counts: see tagged.guess_list; texts: rec, chunk, offset_s of every document, also of
    those without a record."""
    fields = [F.col(c) for c in ("id", "chunk", "relative_start", "relative_end", "absolute_start", "absolute_end", "model_speaker_guess", "text")]
    j = texts.select("rec", F.col("chunk").alias("_chunk"), F.col("offset_s").cast("double").alias("_offset")).join(_segments(rows, fields, "id"), "rec", "left").join(counts, "rec", "left")
    guesses = F.map_from_entries(F.transform(F.coalesce("speaker_guess_counts", F.array()), lambda x: F.struct(x["name"], x["n"])))
    segments = F.coalesce("segments", F.array())
    doc = F.struct(
        F.lit(TAGGED_STATUS).alias("status"),
        F.lit(warning).alias("warning"),
        F.col("rec").cast("string").alias("source"),
        F.col("_chunk").alias("chunk"),
        F.col("_offset").alias("offset_seconds"),
        F.size(segments).alias("segment_count"),
        guesses.alias("speaker_guess_counts"),
        segments.alias("segments"),
    )
    return j.select("rec", F.to_json(doc).alias("json"))


def labelled_json(rows: DataFrame) -> DataFrame:
    """rec, json of a speaker-labelled transcript: rec, ord, start_ms, end_ms, assigned, text."""
    fields = [*_times(rows), F.col("assigned").alias("speaker"), F.col("text")]
    return _segments(rows, fields, "ord").select("rec", F.to_json(F.struct("segments")).alias("json"))


def benchmark_json(metrics: DataFrame, segments: DataFrame, kind: str) -> DataFrame:
    """rec, json of a run over a recording: metrics, text (recognition only) and segments.

    metrics: rec and the fields of the document (see models.metrics); kind: recognition or diarization. Segments keep the
    declared fields that are there; a recording without segments has an empty list.
    """
    names = [f.name for f in T.StructType.fromDDL(schema.BENCHMARK if kind == "recognition" else schema.DIARIZATION)["metrics"].dataType]
    told = F.struct(*[F.col(c) for c in names]).alias("metrics")
    if kind == "recognition":
        keep = ("id", "start", "end", "text", "speaker_id", "temperature", "avg_logprob", "compression_ratio", "no_speech_prob")
        fields = [F.col(c) for c in keep if c in segments.columns]
    else:
        fields = [F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.col("speaker").cast("int").alias("speaker")]
    own = _segments(segments, fields, "ord")
    if kind == "recognition":
        own = own.join(_ordered(segments, F.coalesce("text", F.lit("")), "", "ord", "text"), "rec")
    j = metrics.join(own, "rec", "left").withColumn("segments", F.coalesce("segments", F.array()))
    doc = F.struct(told, F.coalesce("text", F.lit("")).alias("text"), "segments") if kind == "recognition" else F.struct(told, "segments")
    return j.select("rec", F.to_json(doc).alias("json"))


def words_json(words: DataFrame, audio: DataFrame) -> DataFrame:
    """rec, json of a word alignment and the audio it belongs to. words: rec, id (of the segment), ord, word, start, end;
    audio: rec, audio. A segment's text is its words; a recording without words has no segments."""
    one = F.struct("word", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    got = F.transform(F.array_sort(F.collect_list(F.struct("ord", one.alias("w")))), lambda x: x["w"])
    by_segment = words.groupBy("rec", "id").agg(got.alias("words"))
    text = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    rows = audio.join(_segments(by_segment, [F.col("id").cast("bigint").alias("id"), text.alias("text"), F.col("words")], "id"), "rec", "left")
    return rows.select("rec", F.to_json(F.struct("audio", F.coalesce("segments", F.array()).alias("segments"))).alias("json"))


def manifest_json(chunks: DataFrame) -> DataFrame:
    """rec, json of a chunk plan; transcripts.manifest reads it."""
    sec = lambda c: timefmt.to_seconds(F.col(c))
    one = F.struct("chunk", sec("dec_lo_ms").alias("decoded_start"), sec("dec_hi_ms").alias("decoded_end"), sec("core_lo_ms").alias("core_start"), sec("core_hi_ms").alias("core_end"), "fallback")
    got = F.array_sort(F.collect_list(F.struct("chunk", one.alias("c"))))
    return chunks.groupBy("rec").agg(F.to_json(F.struct(F.transform(got, lambda x: x["c"]).alias("chunks"))).alias("json"))


def compact_json(segments: DataFrame, order: str = "ord") -> DataFrame:
    """rec, ord, json of the declared segment fields; what is null is left out."""
    keep = ("id", "start", "end", "text", "speaker_id", "temperature", "avg_logprob", "compression_ratio", "no_speech_prob")
    return segments.select("rec", order, F.to_json(F.struct(*[c for c in keep if c in segments.columns])).alias("json"))


def write_documents(texts: DataFrame, column: str, path: str, overwrite: bool = False) -> None:
    """Texts to files under path, one folder per recording; fails if path is there unless overwrite is asked for.

    The writer ends every text with a line end, so a text's own last one is left to it.
    """
    out = texts.select(F.col("rec").cast("string").alias("rec"), F.regexp_replace(column, r"\n\z", "").alias("value"))
    out.write.mode("overwrite" if overwrite else "errorifexists").partitionBy("rec").text(path)


def write_chunks(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rows of all chunks as JSON lines, foldered by recording and chunk."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").partitionBy("rec", "chunk").json(path)


def sibling(path: str, suffix: str) -> str:
    """The path with its last suffix replaced; a prefix with a dot in its name loses what follows the dot."""
    head, slash, name = path.rpartition("/")
    stem = name[: name.rfind(".")] if name.rfind(".") > 0 else name
    return f"{head}{slash}{stem}{suffix}"
