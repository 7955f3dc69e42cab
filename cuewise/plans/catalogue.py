"""The query catalogue over the driver's tables, each with SQL for the same rows where SQL can express it.

Some queries read no table, as no table holds what they are about (absent fields, private hosts, published measurements,
reviewed documents): optional_fields, exact_times, exact_cutoff, srt_null_speaker, private_host_flag, metrics_rtf,
render_bilingual, run_totals and compact_segments are checks of a contract on literal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import textnorm, timefmt, urls
from ..operators import chunking, disagree, intervals, quality, review, tagged
from ..sources import fixtures as fx
from ..sources import models, transcripts
from . import render

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CUTOFF = 60_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


CLOCK = "printf('%02d:%02d:%02d{m}%03d', greatest({t}, 0) // 3600000, greatest({t}, 0) // 60000 % 60, greatest({t}, 0) // 1000 % 60, greatest({t}, 0) % 1000)"
VERDICT = f"""CASE WHEN trim(text) = '' THEN 'empty_text' WHEN end_ms <= start_ms THEN 'invalid_or_zero_duration'
  WHEN end_ms > {CUTOFF} THEN 'after_cutoff' ELSE 'kept' END"""


def clock_sql(t: str, mark: str) -> str:
    return CLOCK.format(t=t, m=mark)


# Scans


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, start_ms, end_ms, speaker, text FROM seg")
def segments_scan(spark: SparkSession, d: str) -> DataFrame:
    return fx.seg(spark, d)


@query(f"WITH {fx.SQL_TURNS} SELECT rec, ord, start_ms, end_ms, speaker FROM turns")
def turns_scan(spark, d):
    return fx.turns(spark, d)


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, start_ms, end_ms, speaker, text FROM seg")
def transcript_json_roundtrip(spark, d):
    """Segments nested into one JSON document a recording and scanned again by the declared schema."""
    s = F.struct(timefmt.to_seconds(F.col("start_ms")).alias("start"), timefmt.to_seconds(F.col("end_ms")).alias("end"), F.col("speaker").alias("speaker_id"), "text")
    got = F.array_sort(F.collect_list(F.struct("ord", s.alias("s"))))
    docs = fx.seg(spark, d).groupBy("rec").agg(F.to_json(F.struct(F.transform(got, lambda x: x["s"]).alias("segments"))).alias("json"))
    parsed = docs.select("rec", F.from_json("json", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
    return transcripts.diarized_segments(parsed).select("rec", "ord", "start_ms", "end_ms", "speaker", "text")


def blobs(spark, d) -> DataFrame:
    """seg as tagged text, one a recording; brackets and colons in the words stay out of the names."""
    one = F.concat(F.lit("["), (F.col("start_ms") / 1000).cast("decimal(18,3)").cast("string"), F.lit("]"), F.col("speaker"), F.lit(": "), F.regexp_replace("text", r"\[\d", "("), F.lit("["), (F.col("end_ms") / 1000).cast("decimal(18,3)").cast("string"), F.lit("]"))
    return render._ordered(fx.seg(spark, d), one, "\n", "ord", "text")


TAGGED_SQL = f"""
WITH {fx.SQL_SEG}, x AS (
  SELECT rec, (ord + 1)::BIGINT AS id, start_ms / 1000.0 AS relative_start, end_ms / 1000.0 AS relative_end,
    speaker AS model_speaker_guess,
    trim(regexp_replace(regexp_replace(text, '\\[\\d', '(', 'g'), '\\s+', ' ', 'g')) AS text FROM seg
)"""


@query(f"{TAGGED_SQL} SELECT rec, id, relative_start, relative_end, model_speaker_guess, text FROM x")
def tagged_extract(spark, d):
    return tagged.extract(transcripts.tagged_texts(blobs(spark, d))).select("rec", "id", "relative_start", "relative_end", "model_speaker_guess", "text")


@query(f"{TAGGED_SQL} SELECT rec, id, relative_start + rec * 10.0::DOUBLE AS absolute_start, relative_end + rec * 10.0::DOUBLE AS absolute_end FROM x")
def tagged_offset(spark, d):
    return tagged.extract(blobs(spark, d), offset_s=F.col("rec") * F.lit(10.0)).select("rec", "id", "absolute_start", "absolute_end")


@query(f"WITH {fx.SQL_SEG} SELECT rec, speaker, count(*)::BIGINT AS n, min(ord)::BIGINT AS first_ord FROM seg GROUP BY rec, speaker")
def guess_counts(spark, d):
    return tagged.guess_counts(fx.seg(spark, d), "speaker", "ord")


# Filters, routing, remapping


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, CASE WHEN ord = 0 THEN 7540 ELSE start_ms END::BIGINT AS start_ms, end_ms, CASE speaker WHEN 'user' THEN 'Guest' WHEN 'assistant' THEN 'Host' ELSE speaker END AS speaker, speaker AS original_speaker_id FROM seg WHERE start_ms < {CUTOFF}")
def cutoff_by_start(spark, d):
    names = {"user": "Guest", "assistant": "Host"}
    return review.diarized(fx.seg(spark, d), CUTOFF, names=names).select("rec", "ord", "start_ms", "end_ms", "speaker", "original_speaker_id")


@query(f"WITH {fx.SQL_DIRTY} SELECT rec, ord, start_ms, end_ms FROM dirty WHERE end_ms <= {CUTOFF}")
def cutoff_by_end(spark, d):
    return fx.seg_dirty(spark, d).where(F.col("end_ms") <= CUTOFF).select("rec", "ord", "start_ms", "end_ms")


@query(f"WITH {fx.SQL_DIRTY} SELECT rec, ord, {VERDICT} AS verdict FROM dirty")
def reject_routing(spark, d):
    return review.route(fx.seg_dirty(spark, d), CUTOFF).select("rec", "ord", "verdict")


@query(f"""WITH {fx.SQL_DIRTY}, v AS (SELECT rec, {VERDICT} AS v FROM dirty)
SELECT rec, count(*)::BIGINT AS source_segment_count, count(*) FILTER (WHERE v = 'kept')::BIGINT AS segment_count,
  count(*) FILTER (WHERE v = 'empty_text')::BIGINT AS empty_text,
  count(*) FILTER (WHERE v = 'invalid_or_zero_duration')::BIGINT AS invalid_or_zero_duration,
  count(*) FILTER (WHERE v = 'after_cutoff')::BIGINT AS after_cutoff FROM v GROUP BY rec""")
def reject_counters_wide(spark, d):
    return review.counters(review.route(fx.seg_dirty(spark, d), CUTOFF))


@query(f"""WITH {fx.SQL_DIRTY}, v AS (SELECT *, {VERDICT} AS v FROM dirty)
SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY ord)::BIGINT AS id, ord, start_ms, end_ms, speaker, trim(text) AS text,
  {clock_sql('start_ms', ',')} || ' --> ' || {clock_sql('end_ms', ',')} AS span FROM v WHERE v = 'kept'""")
def kept_renumbered(spark, d):
    kept = review.kept(review.route(fx.seg_dirty(spark, d), CUTOFF))
    span = F.concat(timefmt.srt_clock(F.col("start_ms")), F.lit(" --> "), timefmt.srt_clock(F.col("end_ms")))
    return kept.select("rec", "id", "ord", "start_ms", "end_ms", "speaker", "text", span.alias("span"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, CASE speaker WHEN 'user' THEN 'Guest' WHEN 'assistant' THEN 'Host' ELSE speaker END AS speaker, speaker AS original_speaker_id FROM seg")
def speaker_remap(spark, d):
    names = spark.createDataFrame([("user", "Guest"), ("assistant", "Host")], "id string, display_name string")
    return review.remap_by(fx.seg(spark, d), names, rec=False).select("rec", "ord", "speaker", "original_speaker_id")


@query("""SELECT * FROM (VALUES (0::BIGINT, NULL::BIGINT, 2000::BIGINT, '', NULL::DOUBLE, 'empty_text'),
 (1, 0, 1000, 'a', -0.5, 'kept'), (2, 2000, 0, 'b', NULL, 'invalid_or_zero_duration'), (3, 500, NULL, 'c', NULL, 'invalid_or_zero_duration'))
 t(ord, start_ms, end_ms, text, avg_logprob, verdict)""")
def optional_fields(spark, d):
    """Absent, null and NaN fields of a literal document."""
    text = '{"segments":[{"start":NaN,"end":2.0},{"end":1.0,"text":"a","avg_logprob":-0.5},{"start":2.0,"end":null,"text":"b"},{"start":0.5,"end":NaN,"text":"c"}]}'
    docs = spark.createDataFrame([("one", text)], "rec string, json string").select("rec", F.from_json("json", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
    return review.route(transcripts.asr_segments(docs)).select("ord", "start_ms", "end_ms", "text", "avg_logprob", "verdict")


@query("""SELECT * FROM (VALUES (0::BIGINT, 1.0001::DOUBLE, 1.0004::DOUBLE, 'kept'), (1, 4809.0, 4809.5004, 'after_cutoff'), (2, 4809.0, 4809.5, 'kept'),
 (3, 7.0004, 7.0001, 'invalid_or_zero_duration')) t(ord, start_s, end_s, verdict)""")
def exact_times(spark, d):
    """Times that differ by less than a millisecond."""
    text = '{"segments":[{"start":1.0001,"end":1.0004,"text":"a"},{"start":4809.0,"end":4809.5004,"text":"b"},{"start":4809.0,"end":4809.5,"text":"c"},{"start":7.0004,"end":7.0001,"text":"d"}]}'
    docs = spark.createDataFrame([("one", text)], "rec string, json string").select("rec", F.from_json("json", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
    return review.route(transcripts.asr_segments(docs)).select("ord", "start_s", "end_s", "verdict")


@query("SELECT * FROM (VALUES (0::BIGINT, 7.54::DOUBLE, 9.00049::DOUBLE, 'UNKNOWN'), (1, 2157.9996, 2159.0, '万国')) t(ord, start_s, end_s, speaker)")
def exact_cutoff(spark, d):
    text = '{"segments":[{"start":0,"end":9.00049,"text":"[S01] a"},{"start":2157.9996,"end":2159.0,"speaker_id":"S03","text":"b"},{"start":2158.0,"end":2159.0,"text":"c"}]}'
    docs = spark.createDataFrame([("one", text)], "rec string, json string").select("rec", F.from_json("json", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
    return review.diarized(transcripts.diarized_segments(docs)).select("ord", "start_s", "end_s", "speaker")


# Scalar functions


@query(f"WITH {fx.SQL_DIRTY} SELECT rec, ord, {clock_sql('end_ms', ',')} AS clock FROM dirty")
def timecode_srt(spark, d):
    return fx.seg_dirty(spark, d).select("rec", "ord", timefmt.srt_clock(F.col("end_ms")).alias("clock"))


@query(f"WITH {fx.SQL_TURNS}, s AS (SELECT rec, ord, start_ms / 1000.0 + 0.0005 AS t FROM turns) SELECT rec, ord, {clock_sql('round_even(t * 1000, 0)::BIGINT', '.')} AS clock FROM s")
def timecode_dot(spark, d):
    t = F.col("start_ms") / F.lit(1000.0) + F.lit(0.0005)
    return fx.turns(spark, d).select("rec", "ord", timefmt.clock(timefmt.to_ms(t)).alias("clock"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, CASE WHEN ord % 3 = 2 THEN '[x] ' || trim(text) ELSE trim(text) END AS text FROM seg")
def strip_speaker_tag(spark, d):
    tag = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("[S0"), F.col("ord").cast("string"), F.lit("]　 "))).when(F.col("ord") % 3 == 1, "").otherwise("[x] ")
    return fx.seg(spark, d).select("rec", "ord", textnorm.strip_speaker_tag(F.concat(tag, "text", F.lit(" "))).alias("text"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM seg")
def whitespace_collapse(spark, d):
    return fx.seg(spark, d).select("rec", "ord", textnorm.collapse(F.regexp_replace("text", " ", "　 \t")).alias("text"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, ord, list_filter(regexp_split_to_array(trim(regexp_replace(lower(text), '[\\p{{P}}\\p{{S}}]', '', 'g')), '\\s+'), lambda x: x <> '') AS words FROM seg")
def word_normalize(spark, d):
    return fx.seg(spark, d).select("rec", "ord", textnorm.words(F.col("text")).alias("words"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, count(*) FILTER (WHERE ord % 5 = 0)::BIGINT AS n_uncertain FROM seg GROUP BY rec")
def uncertainty_markers(spark, d):
    marked = F.when(F.col("ord") % 5 == 0, F.concat("text", F.lit(" [inaudible]"))).otherwise(F.concat("text", F.lit(" [sic]")))
    return fx.seg(spark, d).withColumn("text", marked).groupBy("rec").agg(F.sum(textnorm.uncertain_count(F.col("text"))).alias("n_uncertain"))


@query("""SELECT page_id, regexp_replace(url, '^([a-z]+://)([^?#]*).*$', '\\1\\2') AS shown, url SIMILAR TO '[^#?]*\\?.*' AS query_redacted,
 sha256(url) AS sha256, strlen(url)::INTEGER AS bytes FROM pages""")
def url_redact(spark, d):
    u = F.col("url")
    return fx.read(spark, d, "pages").select("page_id", urls.redacted(u).alias("shown"), urls.query_redacted(u).alias("query_redacted"), urls.fingerprint(u).alias("sha256"), F.octet_length(u).alias("bytes"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, false AS is_private FROM pages")
def url_host(spark, d):
    return fx.read(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.is_private(F.col("url")).alias("is_private"))


@query("""SELECT * FROM (VALUES ('http://127.0.0.1/a', true), ('https://u:p@10.1.2.3:80/x?q', true), ('http://[::1]/', true), ('http://172.31.0.9/', true),
 ('http://172.32.0.9/', false), ('https://example.com:8443/p', false), ('http://localhost:9/', true), ('no url', true)) t(url, is_private)""")
def private_host_flag(spark, d):
    rows = [(u,) for u in ("http://127.0.0.1/a", "https://u:p@10.1.2.3:80/x?q", "http://[::1]/", "http://172.31.0.9/", "http://172.32.0.9/", "https://example.com:8443/p", "http://localhost:9/", "no url")]
    return spark.createDataFrame(rows, "url string").withColumn("is_private", urls.is_private(F.col("url")))


# Published measurements (model, mode, seconds of audio, seconds of inference).
PUBLISHED = [("whisper-turbo", "whisper", 4822.152, 150.18), ("moss", "moss", 4822.152, 887.17), ("moss-chunks", "moss", 4822.152, 809.24)]


@query("""SELECT model, infer_s / audio_s AS rtf, audio_s / infer_s AS speed FROM (VALUES ('whisper-turbo', 4822.152::DOUBLE, 150.18::DOUBLE),
 ('moss', 4822.152, 887.17), ('moss-chunks', 4822.152, 809.24)) t(model, audio_s, infer_s)""")
def metrics_rtf(spark, d):
    return models.with_speed(spark.createDataFrame(PUBLISHED, "model string, mode string, audio_s double, infer_s double")).select("model", "rtf", "speed")


# Documents


@query(f"""WITH {fx.SQL_SEG}, c AS (SELECT rec, ord + 1 AS id, (ord + 1) || chr(10) || {clock_sql('start_ms', ',')} || ' --> ' || {clock_sql('end_ms', ',')} || chr(10) || speaker || '：' || text || chr(10) || chr(10) AS cue FROM seg)
SELECT rec, string_agg(cue, '' ORDER BY id) AS srt FROM c GROUP BY rec""")
def srt_with_speakers(spark, d):
    return render.srt_with_speakers(fx.seg(spark, d).withColumn("id", F.col("ord") + 1))


@query(f"""WITH {fx.SQL_SEG}, c AS (SELECT rec, ord + 1 AS id, (ord + 1) || chr(10) || {clock_sql('start_ms', ',')} || ' --> ' || {clock_sql('end_ms', ',')} || chr(10) || text AS cue FROM seg)
SELECT rec, string_agg(cue, chr(10) || chr(10) ORDER BY id) || chr(10) AS srt FROM c GROUP BY rec""")
def srt_document(spark, d):
    return render.srt_plain(fx.seg(spark, d).withColumn("id", F.col("ord") + 1))


@query("""SELECT 'r' AS rec, '1' || chr(10) || '00:00:00,000 --> 00:00:01,000' || chr(10) || 'UNKNOWN：a' || chr(10) || chr(10) || '2' || chr(10)
 || '00:00:01,000 --> 00:00:02,000' || chr(10) || 'B：' || chr(10) || chr(10) AS srt""")
def srt_null_speaker(spark, d):
    """No cue and no number is lost for want of a speaker or a text."""
    rows = [("r", 1, 0, 1000, None, "a"), ("r", 2, 1000, 2000, "B", None)]
    return render.srt_with_speakers(spark.createDataFrame(rows, "rec string, id bigint, start_ms bigint, end_ms bigint, speaker string, text string"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, (ord + 1)::BIGINT AS id, start_ms, end_ms, speaker || '：' || trim(text) AS text FROM seg WHERE trim(text) <> ''")
def srt_reader_roundtrip(spark, d):
    rows = fx.seg(spark, d).where(textnorm.strip(F.col("text")) != "").withColumn("id", F.col("ord") + 1).withColumn("text", textnorm.strip(F.col("text")))
    return transcripts.srt_cues(render.srt_with_speakers(rows).withColumnRenamed("srt", "text"))


@query(f"WITH {fx.SQL_SEG} SELECT rec, string_agg(text, chr(10) || chr(10) ORDER BY ord) || chr(10) AS md FROM seg GROUP BY rec")
def markdown_document(spark, d):
    return render.raw_markdown(fx.seg(spark, d))


@query(f"WITH {fx.SQL_SEG} SELECT rec, '# T' || chr(10) || chr(10) || '> N' || chr(10) || chr(10) || string_agg('**' || speaker || '：** ' || text || chr(10) || chr(10), '' ORDER BY ord) AS md FROM seg GROUP BY rec")
def speaker_markdown(spark, d):
    return render.speaker_markdown(fx.seg(spark, d), "T", "N", "ord")


@query(f"WITH {fx.SQL_SEG} SELECT rec, '# T' || chr(10) || chr(10) || '> N' || chr(10) || chr(10) || string_agg(text, chr(10) ORDER BY ord) || chr(10) AS md FROM seg GROUP BY rec")
def content_markdown(spark, d):
    return render.content_markdown(fx.seg(spark, d), "T", "N", "ord")


@query(f"WITH {fx.SQL_SEG} SELECT rec, max(ord) >= 10 AS has_timecode FROM seg GROUP BY rec")
def no_timecode_gate(spark, d):
    """Every tenth line gets a clock, so that the gate finds some."""
    mixed = F.when(F.col("ord") == 10, F.concat("text", F.lit(" 00:01:02,500 "))).otherwise(F.col("text"))
    return render.raw_markdown(fx.seg(spark, d).withColumn("text", mixed)).select("rec", textnorm.has_timecode(F.col("md")).alias("has_timecode"))


#: Two speakers, one of them without a name, a segment whose speaker is not listed, and nothing unresolved.
REVIEWED_ROW = """{"metadata":{"title":"Weather, part 2","source_file":"w2.flac","source_language":"en"},
"speakers":[{"id":"A","display_name":"Ana","confidence":"high","evidence":"Says her name."},{"id":"B"}],
"segments":[{"start":0.5,"end":2.0,"speaker":"A","source":"rain to day","calibrated":"Rain today.","zh":"今天有雨。"},
{"start":2.0,"end":3.25,"speaker":"B","source":"how mutch","calibrated":"How much?","zh":"多少？","uncertain":true},
{"start":3.25,"end":4.0,"speaker":"C","source":"ten","calibrated":"Ten.","zh":"十。","uncertain":false}],
"unresolved":null}"""
_LINES = "'# Weather, part 2' || chr(10) || chr(10) || '**Ana：** {}' || chr(10) || chr(10) || '**B：** {}' || chr(10) || chr(10) || '**C：** {}' || chr(10)"
_TWO = "{}' || chr(10) || chr(10) || '{}"


@query(f"""SELECT 'one' AS rec, name, md FROM (VALUES
 ('source', {_LINES.format('rain to day', 'how mutch', 'ten')}), ('en', {_LINES.format('Rain today.', 'How much?', 'Ten.')}),
 ('zh', {_LINES.format('今天有雨。', '多少？', '十。')}),
 ('bilingual', {_LINES.format(_TWO.format('Rain today.', '今天有雨。'), _TWO.format('How much?', '多少？'), _TWO.format('Ten.', '十。'))}),
 ('review', {_LINES.format('Rain today.', 'How much? [?]', 'Ten.')} || chr(10) || '## Speakers' || chr(10) || chr(10) || '- Ana (high): Says her name.' || chr(10)
   || '- B (unknown): ' || chr(10) || chr(10) || '## Unresolved' || chr(10) || chr(10))) t(name, md)""")
def render_bilingual(spark, d):
    docs = spark.createDataFrame([("one", REVIEWED_ROW)], "rec string, json string").select("rec", F.from_json("json", schema.REVIEWED).alias("j")).select("rec", "j.*")
    return render.final_markdown(docs)


# JSON documents, scanned again by their declared schemas.


def parsed(docs: DataFrame, kind: str) -> DataFrame:
    return docs.select("rec", F.from_json("json", kind).alias("j")).select("rec", "j.*")


@query(f"""WITH {fx.SQL_DIRTY}, v AS (SELECT *, {VERDICT} AS v FROM dirty), k AS (SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY ord)::BIGINT AS id, start_ms / 1000.0::DOUBLE AS "start",
  end_ms / 1000.0::DOUBLE AS "end", trim(text) AS text FROM v WHERE v = 'kept'), c AS (
  SELECT rec, count(*)::BIGINT AS source_segment_count, count(*) FILTER (WHERE v = 'kept')::BIGINT AS segment_count, count(*) FILTER (WHERE v = 'empty_text')::BIGINT AS empty_text,
    count(*) FILTER (WHERE v = 'invalid_or_zero_duration')::BIGINT AS invalid_or_zero_duration, count(*) FILTER (WHERE v = 'after_cutoff')::BIGINT AS after_cutoff FROM v GROUP BY rec)
SELECT c.*, c.rec::VARCHAR AS source, '{render.REVIEW_STATUS}' AS status, false AS speaker_labels, 60.0::DOUBLE AS cutoff_seconds, '{render.REVIEW_NOTE}' AS postprocessing, k.id, k."start", k."end", k.text
FROM c LEFT JOIN k ON c.rec = k.rec""")
def review_payload_json(spark, d):
    none = F.lit(None).cast("double")
    routed = review.route(fx.seg_dirty(spark, d).withColumn("avg_logprob", none).withColumn("no_speech_prob", none), CUTOFF)
    docs = parsed(render.asr_json(review.kept(routed), review.counters(routed), CUTOFF), schema.REVIEW)
    rows = docs.select("*", "rejected.*", F.explode_outer("segments").alias("s")).drop("segments", "rejected")
    return rows.select("*", "s.id", "s.start", "s.end", "s.text").drop("s")


@query(f"""WITH {fx.SQL_SEG}, k AS (SELECT *, (row_number() OVER (PARTITION BY rec ORDER BY ord) - 1)::INTEGER AS pos FROM seg WHERE start_ms < {CUTOFF})
SELECT rec, rec::VARCHAR AS source, '{render.DIARIZED_STATUS}' AS status, '{"|".join(review.MAPPED)}|{review.STARTED[0]}7.540{review.STARTED[1]}|{review.DISCARDED[0]}60.000{review.DISCARDED[1]}' AS notes,
  pos, CASE WHEN ord = 0 THEN 7.54 ELSE start_ms / 1000.0 END::DOUBLE AS "start", end_ms / 1000.0::DOUBLE AS "end", speaker, speaker AS original_speaker_id, trim(text) AS text FROM k""")
def diarized_payload_json(spark, d):
    docs = parsed(render.diarized_json(review.diarized(fx.seg(spark, d), CUTOFF), review.notes(cutoff_ms=CUTOFF)), schema.DIARIZED)
    return docs.select("rec", "source", "status", F.array_join("postprocessing", "|").alias("notes"), F.posexplode("segments").alias("pos", "s")).select("*", "s.*").drop("s")


@query(f"""{TAGGED_SQL}, n AS (SELECT rec, model_speaker_guess, count(*)::BIGINT AS n_guess FROM x GROUP BY ALL)
SELECT rec, rec::VARCHAR AS source, '{render.TAGGED_STATUS}' AS status, '{render.TAGGED_WARNING}' AS warning, '7' AS chunk, 10.0::DOUBLE AS offset_seconds,
  count(*) OVER (PARTITION BY rec)::BIGINT AS segment_count, id, relative_start, relative_end, relative_start + 10.0::DOUBLE AS absolute_start, relative_end + 10.0::DOUBLE AS absolute_end, model_speaker_guess, text, n_guess
FROM x JOIN n USING (rec, model_speaker_guess)""")
def tagged_payload_json(spark, d):
    texts = blobs(spark, d).withColumn("chunk", F.lit("7")).withColumn("offset_s", F.lit(10.0))
    rows = tagged.extract(texts, F.col("offset_s"), F.col("chunk"))
    docs = parsed(render.tagged_json(rows, tagged.guess_list(tagged.guess_counts(rows)), texts), schema.TAGGED)
    out = docs.select("rec", "source", "status", "warning", "chunk", "offset_seconds", "segment_count", "speaker_guess_counts", F.explode("segments").alias("s"))
    fields = ("id", "relative_start", "relative_end", "absolute_start", "absolute_end", "model_speaker_guess", "text")
    return out.select("*", *[f"s.{c}" for c in fields], F.col("speaker_guess_counts")[F.col("s.model_speaker_guess")].alias("n_guess")).drop("s", "speaker_guess_counts")


def _run(spark, d, turns: bool) -> tuple[DataFrame, DataFrame]:
    """A run over every recording: its rows as a model source gives them, and the recordings."""
    own = fx.turns(spark, d) if turns else fx.seg(spark, d).withColumn("speaker", F.lit(None).cast("string"))
    rec = F.col("rec").cast("string")
    number = F.dense_rank().over(Window.partitionBy("rec").orderBy("speaker")) - 1
    text = [] if turns else ["text"]
    rows = own.select(rec.alias("rec"), "ord", timefmt.to_seconds(F.col("start_ms")).alias("start"), timefmt.to_seconds(F.col("end_ms")).alias("end"), (number.cast("string") if turns else F.col("speaker")).alias("speaker"), *text)
    once = rows.groupBy("rec").agg(F.max("end").alias("audio_s"))
    run = once.select("rec", F.lit(1.5).alias("load_s"), (F.col("audio_s") / 8).alias("infer_s"), F.lit(2.0).alias("peak_gb"), F.lit(7).cast("bigint").alias("prompt_tokens"), F.lit(9).cast("bigint").alias("generation_tokens"))
    return rows.unionByName(run, allowMissingColumns=True), once


TIMES_SQL = """audio_duration_seconds, 1.5::DOUBLE AS load_seconds, audio_duration_seconds / 8 AS inference_seconds, 1.5 + audio_duration_seconds / 8 AS wall_seconds,
  (audio_duration_seconds / 8) / audio_duration_seconds AS realtime_factor, audio_duration_seconds / (audio_duration_seconds / 8) AS realtime_speed, 2.0::DOUBLE AS peak_mlx_memory_gb"""


@query(f"""WITH {fx.SQL_SEG}, r AS (SELECT rec, max(end_ms) / 1000.0::DOUBLE AS audio_duration_seconds, count(*)::BIGINT AS segment_count, string_agg(text, '' ORDER BY ord) AS text,
  sum(start_ms / 1000.0::DOUBLE) AS sum_start, max(end_ms) / 1000.0::DOUBLE AS last_end FROM seg GROUP BY rec)
SELECT rec::VARCHAR AS rec, 'whisper' AS mode, 'm' AS model, rec::VARCHAR AS audio, {TIMES_SQL}, 7::BIGINT AS prompt_tokens, 9::BIGINT AS generation_tokens, segment_count, text, round(sum_start, 3) AS sum_start, last_end FROM r""")
def benchmark_payload_json(spark, d):
    rows, files = _run(spark, d, False)
    docs = parsed(render.benchmark_json(models.metrics(rows, files, "m", "whisper"), models.segments(rows), "recognition"), schema.BENCHMARK)
    sums = F.aggregate("segments", F.lit(0.0), lambda a, s: a + s["start"])
    return docs.select("rec", "metrics.*", "text", F.round(sums, 3).alias("sum_start"), F.array_max(F.transform("segments", lambda s: s["end"])).alias("last_end"))


@query(f"""WITH {fx.SQL_TURNS}, n AS (SELECT *, (dense_rank() OVER (PARTITION BY rec ORDER BY speaker) - 1)::INTEGER AS s FROM turns),
r AS (SELECT rec, max(end_ms) / 1000.0::DOUBLE AS audio_duration_seconds, count(*)::BIGINT AS segment_count, count(DISTINCT s)::BIGINT AS num_speakers FROM n GROUP BY rec)
SELECT rec::VARCHAR AS rec, 'm' AS model, {TIMES_SQL}, num_speakers, segment_count, 0.5::DOUBLE AS threshold, 0.25::DOUBLE AS min_duration, 0.2::DOUBLE AS merge_gap,
  n.start_ms / 1000.0::DOUBLE AS "start", n.end_ms / 1000.0::DOUBLE AS "end", n.s AS speaker FROM r JOIN n USING (rec)""")
def diarization_payload_json(spark, d):
    rows, files = _run(spark, d, True)
    docs = parsed(render.benchmark_json(models.metrics(rows, files, "m"), models.segments(rows), "diarization"), schema.DIARIZATION)
    return docs.select("rec", "metrics.*", F.explode("segments").alias("s")).select("*", "s.*").drop("s")


@query(f"""WITH {fx.SQL_SEG}, w AS (SELECT rec, ord + 1 AS id, start_ms, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS words FROM seg WHERE trim(text) <> '')
SELECT rec, rec || '.wav' AS audio, id, array_to_string(words, ' ') AS text, len(words)::INTEGER AS n_words, start_ms / 1000.0::DOUBLE AS first_start, words[-1] AS last_word FROM w""")
def word_alignment_json(spark, d):
    """Words timed a tenth of a second apart, nested by segment beside the name of their audio."""
    seg = fx.seg(spark, d).withColumn("text", textnorm.collapse(F.col("text"))).where("text <> ''")
    each = seg.select("rec", (F.col("ord") + 1).alias("id"), "start_ms", F.posexplode(F.split("text", " ")).alias("ord", "word"))
    start = timefmt.to_seconds(F.col("start_ms")) + F.col("ord") * 0.1
    words = each.select("rec", "id", "ord", "word", start.alias("start"), (start + 0.1).alias("end"))
    audio = seg.select("rec").distinct().withColumn("audio", F.concat(F.col("rec").cast("string"), F.lit(".wav")))
    docs = parsed(render.words_json(words, audio), schema.WORDS)
    s = docs.select("rec", "audio", F.explode("segments").alias("s"))
    return s.select("rec", "audio", "s.id", "s.text", F.size("s.words").alias("n_words"), F.col("s.words")[0]["start"].alias("first_start"), F.element_at("s.words", -1)["word"].alias("last_word"))


# Intervals

OWNED = f"""WITH {fx.SQL_GRID}
SELECT t.rec, t.ord, g.chunk FROM turns t JOIN grid g ON t.rec = g.rec
 AND t.start_ms + t.end_ms >= 2 * g.core_lo_ms AND (t.start_ms + t.end_ms < 2 * g.core_hi_ms OR (g.chunk = 57 AND t.start_ms + t.end_ms = 2 * g.core_hi_ms))"""


@query(OWNED)
def midpoint_ownership(spark, d):
    return intervals.owned(fx.turns(spark, d), fx.grid(spark, d)).select("rec", "ord", "chunk")


@query(OWNED)
def overlap_context_merge(spark, d):
    """Turns decoded by every chunk that hears them, each kept once."""
    g = fx.grid(spark, d)
    return intervals.merge_chunks(intervals.decoded(fx.turns(spark, d), g), g).select("rec", "ord", "chunk")


EVEN_ODD = f"""WITH {fx.SQL_TURNS}, a AS (SELECT * FROM turns WHERE ord % 2 = 0), b AS (SELECT * FROM turns WHERE ord % 2 = 1),
p AS (SELECT a.rec, a.ord, b.ord AS r_ord, b.speaker AS r_speaker, (least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms))::BIGINT AS overlap_ms
  FROM a JOIN b ON a.rec = b.rec AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms)"""


@query(f"{EVEN_ODD} SELECT rec, ord, r_ord, overlap_ms FROM p")
def bucketed_overlap(spark, d):
    t = fx.turns(spark, d)
    return intervals.overlap_join(t.where("ord % 2 = 0"), t.where("ord % 2 = 1")).select("rec", "ord", "r_ord", "overlap_ms")


@query(f"""{EVEN_ODD}, s AS (SELECT rec, ord, r_speaker, sum(overlap_ms)::BIGINT AS covered_ms FROM p GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY rec, ord ORDER BY covered_ms DESC, r_speaker) AS n FROM s)
SELECT a.rec, a.ord, coalesce(r.r_speaker, 'UNKNOWN') AS assigned, coalesce(r.covered_ms, 0)::BIGINT AS covered_ms
FROM a LEFT JOIN r ON a.rec = r.rec AND a.ord = r.ord AND r.n = 1""")
def assign_speakers(spark, d):
    t = fx.turns(spark, d)
    return intervals.assign_speakers(t.where("ord % 2 = 0"), t.where("ord % 2 = 1")).select("rec", "ord", "assigned", "covered_ms")


def _labelled(spark, d) -> DataFrame:
    """Turns as each chunk of a grid with 120 s of context hears them, with that chunk's own labels."""
    heard = intervals.decoded(fx.turns(spark, d), fx.grid(spark, d, context_ms=120_000))
    return chunking.anonymous_labels(heard)


HEARD = f"""WITH {fx.SQL_TURNS}, heard AS (
  SELECT t.*, i::BIGINT AS chunk FROM turns t, range(58) r(i)
  WHERE t.start_ms + t.end_ms >= 2 * greatest(i * 1500000 - 120000, 0) AND t.start_ms + t.end_ms < 2 * (i * 1500000 + 1620000)
), first AS (SELECT rec, chunk, speaker, min(start_ms) AS f FROM heard GROUP BY ALL),
named AS (SELECT rec, chunk, speaker, printf('SPK%02d', dense_rank() OVER (PARTITION BY rec, chunk ORDER BY f, speaker)) AS label FROM first),
l AS (SELECT heard.*, named.label FROM heard JOIN named USING (rec, chunk, speaker))"""


@query(f"{HEARD} SELECT rec, chunk, ord, label FROM l")
def anonymous_labels(spark, d):
    return _labelled(spark, d).select("rec", "chunk", "ord", "label")


MATCHED = f"""{HEARD}, s AS (
  SELECT a.rec, a.chunk, b.chunk AS next_chunk, a.label, b.label AS next_label, sum(least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms))::BIGINT AS shared_ms
  FROM l a JOIN l b ON a.rec = b.rec AND b.chunk = a.chunk + 1 AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms GROUP BY ALL
), m AS (
  SELECT *, row_number() OVER (PARTITION BY rec, chunk, label ORDER BY shared_ms DESC, next_label) AS x,
    row_number() OVER (PARTITION BY rec, next_chunk, next_label ORDER BY shared_ms DESC, label) AS y FROM s
), pairs AS (SELECT rec, chunk, next_chunk, label, next_label, shared_ms FROM m WHERE x = 1 AND y = 1 AND shared_ms >= 1000)"""


@query(f"{MATCHED} SELECT * FROM pairs")
def label_reconcile(spark, d):
    return chunking.matched_labels(_labelled(spark, d))


@query(MATCHED.replace("WITH", "WITH RECURSIVE", 1) + """, nodes AS (SELECT DISTINCT rec, chunk, label FROM l),
chain AS (
  SELECT n.rec, n.chunk, n.label, n.chunk AS root_chunk, n.label AS root_label FROM nodes n
  WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.rec = n.rec AND p.next_chunk = n.chunk AND p.next_label = n.label)
  UNION ALL
  SELECT p.rec, p.next_chunk, p.next_label, c.root_chunk, c.root_label FROM chain c JOIN pairs p ON p.rec = c.rec AND p.chunk = c.chunk AND p.label = c.label
)
SELECT rec, chunk, label, printf('SPK%02d', dense_rank() OVER (PARTITION BY rec ORDER BY root_chunk, root_label)) AS speaker FROM chain""")
def label_chains(spark, d):
    return chunking.reconcile(_labelled(spark, d))


NEAREST = f"""{EVEN_ODD}, n AS (
  SELECT a.rec, a.ord, a.start_ms,
    (SELECT max(b.start_ms) FROM b WHERE b.rec = a.rec AND b.start_ms <= a.start_ms) AS p,
    (SELECT min(b.start_ms) FROM b WHERE b.rec = a.rec AND b.start_ms >= a.start_ms) AS q FROM a
), dist AS (SELECT rec, ord, start_ms, least(start_ms - p, q - start_ms)::BIGINT AS distance_ms FROM n)"""


def _distances(spark, d):
    t = fx.turns(spark, d)
    return intervals.nearest_boundary(t.where("ord % 2 = 0"), t.where("ord % 2 = 1"))


@query(f"{NEAREST} SELECT rec, ord, start_ms, distance_ms FROM dist")
def nearest_boundary(spark, d):
    return _distances(spark, d)


@query(f"""{NEAREST} SELECT rec, count(*)::BIGINT AS n, quantile_cont(distance_ms, 0.5)::DOUBLE AS median_ms,
 avg((distance_ms <= 500)::INT) AS share_500ms, avg((distance_ms <= 1000)::INT) AS share_1s FROM dist WHERE distance_ms IS NOT NULL GROUP BY rec""")
def boundary_stats(spark, d):
    return intervals.boundary_stats(_distances(spark, d))


@query(f"""WITH {fx.SQL_TURNS}, x AS (
  SELECT *, max(end_ms) OVER (PARTITION BY rec, speaker ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM turns
), y AS (
  SELECT *, sum(CASE WHEN until IS NULL OR start_ms - until > 200000 THEN 1 ELSE 0 END) OVER (PARTITION BY rec, speaker ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM x
), z AS (SELECT rec, speaker, min(start_ms)::BIGINT AS start_ms, max(end_ms)::BIGINT AS end_ms, count(*)::BIGINT AS n_turns FROM y GROUP BY rec, speaker, island)
SELECT * FROM z WHERE end_ms - start_ms >= 250""")
def gap_merge(spark, d):
    return intervals.gap_merge(fx.turns(spark, d), 200_000)


@query(f"""WITH RECURSIVE {fx.SQL_TURNS}, u AS (
  SELECT rec, start_ms, max(end_ms) OVER (PARTITION BY rec ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo FROM turns
), pts AS (SELECT DISTINCT rec, (lo + start_ms) // 2 AS p FROM u WHERE start_ms - lo >= 60000),
cuts AS (
  SELECT DISTINCT rec, 0::BIGINT AS n, 0::BIGINT AS lo, 0::BIGINT AS hi, false AS fallback FROM turns
  UNION ALL
  SELECT c.rec, c.n + 1, c.hi,
    CASE WHEN 86400000 - c.hi <= 1800000 THEN 86400000 ELSE coalesce(
      (SELECT arg_min(p, abs(p - (c.hi + 1500000)) * 100000000 + p) FROM pts WHERE pts.rec = c.rec AND p BETWEEN c.hi + 1200000 AND c.hi + 1800000), c.hi + 1800000) END::BIGINT,
    86400000 - c.hi > 1800000 AND NOT EXISTS (SELECT 1 FROM pts WHERE pts.rec = c.rec AND p BETWEEN c.hi + 1200000 AND c.hi + 1800000)
  FROM cuts c WHERE c.hi < 86400000
)
SELECT rec, n AS chunk, greatest(lo - 8000, 0)::BIGINT AS dec_lo_ms, least(hi + 8000, 86400000)::BIGINT AS dec_hi_ms, lo AS core_lo_ms, hi AS core_hi_ms, fallback FROM cuts WHERE n > 0""")
def chunk_plan(spark, d):
    return chunking.plan(fx.recordings(spark, d), chunking.silences(fx.turns(spark, d), 60_000))


@query(ORACLE_SQL["chunk_plan"].replace("n AS chunk", "n::INTEGER AS chunk"))
def manifest_roundtrip(spark, d):
    """The plan written as manifests and scanned again."""
    docs = render.manifest_json(chunk_plan(spark, d)).select("rec", F.from_json("json", schema.MANIFEST).alias("j")).select("rec", "j.*")
    return transcripts.chunks(docs)


@query(ORACLE_SQL["assign_speakers"].split("SELECT a.rec, a.ord, coalesce")[0] + """SELECT a.rec, (row_number() OVER (PARTITION BY a.rec ORDER BY a.ord) - 1)::INTEGER AS pos, a.start_ms / 1000.0::DOUBLE AS "start",
 a.end_ms / 1000.0::DOUBLE AS "end", coalesce(r.r_speaker, 'UNKNOWN') AS speaker, 'event ' || a.ord AS text FROM a LEFT JOIN r ON a.rec = r.rec AND a.ord = r.ord AND r.n = 1""")
def speaker_labelled_json(spark, d):
    t = fx.turns(spark, d).withColumn("text", F.concat(F.lit("event "), F.col("ord").cast("string")))
    docs = parsed(render.labelled_json(intervals.assign_speakers(t.where("ord % 2 = 0"), t.where("ord % 2 = 1").drop("text"))), schema.LABELLED)
    return docs.select("rec", F.posexplode("segments").alias("pos", "s")).select("rec", "pos", "s.*")


@query(f"WITH {fx.SQL_TURNS} SELECT rec, ord, start_ms FROM turns WHERE start_ms >= 3600000 AND start_ms < 7200000")
def window_restriction(spark, d):
    return intervals.within(fx.turns(spark, d), 3_600_000, 7_200_000).select("rec", "ord", "start_ms")


@query("SELECT event_id, event_type AS speaker, value / 500 AS score FROM events WHERE value / 500 >= 0.5")
def activity_threshold(spark, d):
    """Events as scored frames."""
    frames = fx.read(spark, d, "events").select("event_id", F.col("event_type").alias("speaker"), (F.col("value") / 500).alias("score"))
    return intervals.active(frames, 0.5)


@query(f"{HEARD} SELECT rec, chunk, label, count(*)::BIGINT AS n, min(ord)::BIGINT AS first_ord FROM l GROUP BY rec, chunk, label")
def chunk_guess_counts(spark, d):
    return tagged.guess_counts(_labelled(spark, d), "label", "ord", ("rec", "chunk"))


@query(f"""WITH {fx.SQL_TURNS}, u AS (SELECT rec, start_ms, max(end_ms) OVER (PARTITION BY rec ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo_ms FROM turns)
SELECT rec, lo_ms, start_ms AS hi_ms FROM u WHERE start_ms - lo_ms >= 60000""")
def silence_source(spark, d):
    """Gaps between turns as a detector would state them, in seconds."""
    gaps = chunking.silences(fx.turns(spark, d), 60_000)
    return chunking.stated_silences(gaps.select("rec", timefmt.to_seconds(F.col("lo_ms")).alias("start"), timefmt.to_seconds(F.col("hi_ms")).alias("end")))


# Measurements


@query(f"WITH {fx.SQL_TURNS} SELECT rec, count(DISTINCT speaker)::BIGINT AS num_speakers FROM turns GROUP BY rec")
def distinct_speakers(spark, d):
    return quality.distinct_speakers(fx.turns(spark, d))


@query("""SELECT model, sum(audio_s) AS audio_s, sum(infer_s) AS infer_s, max(peak_gb) AS peak_gb, count(*)::BIGINT AS n_parts FROM (VALUES
 ('a', 10.0::DOUBLE, 2.0::DOUBLE, 7.5::DOUBLE), ('a', 20.0, 5.0, 7.0), ('b', 30.0, 1.0, 3.0)) t(model, audio_s, infer_s, peak_gb) GROUP BY model""")
def run_totals(spark, d):
    rows = [("a", 10.0, 2.0, 7.5), ("a", 20.0, 5.0, 7.0), ("b", 30.0, 1.0, 3.0)]
    return quality.run_totals(spark.createDataFrame(rows, "model string, audio_s double, infer_s double, peak_gb double"))


@query(f"""WITH {fx.SQL_DIRTY}, j AS (SELECT coalesce(a.rec, b.rec) AS rec, a.rec AS x, b.rec AS y FROM seg a FULL JOIN dirty b ON a.rec = b.rec AND a.start_ms = b.start_ms AND a.end_ms = b.end_ms)
SELECT rec, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL)::BIGINT AS n_both, count(*) FILTER (WHERE y IS NULL)::BIGINT AS n_first_only, count(*) FILTER (WHERE x IS NULL)::BIGINT AS n_second_only FROM j GROUP BY rec""")
def aligned_segments(spark, d):
    return quality.aligned(fx.seg(spark, d), fx.seg_dirty(spark, d))


@query(f"WITH {fx.SQL_DIRTY}, p AS (SELECT 'first' AS model, rec FROM seg UNION ALL SELECT 'second', rec FROM dirty WHERE trim(text) <> '') SELECT model, rec, count(*)::BIGINT AS n FROM p GROUP BY model, rec")
def pooled_models(spark, d):
    both = disagree.pool(first=fx.seg(spark, d), second=fx.seg_dirty(spark, d).where(textnorm.strip(F.col("text")) != "").drop("speaker"))
    return both.groupBy("model", "rec").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT * FROM (VALUES (0::BIGINT, '{"start":1.5,"text":"a"}'), (1, '{"end":2.0,"no_speech_prob":0.5}'), (2, '{}')) t(ord, json)""")
def compact_segments(spark, d):
    rows = [("r", 0, 1.5, None, "a", None), ("r", 1, None, 2.0, None, 0.5), ("r", 2, None, None, None, None)]
    df = spark.createDataFrame(rows, "rec string, ord bigint, start double, end double, text string, no_speech_prob double")
    return render.compact_json(df).select("ord", "json")


@query("SELECT page_id, strlen(html)::INTEGER AS bytes, sha256(html) AS sha256 FROM pages WHERE strlen(html) <= 3000")
def size_limit(spark, d):
    rows = fx.read(spark, d, "pages").select("page_id", F.octet_length("html").alias("bytes"), urls.fingerprint(F.col("html")).alias("sha256"))
    return rows.where(F.col("bytes") <= 3000)


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'correct, then translate' ELSE 'correct' END AS route FROM documents")
def language_route(spark, d):
    return fx.read(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "correct, then translate").otherwise("correct").alias("route"))


@query(f"""WITH {fx.SQL_SEG}, i AS (SELECT *, sum(CASE WHEN speaker IS NOT DISTINCT FROM prev AND prev_ord IS NOT NULL THEN 0 ELSE 1 END) OVER (PARTITION BY rec ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS turn
  FROM (SELECT *, lag(speaker) OVER (PARTITION BY rec ORDER BY ord) AS prev, lag(ord) OVER (PARTITION BY rec ORDER BY ord) AS prev_ord FROM seg))
SELECT rec, turn, speaker, min(ord)::BIGINT AS first_ord, count(*)::BIGINT AS n_segments, min(start_ms)::BIGINT AS start_ms, max(end_ms)::BIGINT AS end_ms FROM i GROUP BY rec, turn, speaker""")
def speaker_turns(spark, d):
    return quality.speaker_turns(fx.seg(spark, d))


@query(f"""WITH {fx.SQL_TURNS} SELECT rec, speaker, sum(end_ms - start_ms)::BIGINT AS voiced_ms,
 sum(end_ms - start_ms)::DOUBLE / sum(sum(end_ms - start_ms)) OVER (PARTITION BY rec)::DOUBLE AS share FROM turns GROUP BY rec, speaker""")
def speaker_share(spark, d):
    return quality.speaker_share(fx.turns(spark, d))


@query(f"""WITH {fx.SQL_SEG}, s AS (SELECT rec, speaker, sum(end_ms - start_ms)::BIGINT AS voiced_ms, sum(length(text))::BIGINT AS chars FROM seg GROUP BY rec, speaker),
t AS (SELECT *, voiced_ms::DOUBLE / nullif(sum(voiced_ms) OVER (PARTITION BY rec), 0)::DOUBLE AS share, chars::DOUBLE / nullif(sum(chars) OVER (PARTITION BY rec), 0)::DOUBLE AS char_share FROM s)
SELECT * FROM t WHERE share < 0.1""")
def fragmented_labels(spark, d):
    return quality.fragmented(quality.speaker_share(fx.seg(spark, d), "text"), 0.1)


@query(f"WITH {fx.SQL_TURNS} SELECT rec, 86400000::BIGINT AS duration_ms, max(end_ms)::BIGINT AS last_ms, max(end_ms) / 86400000.0::DOUBLE AS coverage FROM turns GROUP BY rec")
def coverage(spark, d):
    return quality.coverage(fx.turns(spark, d), fx.recordings(spark, d))


@query(f"""WITH {fx.SQL_DIRTY}, x AS (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe FROM dirty WINDOW w AS (PARTITION BY rec ORDER BY ord))
SELECT rec, count(*)::BIGINT AS n, count(*) FILTER (WHERE end_ms < start_ms)::BIGINT AS n_negative, count(*) FILTER (WHERE end_ms = start_ms)::BIGINT AS n_zero,
 count(*) FILTER (WHERE start_ms < ps)::BIGINT AS n_backward, count(*) FILTER (WHERE start_ms < pe)::BIGINT AS n_overlapping, count(*) FILTER (WHERE end_ms > {CUTOFF})::BIGINT AS n_beyond,
 bool_and(end_ms >= start_ms) AS non_negative, bool_and(end_ms > start_ms) AS positive, count(*) FILTER (WHERE trim(text) = '')::BIGINT AS n_empty FROM x GROUP BY rec""")
def integrity_report(spark, d):
    return quality.integrity(fx.seg_dirty(spark, d), F.lit(CUTOFF), "text")


@query(f"""WITH {fx.SQL_TURNS}, x AS (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe FROM turns WINDOW w AS (PARTITION BY rec ORDER BY ord))
SELECT rec, count(*)::BIGINT AS n, count(*) FILTER (WHERE end_ms < start_ms)::BIGINT AS n_negative, count(*) FILTER (WHERE end_ms = start_ms)::BIGINT AS n_zero,
 count(*) FILTER (WHERE start_ms < ps)::BIGINT AS n_backward, count(*) FILTER (WHERE start_ms < pe)::BIGINT AS n_overlapping, count(*) FILTER (WHERE end_ms > 86400000)::BIGINT AS n_beyond,
 bool_and(end_ms >= start_ms) AS non_negative, bool_and(end_ms > start_ms) AS positive FROM x GROUP BY rec""")
def integrity_turns(spark, d):
    return quality.integrity(fx.turns(spark, d), F.lit(fx.DAY_MS))


@query(f"WITH {fx.SQL_DIRTY} SELECT rec, count(*) > 0 AS non_empty, bool_and(end_ms > start_ms) AS all_valid FROM dirty GROUP BY rec")
def validity_gate(spark, d):
    return quality.gate(fx.seg_dirty(spark, d))


@query(f"WITH {fx.SQL_TURNS} SELECT rec, quantile_cont(end_ms - start_ms, 0.5)::DOUBLE AS median_ms, min(end_ms - start_ms)::BIGINT AS min_ms, max(end_ms - start_ms)::BIGINT AS max_ms FROM turns GROUP BY rec")
def duration_median(spark, d):
    x = F.col("end_ms") - F.col("start_ms")
    return fx.turns(spark, d).groupBy("rec").agg(F.percentile(x, F.lit(0.5)).alias("median_ms"), F.min(x).alias("min_ms"), F.max(x).alias("max_ms"))


LOOPS = f"""WITH {fx.SQL_LINES}, x AS (SELECT *, lag(text) OVER (PARTITION BY rec ORDER BY ord) AS prev FROM doclines),
i AS (SELECT *, sum(CASE WHEN text = prev THEN 0 ELSE 1 END) OVER (PARTITION BY rec ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM x),
runs AS (SELECT rec, min(ord)::BIGINT AS first_ord, count(*)::BIGINT AS length, any_value(text) AS text FROM i GROUP BY rec, island HAVING count(*) >= 3)"""


@query(f"{LOOPS} SELECT rec, first_ord, length, text FROM runs")
def loop_runs(spark, d):
    return quality.loop_runs(fx.doclines(spark, d))


@query(LOOPS.replace("x AS (SELECT *, lag", """ended AS (SELECT rec, ord, text FROM doclines UNION ALL
  SELECT rec, m + i, 'and so on' FROM (SELECT rec, max(ord) AS m FROM doclines WHERE rec % 7 = 0 GROUP BY rec), range(1, 4 + rec % 3) r(i)), x AS (SELECT *, lag""").replace("FROM doclines),\ni", "FROM ended),\ni") + """
SELECT r.rec, r.first_ord, r.length FROM runs r JOIN (SELECT rec, max(ord) AS m FROM ended GROUP BY rec) t ON r.rec = t.rec AND r.first_ord + r.length - 1 = t.m""")
def tail_candidates(spark, d):
    """Every seventh document ends in a line that is said three to five times."""
    rows = fx.doclines(spark, d)
    last = rows.where("rec % 7 = 0").groupBy("rec").agg(F.max("ord").alias("m"))
    more = last.select("rec", F.explode(F.sequence(F.col("m") + 1, F.col("m") + 3 + F.col("rec") % 3)).alias("ord"), F.lit("and so on").alias("text"))
    ended = rows.select("rec", "ord", "text").unionByName(more)
    return quality.tail_candidates(quality.loop_runs(ended), ended)


@query(f"WITH {fx.SQL_LINES} SELECT rec, text, count(*)::BIGINT AS n, min(ord)::BIGINT AS first_ord FROM doclines GROUP BY rec, text HAVING count(*) >= 3")
def repeated_lines(spark, d):
    return quality.repeated_lines(fx.doclines(spark, d))


@query(f"WITH {fx.SQL_SEG}, v AS (SELECT rec, ord, text, end_ms - start_ms + ord % 7 * 100 AS d FROM seg) SELECT rec, ord, length(text) * 1000.0::DOUBLE / d AS chars_per_s FROM v WHERE d > 0")
def reading_speed(spark, d):
    uneven = fx.seg(spark, d).withColumn("end_ms", F.col("end_ms") + F.col("ord") % 7 * 100)
    return quality.reading_speed(uneven).select("rec", "ord", "chars_per_s")


# Disagreement of two runs: neighbouring documents stand for two models' texts of one recording. The first three queries compare
# window by window, whole texts of all pairs in any script; the *_whole queries compare each two texts in one piece.


def _whole_pairs(spark, d) -> tuple[DataFrame, DataFrame]:
    docs = fx.read(spark, d, "documents").select(F.lit("r").alias("rec"), F.floor(F.col("doc_id") / 2).cast("bigint").alias("window"), "doc_id", "text")
    return docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 <> 0")


PAIRS = """WITH p AS (SELECT a.doc_id // 2 AS "window", coalesce(a.text, '') AS text_a, coalesce(b.text, '') AS text_b FROM documents a JOIN documents b ON a.doc_id % 2 = 0 AND b.doc_id = a.doc_id + 1)"""
CHAR_SQL = PAIRS + """, c AS (SELECT "window", regexp_extract_all(text_a, '(?s).{1,45}') AS a, regexp_extract_all(text_b, '(?s).{1,45}') AS b FROM p),
w AS (SELECT "window", unnest(range(greatest(len(a), len(b)))) AS part, a, b FROM c),
v AS (SELECT "window", part, CASE WHEN part < len(a) THEN string_split(a[part + 1], '') ELSE [] END AS a, CASE WHEN part < len(b) THEN string_split(b[part + 1], '') ELSE [] END AS b FROM w),
k AS (SELECT *, list_distinct(list_concat(a, b)) AS k FROM v),
e AS (SELECT "window", part::INTEGER AS part, len(a)::BIGINT AS n_chars, levenshtein(array_to_string(list_transform(a, lambda x: chr((32 + list_position(k, x))::INTEGER)), ''),
  array_to_string(list_transform(b, lambda x: chr((32 + list_position(k, x))::INTEGER)), ''))::BIGINT AS edits FROM k)"""


@query(CHAR_SQL + """ SELECT "window", part, n_chars, edits, CASE WHEN n_chars > 0 THEN edits::DOUBLE / n_chars END AS disagreement FROM e""")
def char_disagreement(spark, d):
    return disagree.windows_by_characters(disagree.char_windows(*_whole_pairs(spark, d))).select("window", "part", "n_chars", "edits", "disagreement")


WORDS = """list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(lower({}), '[\\p{{P}}\\p{{S}}]', '', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> '')"""
WORD_SQL = PAIRS + f""", c AS (SELECT "window", {WORDS.format('text_a')} AS a, {WORDS.format('text_b')} AS b FROM p),
w AS (SELECT "window", unnest(range((greatest(len(a), len(b)) + 44) // 45)) AS part, a, b FROM c),
v AS (SELECT "window", part, a[45 * part + 1 : 45 * part + 45] AS a, b[45 * part + 1 : 45 * part + 45] AS b FROM w),
k AS (SELECT *, list_distinct(list_concat(a, b)) AS k FROM v),
e AS (SELECT "window", part::INTEGER AS part, len(a)::BIGINT AS n_words, levenshtein(array_to_string(list_transform(a, lambda x: chr((32 + list_position(k, x))::INTEGER)), ''),
  array_to_string(list_transform(b, lambda x: chr((32 + list_position(k, x))::INTEGER)), ''))::BIGINT AS edits FROM k)"""


@query(WORD_SQL + """ SELECT "window", part, n_words, edits, CASE WHEN n_words > 0 THEN edits::DOUBLE / n_words END AS disagreement FROM e""")
def word_disagreement(spark, d):
    return disagree.windows_by_words(disagree.word_windows(*_whole_pairs(spark, d))).select("window", "part", "n_words", "edits", "disagreement")


@query(WORD_SQL + """, r AS (SELECT 'r' AS rec, edits, n_words FROM e) SELECT rec, sum(edits)::BIGINT AS edits, sum(n_words)::BIGINT AS n_words, sum(edits)::DOUBLE / sum(n_words) AS disagreement FROM r GROUP BY ROLLUP (rec)""")
def disagreement_total(spark, d):
    return disagree.total(disagree.windows_by_words(disagree.word_windows(*_whole_pairs(spark, d))))


# In one piece: DuckDB cannot follow, so there is no SQL.


@query()
def char_disagreement_whole(spark, d):
    return disagree.by_characters(disagree.pair(*_whole_pairs(spark, d))).select("window", "n_chars", "edits", "disagreement")


@query()
def word_disagreement_whole(spark, d):
    return disagree.by_words(disagree.pair(*_whole_pairs(spark, d))).select("window", "n_words", "edits", "disagreement")


@query()
def disagreement_total_whole(spark, d):
    return disagree.total(disagree.by_words(disagree.pair(*_whole_pairs(spark, d))))


@query("""SELECT conv_id AS rec, turn, length(regexp_replace(regexp_replace(lower(text), '[\\p{P}\\p{S}]', '', 'g'), '\\s+', '', 'g'))::BIGINT AS n FROM conversations""")
def char_normalize(spark, d):
    x = textnorm.characters(F.col("text"))
    return fx.read(spark, d, "conversations").select(F.col("conv_id").alias("rec"), "turn", F.char_length(x).cast("bigint").alias("n"))


