"""Boundaries, precedence, malformed input and rounding, which the tables do not reach."""

from __future__ import annotations

import json
import random
import re
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from cuewise import schema
from cuewise.functions import distance, textnorm, timefmt, urls
from cuewise.operators import chunking, disagree, intervals, quality, review, tagged
from cuewise.plans import render
from cuewise.sources import download, models, transcripts

SEG = "rec string, ord bigint, start_ms bigint, end_ms bigint, speaker string, text string"


def seg(spark, rows):
    return spark.createDataFrame(rows, SEG)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_half_milliseconds_round_to_even(spark):
    values = [0.0005, 0.0015, 0.0025, 1.2345, 3599.9996, 86399.9995, 0.1 + 0.2]
    got = [r["x"] for r in spark.createDataFrame([(v,) for v in values], "s double").select(timefmt.to_ms(F.col("s")).alias("x")).collect()]
    assert got == [round(v * 1000) for v in values]


def test_clock_is_clamped_and_passes_a_day(spark):
    assert one(spark, timefmt.srt_clock(F.lit(-500))) == "00:00:00,000"
    assert one(spark, timefmt.clock(F.lit(360_000_001).cast("bigint"))) == "100:00:00.001"


def test_strip_knows_unicode_white_space(spark):
    for t in ("　 a b \x1f", " x ", "\x85y", "​z​"):
        assert one(spark, textnorm.strip(F.lit(t))) == t.strip()
    assert one(spark, textnorm.collapse(F.lit("a 　 b\n\tc"))) == "a b c"
    assert one(spark, textnorm.strip_speaker_tag(F.lit("[S12]　 hi "))) == "hi"
    assert one(spark, textnorm.strip_speaker_tag(F.lit("a [S1] hi"))) == "a [S1] hi"


def test_routing_takes_the_first_reason(spark):
    rows = [("r", 0, 5, 5, "a", " "), ("r", 1, 5, 5, "a", "x"), ("r", 2, 5, 101, "a", "x"), ("r", 3, 5, 100, "a", " x "), ("r", 4, 200, 150, "a", "x"), ("r", 5, None, 9, "a", "x")]
    routed = review.route(seg(spark, rows), 100)
    assert [r["verdict"] for r in routed.orderBy("ord").collect()] == ["empty_text", "invalid_or_zero_duration", "after_cutoff", "kept", "invalid_or_zero_duration", "invalid_or_zero_duration"]
    c = review.counters(routed).first()
    assert c["source_segment_count"] == 6 == c["segment_count"] + sum(c[r] for r in review.REASONS)
    k = review.kept(routed).collect()
    assert [(r["id"], r["text"]) for r in k] == [(1, "x")]


def test_first_start_is_of_the_source_row(spark):
    rows = [("r", 0, 900, 950, "S01", "[S01] a"), ("r", 1, 10, 20, "S03", "b"), ("r", 2, 500, 800, "S9", "c")]
    got = review.diarized(seg(spark, rows), 500).orderBy("ord").collect()
    assert [(r["ord"], r["start_ms"], r["speaker"], r["original_speaker_id"]) for r in got] == [(1, 10, "万国", "S03")]
    got = review.diarized(seg(spark, rows), 901).orderBy("ord").collect()
    assert got[0]["start_ms"] == review.FIRST_START_MS and got[0]["text"] == "a" and got[2]["speaker"] == "S9"


def test_missing_segments(spark):
    docs = spark.createDataFrame([("a", '{"text":"t"}'), ("b", '{"segments":[{"start":1,"end":2,"text":"x"}]}')], "rec string, j string").select("rec", F.from_json("j", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
    assert transcripts.asr_segments(docs).count() == 1
    with pytest.raises(Exception, match="no segments"):
        transcripts.diarized_segments(docs).collect()
    assert transcripts.diarized_segments(docs.where("rec = 'b'")).first()["speaker"] == "UNKNOWN"


def test_tagged_text_of_doubtful_records(spark):
    text = "[0]A: one\ntwo [x] [1.5][2]B B :three[3]\n[4]" + "n" * 81 + ": long[5] [6]C: [7] [8]D: open"
    got = tagged.extract(spark.createDataFrame([("r", text), ("none", "")], "rec string, text string"), 10.0, "c1").orderBy("id").collect()
    assert [(r["id"], r["relative_start"], r["absolute_end"], r["model_speaker_guess"], r["text"], r["chunk"]) for r in got] == [
        (1, 0.0, 11.5, "A", "one two [x]", "c1"),
        (2, 2.0, 13.0, "B B", "three", "c1"),
        (3, 6.0, 17.0, "C", "", "c1"),
    ]


def test_edit_distances(spark):
    assert one(spark, distance.char_edits(F.lit("日本語"), F.lit("日本人"))) == 1
    words = lambda t: F.array(*map(F.lit, t.split()))
    assert one(spark, distance.word_edits(words("a b c d e"), words("a x c e f"))) == 3
    assert one(spark, distance.disagreement(F.lit(0), F.lit(0))) is None


def test_totals_weigh_by_the_first_run(spark):
    rows = spark.createDataFrame([("a", 206, 7519), ("b", 339, 7544)], "rec string, edits bigint, n_words bigint")
    t = disagree.total(rows).where("rec is null").first()
    assert (t["edits"], t["n_words"], round(100 * t["disagreement"], 2)) == (545, 15063, 3.62)


def naive(a, b):
    return {(x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]}


def test_bucketed_overlap_is_the_plain_one(spark):
    rnd = random.Random(3)
    make = lambda: [(rnd.choice("pq"), i, s, s + rnd.choice([0, 1, 10, 400, 2500]), "s", "") for i in range(120) for s in [rnd.randrange(5000)]]
    a, b = make(), make()
    got = intervals.overlap_join(seg(spark, a), seg(spark, b), width=300).select("rec", "ord", "r_ord").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == naive(a, b)


def test_every_midpoint_has_one_owner(spark):
    chunks = spark.createDataFrame([("r", 1, 0, 1000), ("r", 2, 1000, 2000)], "rec string, chunk bigint, core_lo_ms bigint, core_hi_ms bigint")
    rows = [("r", 0, 0, 1, "", ""), ("r", 1, 999, 1001, "", ""), ("r", 2, 998, 1001, "", ""), ("r", 3, 1999, 2001, "", ""), ("r", 4, 2000, 2001, "", "")]
    got = {r["ord"]: r["chunk"] for r in intervals.owned(seg(spark, rows), chunks, 300).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 2}


def test_nearest_boundary_is_the_plain_one(spark):
    rnd = random.Random(5)
    a = [("r", i, rnd.randrange(1000), 0, "", "") for i in range(50)] + [("lone", 0, 5, 6, "", "")]
    b = [("r", i, rnd.randrange(1000), 0, "", "") for i in range(20)]
    got = {(r["rec"], r["ord"]): r["distance_ms"] for r in intervals.nearest_boundary(seg(spark, a), seg(spark, b)).collect()}
    assert got == {(x[0], x[1]): min((abs(x[2] - y[2]) for y in b if y[0] == x[0]), default=None) for x in a}


def test_gap_merge_sees_long_turns(spark):
    rows = [("r", 0, 0, 5000, "a", ""), ("r", 1, 100, 200, "a", ""), ("r", 2, 5200, 5300, "a", ""), ("r", 3, 5501, 5600, "a", "")]
    got = intervals.gap_merge(seg(spark, rows)).orderBy("start_ms").collect()
    assert [(r["start_ms"], r["end_ms"], r["n_turns"]) for r in got] == [(0, 5300, 3)]


def test_plan_tiles_the_recording(spark):
    recs = spark.createDataFrame([("a", 10_000_000), ("b", 1000), ("c", 1_800_001)], "rec string, duration_ms bigint")
    sil = spark.createDataFrame([("a", 1_499_000, 1_501_100), ("a", 1_498_000, 1_502_000)], "rec string, lo_ms bigint, hi_ms bigint")
    got = chunking.plan(recs, sil).orderBy("rec", "chunk").collect()
    a = [r for r in got if r["rec"] == "a"]
    assert [r["core_hi_ms"] for r in a][:2] == [1_500_000, 3_300_000] and a[1]["fallback"] and not a[0]["fallback"]
    for rec, end in (("a", 10_000_000), ("b", 1000), ("c", 1_800_001)):
        own = [r for r in got if r["rec"] == rec]
        assert own[0]["core_lo_ms"] == 0 and own[-1]["core_hi_ms"] == end
        assert all(x["core_hi_ms"] == y["core_lo_ms"] for x, y in zip(own, own[1:], strict=False))


def test_loops_are_flagged(spark):
    rows = [("r", i, i, i + 1, "a", t) for i, t in enumerate("xxabbbccc")]
    runs = quality.loop_runs(seg(spark, rows))
    assert sorted((r["first_ord"], r["length"]) for r in runs.collect()) == [(3, 3), (6, 3)]
    assert [r["first_ord"] for r in quality.tail_candidates(runs, seg(spark, rows)).collect()] == [6]


def test_markdown_holds_no_clock(spark):
    rows = seg(spark, [("r", 2, 7_200_999, 7_201_000, "B", "At ten past two."), ("r", 0, 0, 1500, "A", "Rain."), ("r", 1, 1500, 2000, None, None)])
    md = render.raw_markdown(rows).first()["md"]
    assert md == "Rain.\n\n\n\nAt ten past two.\n"
    srt = render.srt_plain(rows.withColumn("id", F.col("ord") + 1)).first()["srt"]
    assert one(spark, textnorm.has_timecode(F.lit(srt))) and not one(spark, textnorm.has_timecode(F.lit(md)))
    assert srt == "1\n00:00:00,000 --> 00:00:01,500\nRain.\n\n2\n00:00:01,500 --> 00:00:02,000\n\n\n3\n02:00:00,999 --> 02:00:01,000\nAt ten past two.\n"
    by_name = render.speaker_markdown(rows, "T", "N", "ord").first()["md"]
    assert by_name == "# T\n\n> N\n\n**A：** Rain.\n\n**UNKNOWN：** \n\n**B：** At ten past two.\n\n"


def test_documents_are_not_overwritten(spark, tmp_path):
    texts = spark.createDataFrame([("a", "x\n"), ("b", "y\n")], "rec string, md string")
    to = f"file://{tmp_path}/md"
    render.write_documents(texts, "md", to)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        render.write_documents(texts, "md", to)
    render.write_documents(texts, "md", to, overwrite=True)
    assert sorted(p.read_text() for p in (tmp_path / "md").rglob("part-*.txt")) == ["x\n", "y\n"]
    assert render.sibling("/d/talk.v1.json", ".srt") == "/d/talk.v1.srt"


def test_json_scans(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"segments": [{"start": 1.0, "end": 2.5, "speaker": 3}]}))
    r = transcripts.turns(spark, f"file://{tmp_path}/t.json").first()
    assert (r["start_ms"], r["end_ms"], r["speaker"]) == (1000, 2500, "3")
    (tmp_path / "m.json").write_text(json.dumps({"chunks": [{"chunk": 1, "decoded_start": 0, "decoded_end": 9.5, "core_start": 0, "core_end": 8, "fallback": True}]}))
    m = transcripts.manifest(spark, f"file://{tmp_path}/m.json").first()
    assert (m["chunk"], m["dec_hi_ms"], m["fallback"]) == (1, 9500, True)
    (tmp_path / "a.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nhi\nyou\n\n2\n00:00:03,000 --> 00:00:04,000\nx\n")
    assert [(r["id"], r["start_ms"], r["text"]) for r in transcripts.read_srt(spark, f"file://{tmp_path}/a.srt").collect()] == [(1, 1000, "hi\nyou"), (2, 3000, "x")]


def test_model_source(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"1234")
    (tmp_path / "b.bin").write_bytes(b"-")

    def factory():
        def model(content, options):
            found = [{"id": 3, "start": 0.0, "end": float(len(content)), "text": repr(sorted(options.items())), "speaker": 2}] if content != b"-" else []
            return {"segments": found, "text": "all", "prompt_tokens": 5, "generation_tokens": len(content), "peak_gb": 1.25}

        return model

    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/*.bin")
    told = lambda **kw: models.segments(models.recognise(files, factory, **kw)).first()["text"]
    assert "('prompt', '')" in told(mode="moss") and "('initial_prompt', None)" in told(mode="whisper")
    assert "('prompt', 'names')" in told(mode="moss", prompt="names") and "('initial_prompt', 'names')" in told(mode="whisper", prompt="names")
    rows = models.recognise(files, factory, "whisper")
    assert [(r["end"], r["id"], r["ord"], r["speaker"]) for r in models.segments(rows).collect()] == [(4.0, 3, 0, "2")]
    recs = files.select(F.col("path").alias("rec"), F.lit(8.0).alias("audio_s"))
    got = {r["rec"][-5]: r for r in models.metrics(rows, recs, "m", "whisper").collect()}
    fields = {"mode", "model", "audio", "audio_duration_seconds", "load_seconds", "inference_seconds", "wall_seconds", "realtime_factor", "realtime_speed", "peak_mlx_memory_gb", "prompt_tokens", "generation_tokens", "segment_count"}
    assert set(got["a"].asDict()) == fields | {"rec"}
    assert (got["a"]["segment_count"], got["a"]["generation_tokens"], got["a"]["peak_mlx_memory_gb"]) == (1, 4, 1.25)
    assert (got["b"]["segment_count"], got["b"]["prompt_tokens"]) == (0, 5) and got["b"]["realtime_factor"] == got["b"]["inference_seconds"] / 8
    docs = {r["rec"][-5]: json.loads(r["json"]) for r in render.benchmark_json(models.metrics(rows, recs, "m", "whisper"), models.segments(rows), "recognition").collect()}
    assert docs["b"]["segments"] == [] and set(docs["a"]) == {"metrics", "text", "segments"} and docs["a"]["segments"][0]["id"] == 3
    assert "temperature" not in docs["a"]["segments"][0] and set(docs["a"]["metrics"]) == fields
    turns = models.diarize(files, factory, threshold=0.25)
    assert "('threshold', 0.25)" in models.segments(turns).first()["text"]
    m = models.metrics(turns, recs, "m", options={"threshold": 0.25})
    doc = {r["rec"][-5]: json.loads(r["json"]) for r in render.benchmark_json(m, models.segments(turns), "diarization").collect()}
    assert doc["a"]["segments"] == [{"start": 0.0, "end": 4.0, "speaker": 2}] and doc["a"]["metrics"]["num_speakers"] == 1 and doc["b"]["metrics"]["num_speakers"] == 0
    assert doc["a"]["metrics"]["threshold"] == 0.25 and doc["a"]["metrics"]["merge_gap"] == 0.2 and len(doc["a"]["metrics"]) == 13


def test_needed_fields(spark):
    for text, name in (('{"segments":[{"end":1,"text":"x"}]}', "start"), ('{"segments":[{"start":0,"text":"x"}]}', "end"), ('{"segments":[{"start":0,"end":1}]}', "text")):
        docs = spark.createDataFrame([("r", text)], "rec string, j string").select("rec", F.from_json("j", schema.TRANSCRIPT).alias("j")).select("rec", "j.*")
        with pytest.raises(Exception, match=f"no {name} in r"):
            transcripts.diarized_segments(docs).collect()


def test_documents_of_doubtful_rows(spark):
    """No record, no kept segment, no list of segments: the document is written all the same."""
    texts = spark.createDataFrame([("a", "[1]X: y[2]", "1", 2.5), ("b", "nothing", "2", 0.0)], "rec string, text string, chunk string, offset_s double")
    rows = tagged.extract(texts, F.col("offset_s"), F.col("chunk"))
    got = {r["rec"]: json.loads(r["json"]) for r in render.tagged_json(rows, tagged.guess_list(tagged.guess_counts(rows)), texts).collect()}
    assert (got["a"]["chunk"], got["a"]["offset_seconds"], got["a"]["segments"][0]["absolute_end"]) == ("1", 2.5, 4.5) and got["a"]["speaker_guess_counts"] == {"X": 1}
    assert (got["b"]["segment_count"], got["b"]["segments"], got["b"]["speaker_guess_counts"]) == (0, [], {})
    review_doc = review.route(seg(spark, [("r", 0, 5, 5, "a", "x")]).withColumns({"avg_logprob": F.lit(None).cast("double"), "no_speech_prob": F.lit(None).cast("double")}), 100)
    doc = json.loads(render.asr_json(review.kept(review_doc), review.counters(review_doc), 100).first()["json"])
    assert doc["segments"] == [] and doc["rejected"] == {"empty_text": 0, "invalid_or_zero_duration": 1, "after_cutoff": 0} and doc["speaker_labels"] is False
    bare = spark.createDataFrame([("r", '{"metadata":{"title":"T","source_language":"zh"}}')], "rec string, j string").select("rec", F.from_json("j", schema.REVIEWED).alias("j")).select("rec", "j.*")
    assert {r["name"]: r["md"] for r in render.final_markdown(bare).collect()}["zh"] == "# T\n\n\n"
    told = [one(spark, c) for c in review.notes()]
    assert told[2:] == ["Corrected the first cue start to 7.540s using the baseline MOSS run.", "Discarded output beginning at 2158.000s or later as outro hallucination."]


def test_sources_of_files(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"silences": [{"start": 1.0004, "end": 2.5}, {"start": 3, "end": 3}]}))
    assert [(r["lo_ms"], r["hi_ms"]) for r in transcripts.silences(spark, f"file://{tmp_path}/s.json").collect()] == [(1000, 2500)]
    for name, rate, channels in (("m1", 16_000, 1), ("m2", 44_100, 2), ("m3", None, 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"duration": 2.0004, "sample_rate": rate, "channels": channels, "codec": "pcm"}))
    probed = transcripts.recordings(spark, f"file://{tmp_path}/m*.json")
    assert {r["duration_ms"] for r in probed.collect()} == {2000} and probed.count() == 3
    assert sorted(r["rec"][-7:] for r in transcripts.to_resample(probed).collect()) == ["m2.json", "m3.json"]
    (tmp_path / "big.mp3").write_bytes(b"x" * 100)
    (tmp_path / "small.mp3").write_bytes(b"abc")
    got = transcripts.media(spark, f"file://{tmp_path}/*.mp3", 50).collect()
    assert [(r["bytes"], r["sha256"]) for r in got] == [(3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")]
    (tmp_path / "t.json").write_text(json.dumps({"text": "[0]A: b[1]"}))
    assert tagged.extract(transcripts.tagged_texts(transcripts.documents(spark, f"file://{tmp_path}/t.json"))).first()["text"] == "b"


def test_chunks_are_foldered(spark, tmp_path):
    rows = spark.createDataFrame([("r", 1, "x"), ("r", 2, "y")], "rec string, chunk bigint, text string")
    to = f"file://{tmp_path}/chunks"
    render.write_chunks(rows, to)
    assert sorted(r["text"] for r in spark.read.json(f"{to}/rec=r/chunk=2").collect()) == ["y"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        render.write_chunks(rows, to)


def test_frames_become_turns(spark):
    frames = [("r", "a", i * 100, i * 100 + 100, 0.9 if i in (0, 1, 2, 4, 5) else 0.1) for i in range(8)] + [("r", "a", 5000, 5100, 0.9), ("r", "b", 0, 900, None), ("r", "b", 0, 900, float("nan"))]
    got = intervals.turns_from_frames(spark.createDataFrame(frames, "rec string, speaker string, start_ms bigint, end_ms bigint, score double"))
    assert [(r["speaker"], r["start_ms"], r["end_ms"]) for r in got.collect()] == [("a", 0, 600)]


def test_word_alignment(spark):
    words = spark.createDataFrame([("r", 2, 1, "you", 1.0, 1.5), ("r", 2, 0, "see", 0.5, 1.0), ("r", 10, 0, "yes", 2.0, 2.25)], "rec string, id bigint, ord bigint, word string, start double, end double")
    audio = spark.createDataFrame([("r", "r.wav"), ("none", "n.wav")], "rec string, audio string")
    got = {r["rec"]: json.loads(r["json"]) for r in render.words_json(words, audio).collect()}
    assert [(s["id"], s["text"]) for s in got["r"]["segments"]] == [(2, "see you"), (10, "yes")] and got["r"]["segments"][0]["words"][1] == {"word": "you", "start": 1.0, "end": 1.5}
    assert got["none"] == {"audio": "n.wav", "segments": []}


def test_chains_of_labels(spark):
    """Labels swap at every border; one fades out and another begins."""
    rows = []
    for c in range(6):
        lo = c * 1000
        names = ("SPK01", "SPK02") if c % 2 == 0 else ("SPK02", "SPK01")
        for part in (lo, lo + 500) if c else (500,):
            rows += [("r", c, names[0], part, part + 200), ("r", c, names[1], part + 200, part + 400)]
        if c < 5:
            rows += [("r", c, names[0], lo + 1000, lo + 1200), ("r", c, names[1], lo + 1200, lo + 1400)]
    rows += [("q", 3, "SPK01", 0, 10), ("q", 9, "SPK01", 0, 10)]
    got = {(r["rec"], r["chunk"], r["label"]): r["speaker"] for r in chunking.reconcile(spark.createDataFrame(rows, "rec string, chunk bigint, label string, start_ms bigint, end_ms bigint"), 100).collect()}
    assert all(got["r", c, "SPK01" if c % 2 == 0 else "SPK02"] == "SPK01" and got["r", c, "SPK02" if c % 2 == 0 else "SPK01"] == "SPK02" for c in range(6))
    assert (got["q", 3, "SPK01"], got["q", 9, "SPK01"]) == ("SPK01", "SPK02")


def test_nearest_boundary_beyond_its_bucket(spark):
    a = [("r", i, t, 0, "", "") for i, t in enumerate((0, 49, 50, 1000, 100_000))]
    b = [("r", i, t, 0, "", "") for i, t in enumerate((45, 999_999))]
    got = {r["ord"]: r["distance_ms"] for r in intervals.nearest_boundary(seg(spark, a), seg(spark, b), 50).collect()}
    assert got == {0: 45, 1: 4, 2: 5, 3: 955, 4: 99_955}


def test_arriving_documents_are_routed_once(spark, tmp_path):
    from cuewise.streaming import review as arriving

    box = tmp_path / "in"
    box.mkdir()
    put = lambda name, *texts: (box / name).write_text(json.dumps({"segments": [{"start": 0.0, "end": 1.0, "text": t} for t in texts]}))
    for names in (("a.json",), ("b.json", "c.json")):
        for name in names:
            put(name, "x", " ")
        q = arriving.write(arriving.routed(spark, f"file://{box}", 2000), f"file://{tmp_path}/out", f"file://{tmp_path}/ck").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    got = spark.read.parquet(f"file://{tmp_path}/out").groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"kept": 3, "empty_text": 3}


def test_urls(spark):
    shown = {
        "http://ana:pw@media.example.org:8080/a%20b/c.ogg?sig=1&x=%2F#t=5": "http://media.example.org:8080/a%20b/c.ogg",
        "https://media.example.org?only=query": "https://media.example.org",
        "https://media.example.org/plain.ogg": "https://media.example.org/plain.ogg",
    }
    for url, want in shown.items():
        assert one(spark, urls.redacted(F.lit(url))) == download.display_url(url) == want
        assert one(spark, urls.query_redacted(F.lit(url))) == ("?" in url)
    for url in ("http://10.0.0.8/a.ogg", "http://[::1]:9/a.ogg", "ftp://media.example.org/a.ogg", "file:///etc/hosts", "http:///a.ogg", "http://no-such-host.invalid/a.ogg"):
        with pytest.raises(SystemExit):
            download.validate_url(url)
    with pytest.raises(Exception, match="private or missing host: http://10.0.0.8/a.ogg") as e:
        one(spark, urls.checked(F.lit("http://10.0.0.8/a.ogg?sig=hidden")))
    assert "hidden" not in str(e.value).split("SQLSTATE")[0].split("private or missing host")[1]


class Shelf(BaseHTTPRequestHandler):
    """Recordings behind redirects: two in a row, a circle, one to an address of this machine, one without a name."""

    places = {"/old": "/moved?sig=one", "/moved": "/shelf/Lecture%201.ogg?sig=two#end", "/round": "/round", "/inside": "http://127.0.0.1:1/x.ogg", "/nameless": "/shelf/"}

    def do_GET(self):
        path = self.path.partition("?")[0]
        if path in self.places:
            self.send_response(307)
            self.send_header("Location", self.places[path])
            self.end_headers()
            return
        self.send_response(200)
        self.send_header("Content-Type", "audio/ogg")
        self.end_headers()  # no length: the body ends with the connection
        self.wfile.write(b"OggS" * 500)

    def log_message(self, *a):
        pass


@pytest.fixture
def shelf():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Shelf)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()
    server.server_close()


def test_download_follows_redirects(shelf, tmp_path):
    got = download.download_media(f"{shelf}/old?sig=zero", tmp_path / "new" / "folder", allow_private_hosts=True)
    file = tmp_path / "new" / "folder" / "Lecture 1.ogg"
    assert file.read_bytes() == b"OggS" * 500 and got["path"] == str(file) and got["bytes"] == 2000 and got["content_type"] == "audio/ogg"
    assert got["source_url"] == f"{shelf}/old" and got["resolved_url"] == f"{shelf}/shelf/Lecture%201.ogg" and got["url_query_redacted"]
    assert json.loads((file.parent / "download.json").read_text()) == got and "sig" not in json.dumps(got)
    with pytest.raises(SystemExit, match="exists already"):
        download.download_media(f"{shelf}/old", file.parent, allow_private_hosts=True)
    assert download.download_media(f"{shelf}/nameless", tmp_path, allow_private_hosts=True)["path"] == str(tmp_path / "shelf")


def test_downloads_that_are_refused(shelf, tmp_path, monkeypatch):
    with pytest.raises(SystemExit, match="larger than 1999 bytes"):
        download.download_media(f"{shelf}/shelf/a.ogg", tmp_path, allow_private_hosts=True, limit=1999)
    assert not list(tmp_path.iterdir())
    with pytest.raises(Exception, match="loop|redirect"):
        download.download_media(f"{shelf}/round", tmp_path, allow_private_hosts=True)
    with pytest.raises(SystemExit, match="private host"):
        download.download_media(f"{shelf}/shelf/a.ogg", tmp_path)
    # the first host passes, the one that it sends to does not
    plain = download.socket.getaddrinfo
    monkeypatch.setattr(download.socket, "getaddrinfo", lambda host, *a, **k: [(2, 1, 6, "", ("93.184.216.34", 80))] if host == "127.0.0.1" and not seen.append(host) and len(seen) == 1 else plain(host, *a, **k))
    seen = []
    handler = download._Checked(False)
    assert download.validate_url(f"{shelf}/inside")
    with pytest.raises(SystemExit, match="private host"):
        handler.redirect_request(None, None, 307, "", {}, "http://127.0.0.1:1/x.ogg")


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_equal_the_plain_table():
    rnd = random.Random(3)
    for _ in range(400):
        a, b = (["".join(rnd.choice("abé日")) for _ in range(rnd.randrange(80))] for _ in range(2))
        assert distance.edits(a, b) == distance.edits("".join(a), "".join(b)) == plain_edits(a, b)


def test_windows_hold_every_character_and_word(spark):
    """Accents, empty and null texts, differences far behind: the sums of windows are those of plain tables."""
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(200)] + ["Über", "niño", "日本語", "été!", "𝄞"]
    texts = [(" ".join(rnd.choices(vocabulary, k=100 + 40 * i)), " ".join(rnd.choices(vocabulary, k=130))) for i in range(4)] + [("", "é x"), (None, "a b"), ("a", None), ("", "")]
    make = lambda side: spark.createDataFrame([("r", i, t[side]) for i, t in enumerate(texts)], "rec string, window bigint, text string")
    cut = lambda x, n: [x[i : i + n] for i in range(0, len(x), n)]
    split = lambda t: [w for w in (re.sub(r"[^\w\s]", "", x.lower()).replace("𝄞", "") for x in (t or "").split()) if w]
    for got, pieces in (
        (disagree.windows_by_characters(disagree.char_windows(make(0), make(1))), [(cut(a or "", 45), cut(b or "", 45)) for a, b in texts]),
        (disagree.windows_by_words(disagree.word_windows(make(0), make(1))), [(cut(split(a), 45), cut(split(b), 45)) for a, b in texts]),
    ):
        want = {(i, k): plain_edits(a[k] if k < len(a) else "", b[k] if k < len(b) else "") for i, (a, b) in enumerate(pieces) for k in range(max(len(a), len(b)))}
        assert {(r["window"], r["part"]): r["edits"] for r in got.collect()} == want


def test_words_of_any_number(spark):
    n = 40_000
    a, b = (F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit(x), i.cast("string"))) for x in "ax")
    assert one(spark, distance.word_edits(a, F.concat(F.slice(a, 3, n), F.slice(b, 1, 3)))) == 5


def test_whole_documents_disagree(spark, tmp_path):
    """Accents, differences after character 240, and more than 90 distinct words."""
    from cuewise.plans import catalogue

    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Über", "niño", "日本語", "été!"]
    texts = [" ".join(rnd.choices(vocabulary, k=150 + i)) for i in range(6)]
    texts += ["same " * 60 + "left", "same " * 60 + "right", "", "é", None, "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    split = lambda t: [w for w in re.sub(r"[^\w\s]", "", t.lower()).split() if w]
    pairs = [(i // 2, texts[i], texts[i + 1]) for i in range(0, len(texts), 2)]
    got = {r["window"]: (r["n_chars"], r["edits"]) for r in catalogue.char_disagreement_whole(spark, str(tmp_path)).collect()}
    assert got == {k: (None, None) if a is None else (len(a), plain_edits(a, b)) for k, a, b in pairs}
    want = {k: (len(split(a)), plain_edits(split(a), split(b))) for k, a, b in pairs if a is not None}
    got = {r["window"]: (r["n_words"], r["edits"]) for r in catalogue.word_disagreement_whole(spark, str(tmp_path)).collect()}
    assert {k: got[k] for k in want} == want
    total = catalogue.disagreement_total_whole(spark, str(tmp_path)).where("rec is null").first()
    assert (total["n_words"], total["edits"]) == tuple(map(sum, zip(*want.values(), strict=True)))
