"""Speech models as sources: a pluggable function from a media file to rows, run by Arrow on the executors.

No model comes with this package. A recogniser is built once per Python worker from a picklable factory.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

# Parameters of the two recognition modes and of diarization.
MODES = {
    "moss": {"max_tokens": 65_536, "temperature": 0.0, "prefill_step_size": 4096},
    "whisper": {"language": "en", "chunk_duration": 30.0, "word_timestamps": False},
}
DIARIZATION = {"threshold": 0.5, "min_duration": 0.25, "merge_gap": 0.2}

#: One row per segment, and one with ord null per file, which holds what is known of the run as a whole.
ROWS = (
    "rec string, ord bigint, id bigint, start double, end double, speaker string, speaker_id string, text string, temperature double, avg_logprob double, "
    "compression_ratio double, no_speech_prob double, load_s double, infer_s double, peak_gb double, prompt_tokens bigint, generation_tokens bigint"
)
_RUN = ("load_s", "infer_s", "peak_gb", "prompt_tokens", "generation_tokens")


def infer(files: DataFrame, factory: Callable[[], Callable[[bytes, dict], list[dict] | dict]], options: dict) -> DataFrame:
    """files: path, content (as of binaryFile). The model gets the bytes and the options and gives segments, or a dict of
    segments, text, prompt_tokens, generation_tokens and peak_gb. A file without segments has its run's row."""
    schema = T.StructType.fromDDL(ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        began = time.perf_counter()
        model = factory()
        load = time.perf_counter() - began
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                t = time.perf_counter()
                found = model(content, options)
                took = time.perf_counter() - t
                found = {"segments": found} if isinstance(found, list) else found
                own = {"rec": path, "text": found.get("text"), "load_s": load, "infer_s": took, "peak_gb": found.get("peak_gb")}
                own |= {c: found.get(c) or 0 for c in ("prompt_tokens", "generation_tokens")}
                rows = [own, *({**s, "rec": path, "ord": i, "speaker": None if s.get("speaker") is None else str(s["speaker"])} for i, s in enumerate(found.get("segments") or []))]
                yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in schema} for r in rows], schema=to_arrow_schema(schema))

    return files.select("path", "content").mapInArrow(run, ROWS)


def segments(rows: DataFrame) -> DataFrame:
    """The segments of a run."""
    return rows.where("ord is not null").drop(*_RUN)


def recognise(files: DataFrame, factory, mode: str, prompt: str = "", **options) -> DataFrame:
    """One mode takes the prompt as it is, the other as initial_prompt, where an empty one counts as none."""
    own = {"prompt": prompt} if mode == "moss" else {"initial_prompt": prompt or None}
    return infer(files, factory, MODES[mode] | own | options)


def diarize(files: DataFrame, factory, **options) -> DataFrame:
    """Segments have a numbered speaker."""
    return infer(files, factory, DIARIZATION | options)


def metrics(rows: DataFrame, files: DataFrame, model: str, mode: str | None = None, options: dict | None = None) -> DataFrame:
    """One row per recording of files (rec, audio_s), also without segments: all fields of the run's JSON document.

    mode: of a recognition; None for a diarization, whose options are told instead.
    """
    run = rows.where("ord is null").select("rec", *_RUN)
    each = rows.where("ord is not null").groupBy("rec").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("speaker").alias("speakers"))
    j = files.select("rec", "audio_s").join(run, "rec", "left").join(each, "rec", "left")
    out = with_speed(j).select(
        "rec",
        F.lit(model).alias("model"),
        F.col("audio_s").alias("audio_duration_seconds"),
        F.col("load_s").alias("load_seconds"),
        F.col("infer_s").alias("inference_seconds"),
        (F.col("load_s") + F.col("infer_s")).alias("wall_seconds"),
        F.col("rtf").alias("realtime_factor"),
        F.col("speed").alias("realtime_speed"),
        F.col("peak_gb").alias("peak_mlx_memory_gb"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("segment_count"),
        *([F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("prompt_tokens", "generation_tokens")] if mode else [F.coalesce("speakers", F.lit(0)).cast("bigint").alias("num_speakers")]),
    )
    if mode:
        return out.withColumn("mode", F.lit(mode)).withColumn("audio", F.col("rec").cast("string"))
    return out.withColumns({c: F.lit(float(v)) for c, v in (DIARIZATION | (options or {})).items()})


def with_speed(df: DataFrame) -> DataFrame:
    return df.withColumn("rtf", F.col("infer_s") / F.col("audio_s")).withColumn("speed", F.col("audio_s") / F.col("infer_s"))
