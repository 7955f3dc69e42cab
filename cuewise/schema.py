"""Declared schemas (as DDL): a missing field reads as null, and nothing is inferred."""

from __future__ import annotations

#: One transcript document: scans of diarized and of recognised speech share it.
SEGMENT = "struct<id:bigint,start:double,end:double,text:string,speaker_id:string,temperature:double,avg_logprob:double,compression_ratio:double,no_speech_prob:double>"
TRANSCRIPT = (f"text string, segments array<{SEGMENT}>")
TURNS = ("segments array<struct<start:double,end:double,speaker:string>>")
MANIFEST = ("chunks array<struct<chunk:int,decoded_start:double,decoded_end:double,core_start:double,core_end:double,fallback:boolean>>")
REVIEWED = (
    "metadata struct<title:string,source_file:string,source_language:string>, "
    "speakers array<struct<id:string,display_name:string,confidence:string,evidence:string>>, "
    "segments array<struct<start:double,end:double,speaker:string,source:string,calibrated:string,zh:string,uncertain:boolean>>, "
    "unresolved array<struct<start:double,type:string,note:string>>"
)
SILENCES = "silences array<struct<start:double,end:double>>"
RECORDING = "duration double, sample_rate int, channels int, codec string"

#: The documents that this package writes, to scan them again.
_KEPT = "struct<id:bigint,start:double,end:double,text:string,avg_logprob:double,no_speech_prob:double>"
REVIEW = (
    "status string, speaker_labels boolean, source string, cutoff_seconds double, postprocessing string, source_segment_count bigint, "
    f"segment_count bigint, rejected struct<empty_text:bigint,invalid_or_zero_duration:bigint,after_cutoff:bigint>, segments array<{_KEPT}>"
)
DIARIZED = "source string, status string, postprocessing array<string>, segments array<struct<start:double,end:double,speaker:string,original_speaker_id:string,text:string>>"
TAGGED = (
    "status string, warning string, source string, chunk string, offset_seconds double, segment_count bigint, speaker_guess_counts map<string,bigint>, "
    "segments array<struct<id:bigint,chunk:string,relative_start:double,relative_end:double,absolute_start:double,absolute_end:double,model_speaker_guess:string,text:string>>"
)
LABELLED = "segments array<struct<start:double,end:double,speaker:string,text:string>>"
_TIMES = "load_seconds:double,inference_seconds:double,wall_seconds:double,realtime_factor:double,realtime_speed:double,peak_mlx_memory_gb:double"
BENCHMARK = (
    f"metrics struct<mode:string,model:string,audio:string,audio_duration_seconds:double,{_TIMES},prompt_tokens:bigint,generation_tokens:bigint,"
    f"segment_count:bigint>, text string, segments array<{SEGMENT}>"
)
DIARIZATION = (
    f"metrics struct<model:string,audio_duration_seconds:double,{_TIMES},num_speakers:bigint,segment_count:bigint,threshold:double,"
    "min_duration:double,merge_gap:double>, segments array<struct<start:double,end:double,speaker:int>>"
)
WORDS = "audio string, segments array<struct<id:bigint,text:string,words:array<struct<word:string,start:double,end:double>>>>"
