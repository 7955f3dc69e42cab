"""The queries of the ten operators and the pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from . import audio, dac, langid, mixing, neardup, packing, rules, secrets, toxicity, urls
from .common import read

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return rules.judge(read(spark, sf_dir, "documents"))


def rule_ablations(spark, sf_dir):
    return rules.all_ablations(read(spark, sf_dir, "documents"))


def op4_secret_scans(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents"))


def op5_near_dedup(spark, sf_dir):
    return neardup.find(read(spark, sf_dir, "documents"), 0.85)


def op6_url_filters(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"))


def op7_language_id(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_chroma_fingerprints(spark, sf_dir):
    return audio.conversations(read(spark, sf_dir, "conversations"))


def op9_addressable_codes(spark, sf_dir):
    return dac.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark, sf_dir):
    return toxicity.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "rule_ablations": rule_ablations,
    "op4_secret_scans": op4_secret_scans,
    "op5_near_dedup": op5_near_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_language_id": op7_language_id,
    "op8_chroma_fingerprints": op8_chroma_fingerprints,
    "op9_addressable_codes": op9_addressable_codes,
    "op10_toxicity": op10_toxicity,
    "pipeline": pipeline,
}
ORACLE_SQL = {"op2_mixing": mixing.ORACLE, "op3_quality_rules": rules.ORACLE, "rule_ablations": rules.ABLATIONS_ORACLE, "op6_url_filters": urls.ORACLE}
