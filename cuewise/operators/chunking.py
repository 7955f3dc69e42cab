"""Chunk planning, and labels that hold across chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefmt
from . import intervals

MIN_MS, TARGET_MS, MAX_MS, CONTEXT_MS = 20 * 60_000, 25 * 60_000, 30 * 60_000, 8_000


def silences(turns: DataFrame, least_ms: int) -> DataFrame:
    """Gaps of at least least_ms between what any speaker says: rec, lo_ms, hi_ms."""
    w = Window.partitionBy("rec").orderBy("start_ms", "end_ms")
    until = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return turns.withColumn("lo_ms", until).where(F.col("start_ms") - F.col("lo_ms") >= least_ms).select("rec", "lo_ms", F.col("start_ms").alias("hi_ms"))


def plan(recordings: DataFrame, silences: DataFrame, shortest: int = MIN_MS, target: int = TARGET_MS, longest: int = MAX_MS, context: int = CONTEXT_MS) -> DataFrame:
    """recordings: rec, duration_ms. Chunks whose cores tile a recording.

    From a cut the next one is the middle of the silence nearest to target, not before shortest and not after longest;
    of equals the earlier; without one at longest, marked as fallback. What is no longer than longest ends the plan.
    Each recording is one row with its sorted silences, so the chain of cuts is a fold within that row.
    """
    points = silences.groupBy("rec").agg(F.sort_array(F.collect_set(F.floor((F.col("lo_ms") + F.col("hi_ms")) / 2).cast("bigint"))).alias("points"))
    rows = recordings.join(points, "rec", "left").withColumn("points", F.coalesce("points", F.array().cast("array<bigint>")))
    zero = F.lit(0).cast("bigint")
    cut = "struct<lo:bigint,hi:bigint,fallback:boolean>"
    start = F.struct(zero.alias("pos"), F.array().cast(f"array<{cut}>").alias("cuts"))

    def step(state: Column, _: Column) -> Column:
        pos, d = state["pos"], F.col("duration_ms")
        near = F.filter(F.col("points"), lambda p: (p >= pos + shortest) & (p <= pos + longest))
        best = F.array_min(F.transform(near, lambda p: F.struct(F.abs(p - (pos + target)).alias("off"), p.alias("p"))))["p"]
        last = d - pos <= longest
        hi = F.when(last, d).otherwise(F.coalesce(best, pos + longest))
        one = F.struct(pos.alias("lo"), hi.alias("hi"), (~last & best.isNull()).alias("fallback"))
        more = F.struct(hi.alias("pos"), F.concat(state["cuts"], F.array(one)).alias("cuts"))
        return F.when(pos >= d, state).otherwise(more)

    turns = F.sequence(F.lit(1), F.ceil(F.col("duration_ms") / shortest).cast("int") + 1)
    cuts = rows.select("rec", "duration_ms", F.posexplode(F.aggregate(turns, start, step)["cuts"]).alias("pos", "c"))
    return cuts.select(
        "rec",
        (F.col("pos") + 1).cast("bigint").alias("chunk"),
        F.greatest(F.col("c.lo") - context, zero).alias("dec_lo_ms"),
        F.least(F.col("c.hi") + context, F.col("duration_ms")).alias("dec_hi_ms"),
        F.col("c.lo").alias("core_lo_ms"),
        F.col("c.hi").alias("core_hi_ms"),
        F.col("c.fallback").alias("fallback"),
    )


def anonymous_labels(rows: DataFrame, speaker: str = "speaker") -> DataFrame:
    """Generated names give way to SPK01, SPK02, ... in order of first appearance within a recording and chunk."""
    first = rows.groupBy("rec", "chunk", speaker).agg(F.min(F.struct("start_ms", speaker)).alias("_first"))
    n = F.dense_rank().over(Window.partitionBy("rec", "chunk").orderBy("_first"))
    return rows.join(first.withColumn("label", timefmt.speaker_label(n)).drop("_first"), ["rec", "chunk", speaker])


def matched_labels(decoded: DataFrame, least_ms: int = 1000, width: int = intervals.BUCKET_MS) -> DataFrame:
    """Label pairs of adjacent chunks: each is the other's best on the audio they share, by at least least_ms.

    decoded: rec, chunk, label, start_ms, end_ms.
    """
    rows = decoded.select("rec", "chunk", "label", "start_ms", "end_ms")
    met = intervals.overlap_join(rows.withColumn("nextc", F.col("chunk") + 1), rows.withColumn("nextc", F.col("chunk")), on=("rec", "nextc"), width=width)
    sums = met.groupBy("rec", "chunk", F.col("r_chunk").alias("next_chunk"), "label", F.col("r_label").alias("next_label")).agg(F.sum("overlap_ms").alias("shared_ms"))
    a = F.row_number().over(Window.partitionBy("rec", "chunk", "label").orderBy(F.desc("shared_ms"), "next_label"))
    b = F.row_number().over(Window.partitionBy("rec", "next_chunk", "next_label").orderBy(F.desc("shared_ms"), "label"))
    return sums.withColumn("_a", a).withColumn("_b", b).where((F.col("_a") == 1) & (F.col("_b") == 1) & (F.col("shared_ms") >= least_ms)).drop("_a", "_b")


def reconcile(decoded: DataFrame, least_ms: int = 1000) -> DataFrame:
    """rec, chunk, label, speaker: one speaker label for a chain of matched labels, numbered by its first chunk and label.

    A label has at most one match before it and one after, so chains are followed in one pass over a recording's labels in
    order of chunks. Only labels meet in a task (a few for every 25 minutes of a recording), never segments.
    """
    pairs = matched_labels(decoded, least_ms)
    nodes = decoded.select("rec", "chunk", "label").distinct()
    back = pairs.select("rec", F.col("next_chunk").alias("chunk"), F.col("next_label").alias("label"), F.col("chunk").alias("_chunk"), F.col("label").alias("_label"))
    linked = nodes.join(back, ["rec", "chunk", "label"], "left")

    def follow(own: pd.DataFrame) -> pd.DataFrame:
        own, roots = own.sort_values(["chunk", "label"], ignore_index=True), {}
        for chunk, label, before, known in zip(own["chunk"], own["label"], own["_chunk"], own["_label"], strict=True):
            roots[chunk, label] = (chunk, label) if known is None else roots[int(before), known]
        number = {root: f"SPK{i:02d}" for i, root in enumerate(sorted(set(roots.values())), 1)}
        return own[["rec", "chunk", "label"]].assign(speaker=[number[r] for r in roots.values()])

    schema = T.StructType([*(linked.schema[c] for c in ("rec", "chunk", "label")), T.StructField("speaker", T.StringType())])
    return linked.groupBy("rec").applyInPandas(follow, schema)


def stated_silences(rows: DataFrame) -> DataFrame:
    """Silences as a detector gives them, rec, start and end in seconds, as rec, lo_ms, hi_ms; what has no length goes."""
    out = rows.select("rec", timefmt.to_ms(F.col("start")).alias("lo_ms"), timefmt.to_ms(F.col("end")).alias("hi_ms"))
    return out.where("hi_ms > lo_ms")
