"""Interval joins and merges on the millisecond axis of a recording.

Every join is an equi-join on the recording and a time bucket, so that long recordings spread over many tasks; a
pair is kept in one bucket only, the later of its two first ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 300_000


def overlap_ms(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.least(e1, e2) - F.greatest(s1, s2))


def _bucket(ms: Column, width: int) -> Column:
    return F.floor(ms / width).cast("bigint")


def overlap_join(left: DataFrame, right: DataFrame, on: tuple[str, ...] = ("rec",), width: int = BUCKET_MS) -> DataFrame:
    """Pairs that overlap. Columns of the right side are prefixed r_; overlap_ms is added."""

    def spread(df: DataFrame, prefix: str) -> DataFrame:
        lo = _bucket(F.col("start_ms"), width)
        hi = _bucket(F.greatest(F.col("end_ms") - 1, F.col("start_ms")), width)
        out = df.select(*[F.col(c).alias(prefix + c) for c in df.columns], lo.alias(f"{prefix}_lo"), F.explode(F.sequence(lo, hi)).alias(f"{prefix}_b"))
        return out

    a, b = spread(left, ""), spread(right, "r_")
    same = F.col("_b") == F.col("r__b")
    for c in on:
        same &= F.col(c) == F.col(f"r_{c}")
    here = F.col("_b") == F.greatest("_lo", "r__lo")
    meets = (F.col("start_ms") < F.col("r_end_ms")) & (F.col("r_start_ms") < F.col("end_ms"))
    j = a.join(b, same & here & meets)
    return j.withColumn("overlap_ms", overlap_ms(F.col("start_ms"), F.col("end_ms"), F.col("r_start_ms"), F.col("r_end_ms"))).drop("_lo", "_b", "r__lo", "r__b")


def assign_speakers(segments: DataFrame, turns: DataFrame, key: str = "ord", width: int = BUCKET_MS) -> DataFrame:
    """Each segment with the speaker whose turns cover most of it; of equals the first name; else UNKNOWN."""
    met = overlap_join(segments.select("rec", key, "start_ms", "end_ms"), turns.select("rec", "speaker", "start_ms", "end_ms"), width=width)
    sums = met.groupBy("rec", key, F.col("r_speaker").alias("assigned")).agg(F.sum("overlap_ms").alias("covered_ms"))
    # the most covered, then the smallest name: one aggregate, no sort of a group
    best = sums.groupBy("rec", key).agg(F.max("covered_ms").alias("covered_ms"), F.min_by("assigned", F.struct(-F.col("covered_ms"), "assigned")).alias("assigned"))
    out = segments.join(best, ["rec", key], "left")
    return out.withColumn("assigned", F.coalesce("assigned", F.lit("UNKNOWN"))).withColumn("covered_ms", F.coalesce("covered_ms", F.lit(0).cast("bigint")))


def owned(segments: DataFrame, chunks: DataFrame, width: int = BUCKET_MS, chunk_known: bool = False) -> DataFrame:
    """Segments with the chunk whose core holds their midpoint, [lo, hi); the last core of a recording is closed.

    chunk_known: segments carry the chunk that they were decoded in, and only that one may own them.
    """
    twice = F.col("start_ms") + F.col("end_ms")
    last = F.max("core_hi_ms").over(Window.partitionBy("rec"))
    cores = chunks.select("rec", F.col("chunk").alias("_chunk"), "core_lo_ms", "core_hi_ms", last.alias("_last"))
    cores = cores.withColumn("_b", F.explode(F.sequence(_bucket(F.col("core_lo_ms"), width), _bucket(F.greatest("core_hi_ms", "core_lo_ms"), width))))
    rows = segments.withColumn("_b", _bucket(F.floor(twice / 2), width))
    on = ["rec", "_b"]
    inside = (twice >= 2 * F.col("core_lo_ms")) & ((twice < 2 * F.col("core_hi_ms")) | ((F.col("core_hi_ms") == F.col("_last")) & (twice == 2 * F.col("_last"))))
    j = rows.join(cores, on).where(inside)
    if chunk_known:
        return j.where(F.col("chunk") == F.col("_chunk")).drop("_b", "_chunk", "core_lo_ms", "core_hi_ms", "_last")
    return j.withColumn("chunk", F.col("_chunk")).drop("_b", "_chunk", "core_lo_ms", "core_hi_ms", "_last")


def decoded(segments: DataFrame, chunks: DataFrame, width: int = BUCKET_MS) -> DataFrame:
    """What each chunk sees of the segments: those whose midpoint lies in its decoded span (with context)."""
    twice = F.col("start_ms") + F.col("end_ms")
    spans = chunks.select("rec", "chunk", "dec_lo_ms", "dec_hi_ms").withColumn("_b", F.explode(F.sequence(_bucket(F.col("dec_lo_ms"), width), _bucket(F.col("dec_hi_ms"), width))))
    rows = segments.withColumn("_b", _bucket(F.floor(twice / 2), width))
    inside = (twice >= 2 * F.col("dec_lo_ms")) & (twice < 2 * F.col("dec_hi_ms"))
    return rows.join(spans, ["rec", "_b"]).where(inside).drop("_b", "dec_lo_ms", "dec_hi_ms")


def merge_chunks(parts: DataFrame, chunks: DataFrame, width: int = BUCKET_MS) -> DataFrame:
    """Rows decoded by several overlapping chunks, each kept once: by the chunk that owns its midpoint."""
    return owned(parts, chunks, width, chunk_known=True)


def within(rows: DataFrame, lo_ms: Column | int, hi_ms: Column | int) -> DataFrame:
    """Rows that start in a window, [lo, hi)."""
    lo, hi = (F.lit(x) if isinstance(x, int) else x for x in (lo_ms, hi_ms))
    return rows.where((F.col("start_ms") >= lo) & (F.col("start_ms") < hi))


def active(frames: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Frames (rec, speaker, start_ms, end_ms, score) in which a speaker's activity reaches the threshold; null and NaN do not."""
    return frames.where(~F.isnan("score") & (F.col("score") >= threshold))


def turns_from_frames(frames: DataFrame, threshold: float = 0.5, gap_ms: int = 200, min_ms: int = 250) -> DataFrame:
    """Scored frames as turns: active ones, merged over short gaps, without the shortest."""
    return gap_merge(active(frames, threshold), gap_ms, min_ms)


def gap_merge(turns: DataFrame, gap_ms: int = 200, min_ms: int = 250) -> DataFrame:
    """Turns of one speaker no further apart than gap_ms become one; what is shorter than min_ms then goes."""
    w = Window.partitionBy("rec", "speaker").orderBy("start_ms", "end_ms")
    until = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(until.isNull() | (F.col("start_ms") - until > gap_ms), 1).otherwise(0)
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    merged = turns.withColumn("_new", new).withColumn("_island", island).groupBy("rec", "speaker", "_island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count(F.lit(1)).alias("n_turns"))
    return merged.drop("_island").where(F.col("end_ms") - F.col("start_ms") >= min_ms)


def nearest_boundary(a: DataFrame, b: DataFrame, width: int = 12 * BUCKET_MS) -> DataFrame:
    """For every start of a the distance to the nearest start of b in the recording (null if b has none there).

    Both are laid on one axis, cut into buckets of width, and each bucket is swept forwards and backwards by frames that only
    grow: linear, where comparing pairs is quadratic, and one long recording is swept by many tasks. What the buckets beside
    hold comes in as two more boundaries, from a window over one row for each bucket.
    """
    x = a.select("rec", F.col("start_ms").alias("t"), F.lit(1).alias("side"), F.col("ord"))
    y = b.select("rec", F.col("start_ms").alias("t"), F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("ord"))
    rows = x.unionByName(y).withColumn("_b", _bucket(F.col("t"), width))
    mark = F.when(F.col("side") == 0, F.col("t"))
    ends = rows.groupBy("rec", "_b").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi"))
    grow = lambda *order: Window.partitionBy("rec").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("rec", "_b", F.array(F.last("hi", True).over(grow("_b")), F.last("lo", True).over(grow(F.desc("_b")))).alias("_ts"))
    carried = carried.select("rec", F.explode("_ts").alias("t"), F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("ord"), "_b").where("t is not null")
    every = rows.unionByName(carried)
    upto = lambda *order: Window.partitionBy("rec", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = every.withColumn("_p", F.last(mark, True).over(upto("t", "side"))).withColumn("_n", F.last(mark, True).over(upto(F.desc("t"), "side"))).where("side = 1")
    return swept.select("rec", "ord", F.col("t").alias("start_ms"), F.least(F.col("t") - F.col("_p"), F.col("_n") - F.col("t")).alias("distance_ms"))


def boundary_stats(distances: DataFrame) -> DataFrame:
    d = F.col("distance_ms")
    return distances.where(d.isNotNull()).groupBy("rec").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile(d, F.lit(0.5)).alias("median_ms"),
        F.avg((d <= 500).cast("int")).alias("share_500ms"),
        F.avg((d <= 1000).cast("int")).alias("share_1s"),
    )
