"""Chroma audio fingerprints, and the alignment of recordings by offset histograms and bit errors.

A recording (samples at RATE) becomes frames of energy by pitch class. Sixteen filters compare rectangles of the frames,
read off an integral image; each answer is cut into four grades, Gray-coded in two bits, so every position gives one
packed 32-bit integer. All recordings are indexed by their keys, pairs of neighbouring integers, each distinct
key of a recording once. A query is fingerprinted at PHASES starts within one hop, so that one of them is within 4 samples
of the frames of any recording that it was cut from. Two recordings are candidates at every offset at which a key agrees;
the votes of an offset are its histogram. Each candidate offset is verified by the share of differing bits in its
best stretch of STRETCH integers, or in the whole overlap if that is shorter, and all recordings that pass are links.

The driver's tables hold no audio. `render` stands in for it: every word of a text is a tone of one hop whose pitch class
is a hash of the word, so equal passages sound alike. `wav` reads files, and `fingerprint` takes samples from anywhere.

Defined results: null samples or texts without words give no integers and match nothing; recordings shorter than the
widest filter are padded with silence and give one integer; recordings with equal integers are folded into one class before
anything is joined, whatever their ids (null or repeated ones included), and links are between classes; overlaps of fewer
than LEAST integers link nothing; recordings of any length are read whole; of links of one query with equal errors the
one with the smaller class comes first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import io
import wave
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import limit, scratch, skew_join, table, text_bytes

RATE, HOP, FRAME = 4096, 128, 256
WIDEST, PHASES = 16, 16
#: Integers of unrelated recordings differ in half of their bits, and in no stretch in fewer than 0.32.
MOST_ERRORS, STRETCH, LEAST = 0.25, 24, 8
#: Heavy keys of the index are dealt to so many tasks, and the queries that hold them go to each.
SALTS = 64
CUTS = (-0.4, 0.0, 0.4)
GRAY = np.asarray([0, 1, 3, 2], np.uint32)
#: Filters by rule: kind (over time, over pitch, both, centre against flanks), lowest pitch class, height, width.
FILTERS = tuple((i % 4, (5 * i) % 9, 3 + i % 4 if (5 * i) % 9 + 3 + i % 4 <= 12 else 3, (4, 8, 12, 16)[(i // 4 + i) % 4]) for i in range(16))


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Which pitch class each frequency bin feeds."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(hz), 12), np.float32)
    heard = np.flatnonzero((hz >= 800) & (hz <= 1800))
    out[heard, np.round(12 * np.log2(hz[heard] / 880)).astype(int) % 12] = 1
    return out


def render(text: bytes) -> np.ndarray:
    """A tone for every word."""
    words = text.split()
    t = np.arange(HOP) / RATE
    tones = np.sin(2 * np.pi * 880 * 2 ** (np.arange(12)[:, None] / 12) * t).astype(np.float32)
    return tones[np.fromiter((zlib.crc32(w.lower()) % 12 for w in words), np.int64, len(words))].ravel()


def chroma(samples: np.ndarray) -> np.ndarray:
    """Frames by pitch class, each of length 1 or silent."""
    n = -(-len(samples) // HOP)
    padded = np.zeros((n + 1) * HOP, np.float32)
    padded[: len(samples)] = samples
    out = np.zeros((n, 12), np.float32)
    window = np.hanning(FRAME).astype(np.float32)
    for i in range(0, n, 4096):
        part = np.lib.stride_tricks.sliding_window_view(padded[i * HOP : (min(n, i + 4096) + 1) * HOP], FRAME)[::HOP]
        out[i : i + len(part)] = (np.abs(np.fft.rfft(part * window, axis=1)) ** 2) @ _classes()
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(size > 1e-6, out / np.maximum(size, 1e-6), 0)


def codes(frames: np.ndarray) -> np.ndarray:
    """One packed integer for each position that the widest filter fits."""
    if not len(frames):
        return np.zeros(0, np.uint32)
    if len(frames) < WIDEST:
        frames = np.vstack([frames, np.zeros((WIDEST - len(frames), 12))])
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(0).cumsum(1)
    n = len(frames) - WIDEST + 1

    def area(x: int, y: int, w: int, h: int) -> np.ndarray:
        return image[x + w : x + w + n, y + h] - image[x : x + n, y + h] - image[x + w : x + w + n, y] + image[x : x + n, y]

    out = np.zeros(n, np.uint32)
    for kind, y, h, w in FILTERS:
        half, low = w // 2, h // 2
        if kind == 0:
            a, b = area(0, y, half, h), area(half, y, w - half, h)
        elif kind == 1:
            a, b = area(0, y, w, low), area(0, y + low, w, h - low)
        elif kind == 2:
            a, b = area(0, y, half, low) + area(half, y + low, w - half, h - low), area(half, y, w - half, low) + area(0, y + low, half, h - low)
        else:
            q = w // 4
            b = area(q, y, w - 2 * q, h)
            a = area(0, y, w, h) - b
        grade = np.searchsorted(CUTS, np.log((1 + np.maximum(a, 0)) / (1 + np.maximum(b, 0))))
        out = (out << np.uint32(2)) | GRAY[grade]
    return out


def wav(content: bytes) -> np.ndarray:
    """Samples at RATE of a WAV file (8, 16 or 32 bits, any number of channels), by linear interpolation."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate, raw = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.readframes(f.getnframes())
    kind, zero, full = {1: ("u1", 128, 128), 2: ("<i2", 0, 1 << 15), 4: ("<i4", 0, 1 << 31)}[width]
    x = (np.frombuffer(raw, kind).astype(np.float64).reshape(-1, channels).mean(1) - zero) / full
    if rate > RATE:  # average over a sample's length first, against aliases
        n = rate // RATE
        x = np.convolve(x, np.ones(n) / n, "same") if len(x) else x
    return np.interp(np.arange(len(x) * RATE // rate) * rate / RATE, np.arange(len(x)), x).astype(np.float32) if len(x) else x.astype(np.float32)


def keys(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 64-bit keys of two integers in a row (the last one pairs with itself), and their first places."""
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    later = np.concatenate([c[1:], c[-1:]]) if len(c) == 1 else c[1:]
    k = ((c[: len(later)].astype(np.uint64) << np.uint64(32)) | later).view(np.int64)
    return np.unique(k, return_index=True)


def bit_errors(a: np.ndarray, b: np.ndarray, offset: int) -> float:
    """The share of differing bits in the best stretch where b, shifted by offset, overlaps a; 1 without enough overlap."""
    lo, hi = max(0, offset), min(len(a), len(b) + offset)
    if hi - lo < LEAST:
        return 1.0
    n = min(STRETCH, hi - lo)
    upto = np.concatenate([[0], np.cumsum(np.bitwise_count(a[lo:hi] ^ b[lo - offset : hi - offset]), dtype=np.int64)])
    return float((upto[n:] - upto[:-n]).min()) / (32 * n)


def phases(samples: np.ndarray) -> list[np.ndarray]:
    """The integers of a recording from PHASES starts within its first hop."""
    return [codes(chroma(samples[p * HOP // PHASES :])) for p in range(PHASES)]


def fingerprint(recordings: DataFrame, keep: list[str], samples: str, convert=None, query=None) -> DataFrame:
    """keep, n_codes, codes_crc32, codes (little-endian unsigned 32-bit), phases (an array of such, only where query, a
    column, is true). samples: little-endian 32-bit floats, or what convert turns into them (wav does)."""
    schema = ", ".join([*(f"`{k}` {recordings.schema[k].dataType.simpleString()}" for k in keep), "n_codes long, codes_crc32 long, codes binary, phases array<binary>"])

    def run(batches):
        import pyarrow as pa

        packed = lambda x: x.astype("<u4").tobytes()
        for b in batches:
            got, every = [], []
            for x, q in zip(b.column("_samples"), b.column("_query").to_pylist(), strict=True):
                raw = x.as_py()
                own = np.zeros(0, np.float32) if not raw else convert(raw) if convert else np.frombuffer(raw, "<f4")
                if q and len(own):
                    every.append(list(map(packed, phases(own))))
                    got.append(every[-1][0])
                else:
                    every.append(None)
                    got.append(packed(codes(chroma(own))))
            columns = [pa.array([len(c) // 4 for c in got], pa.int64()), pa.array([zlib.crc32(c) for c in got], pa.int64()), pa.array(got, pa.binary()), pa.array(every, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *columns], names=[*keep, "n_codes", "codes_crc32", "codes", "phases"])

    asked = F.lit(False) if query is None else F.coalesce(query, F.lit(False))
    return recordings.select(*keep, F.col(samples).alias("_samples"), asked.alias("_query")).mapInArrow(run, schema)


INDEX = "c long, k long, at long"


def _index(batches):
    import pyarrow as pa

    for b in batches:
        for c, own in zip(b.column("c").to_pylist(), b.column("codes"), strict=True):
            k, at = keys(np.frombuffer(own.as_py(), "<u4"))
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(k), pa.int64()), pa.array(k), pa.array(at)], names=["c", "k", "at"])


def _asked(batches):
    import pyarrow as pa

    for b in batches:
        for c, every in zip(b.column("c").to_pylist(), b.column("phases").to_pylist(), strict=True):
            for p, own in enumerate(every):
                k, at = keys(np.frombuffer(own, "<u4"))
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(k), pa.int64()), pa.array([p] * len(k), pa.int32()), pa.array(k), pa.array(at)], names=["a", "phase", "k", "at_a"])


def _verified(batches):
    import pyarrow as pa

    for t in batches:
        out = []
        for a, b, every, other, spots in zip(*(t.column(c).to_pylist() for c in ("a", "b", "phases", "codes", "spots")), strict=True):
            other = np.frombuffer(other, "<u4")
            own = [np.frombuffer(p, "<u4") for p in every]
            e, _, p, o, v = min((bit_errors(own[s["phase"]], other, s["offset"]), -s["votes"], s["phase"], s["offset"], s["votes"]) for s in spots)
            if e <= MOST_ERRORS:
                out.append((a, b, o, p * HOP // PHASES, v, e))
        kinds = [pa.int64()] * 5 + [pa.float64()]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "offset", "shift", "votes", "bit_error"])


def links(prints: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """Classes (d, c, id, copies) and the links of query classes, one row each: a, b (two c), offset (in hops, of a's integers
    to b's), shift (in samples, added to it), votes at that offset, and bit_error.

    prints: a table of fingerprint's output with a column id (a whole number; it need not be unique).
    """
    with scratch(prints.sparkSession) as keep:
        heard = prints.where("n_codes > 0").withColumn("d", F.sha2("codes", 256))
        # min: one recording stands for all rows of a class, whichever task is first
        own = heard.groupBy("d").agg(F.min(id).alias("id"), F.count(F.lit(1)).alias("copies"), F.first("codes").alias("codes"), F.min("phases").alias("phases"))
        classes = keep(table(own.withColumn("c", F.monotonically_increasing_id()), "audio"))
        index = table(classes.select("c", "codes").mapInArrow(_index, INDEX), "keys")
        asked = classes.where("phases is not null").select("c", "phases").mapInArrow(_asked, "a long, phase int, k long, at_a long")
        n = index.count()
        hot = [r["k"] for r in index.groupBy("k").count().where(F.col("count") > limit(n)).select("k").collect()]  # fewer than HEAVY
        if hot:
            heavy = F.col("k").isin(hot)
            index = index.withColumn("salt", F.when(heavy, F.pmod(F.xxhash64("c"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
            asked = asked.withColumn("salt", F.explode(F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        met = asked.join(index, ["k", "salt"] if hot else ["k"]).where("a <> c")
        votes = met.groupBy("a", F.col("c").alias("b"), "phase", (F.col("at_a") - F.col("at")).alias("offset")).agg(F.count(F.lit(1)).alias("votes"))
        spots = table(votes.groupBy("a", "b").agg(F.collect_list(F.struct("phase", "offset", "votes")).alias("spots")), "spots")
        both = skew_join(table(skew_join(spots, classes.select(F.col("c").alias("a"), "phases"), ["a"]), "half"), classes.select(F.col("c").alias("b"), "codes"), ["b"])
        sure = keep(table(both.select("a", "b", "phases", "codes", "spots").mapInArrow(_verified, "a long, b long, offset long, shift long, votes long, bit_error double"), "sure"))
    return classes, sure


def align(prints: DataFrame, id: str) -> DataFrame:
    """Every row of prints with class_id, and for rows with phases (the queries) n_links and the best link: match_id (the
    smallest id of its class), match_class, offset, shift, votes and bit_error."""
    classes, sure = links(prints, id)
    named = skew_join(sure, classes.select(F.col("c").alias("b"), "d", F.col("id").alias("other")), ["b"])
    one = F.struct("bit_error", F.col("d").alias("match_class"), F.col("other").alias("match_id"), "offset", "shift", "votes")
    best = named.groupBy("a").agg(F.count(F.lit(1)).alias("n_links"), F.min(one).alias("best"))
    found = classes.select("d", F.col("c").alias("a")).join(best, "a", "left").select("d", "n_links", "best.*")
    rows = prints.withColumn("d", F.when(F.col("n_codes") > 0, F.sha2("codes", 256)).otherwise("")).withColumn("q", F.col("phases").isNotNull()).drop("codes", "phases")
    silent = rows.where("d = ''").select("d").limit(1)
    out = skew_join(rows, table(found, "best"), ["d"], "left", hot=classes.where(F.col("copies") > limit(prints.count())).select("d").unionByName(silent))
    for c in ("match_id", "match_class", "offset", "shift", "votes", "bit_error"):
        out = out.withColumn(c, F.when(F.col("q"), F.col(c)))
    out = out.withColumn("n_links", F.when(F.col("q"), F.coalesce("n_links", F.lit(0).cast("long"))))
    return out.withColumn("class_id", F.when(F.col("d") != "", F.col("d"))).drop("d", "q")


def conversations(rows: DataFrame) -> DataFrame:
    """Turns of conversations as recordings: conv_id, turn, n_codes, codes_crc32, class_id; and for the queries, the turns whose
    conv_id is divisible by 50, n_links (classes that link), and of the best one match_conv_id (the smallest conv_id in it),
    match_class, offset, shift, votes, bit_error."""
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("turn"), text_bytes("text").alias("t"))
    prints = table(fingerprint(own, ["conv_id", "turn"], "t", render, F.col("conv_id") % 50 == 0), "prints")
    out = align(prints, "conv_id").withColumnRenamed("match_id", "match_conv_id")
    return out.select("conv_id", "turn", "n_codes", "codes_crc32", "class_id", "n_links", "match_conv_id", "match_class", "offset", "shift", "votes", "bit_error")
