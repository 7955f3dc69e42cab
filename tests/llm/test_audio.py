import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from cuewise.llm import audio


def text(rnd, n):
    return " ".join(f"w{rnd.randrange(400)}" for _ in range(n))


def test_integral_image_equals_plain_sums():
    rng = np.random.default_rng(0)
    frames = rng.random((30, 12))
    got = audio.codes(frames)
    assert len(got) == 30 - audio.WIDEST + 1
    for x in (0, 7, 14):
        code = 0
        for kind, y, h, w in audio.FILTERS:
            f = frames[x : x + w, y : y + h]
            half, low, q = w // 2, h // 2, w // 4
            if kind == 0:
                a, b = f[:half].sum(), f[half:].sum()
            elif kind == 1:
                a, b = f[:, :low].sum(), f[:, low:].sum()
            elif kind == 2:
                a, b = f[:half, :low].sum() + f[half:, low:].sum(), f[half:, :low].sum() + f[:half, low:].sum()
            else:
                b = f[q : w - q].sum()
                a = f.sum() - b
            grade = sum(np.log((1 + a) / (1 + b)) > c for c in audio.CUTS)
            code = code << 2 | [0, 1, 3, 2][grade]
        assert code == got[x]


def test_pitch_classes_are_heard():
    words = [w for w in (f"w{i}" for i in range(40))]
    frames = audio.chroma(audio.render(" ".join(w for w in words for _ in range(2)).encode()))
    for i, w in enumerate(words):
        assert frames[2 * i].argmax() == zlib.crc32(w.encode()) % 12


def test_shifted_and_edited_copies_are_aligned(spark):
    rnd = random.Random(1)
    base = text(rnd, 120)
    words = base.split()
    edited = " ".join("other" if i % 24 == 23 else w for i, w in enumerate(words))
    rows = [(50, 0, base), (51, 0, text(rnd, 30) + " " + base), (52, 0, edited), (53, 1, text(rnd, 70) + " " + " ".join(words[40:90]) + " " + text(rnd, 70)), (100, 0, "short one"), (101, 0, "short one"), (150, 0, text(rnd, 80)),
            (200, 0, None), (250, 0, ""), (7, 1, base), (None, 3, "x y"), (300, 0, "la " * 20_000), (350, 0, "la lo " * 10_000), (351, 0, "lo la " * 9_000)]
    rows += [(1000 + i, 0, text(rnd, 60)) for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, text string").withColumns({c: F.lit("clash") for c in ("codes", "rec", "t", "d", "offset", "phases", "id", "c")})
    got = {(r["conv_id"], r["turn"]): r for r in audio.conversations(df).collect()}
    assert len(got) == len(rows)
    r = got[50, 0]
    assert (r["n_links"], r["shift"]) == (3, 0) and r["bit_error"] < 0.05 and (r["match_conv_id"], r["offset"]) in ((51, -30), (52, 0), (53, -30))
    assert got[7, 1]["class_id"] == r["class_id"] and got[7, 1]["match_conv_id"] is None and got[7, 1]["n_links"] is None
    assert got[100, 0]["class_id"] == got[101, 0]["class_id"] and got[100, 0]["n_links"] == 0
    assert got[200, 0]["n_codes"] == got[250, 0]["n_codes"] == 0 and got[200, 0]["class_id"] is None and got[200, 0]["n_links"] is None
    assert got[350, 0]["match_conv_id"] == 351 and got[300, 0]["n_links"] == 0 == got[150, 0]["n_links"]


def test_null_turns_and_repeated_ids_are_told_apart(spark):
    rnd = random.Random(4)
    one, two, three = (text(rnd, 60) for _ in range(3))
    rows = [(50, 0, one), (50, 0, two), (50, None, three), (50, 70_000, one), (52, 0, text(rnd, 20) + " " + two), (52, None, one), (None, None, three)]
    got = audio.conversations(spark.createDataFrame(rows, "conv_id long, turn int, text string")).collect()
    assert len(got) == len(rows) and len({r["class_id"] for r in got}) == 4
    queries = [r for r in got if r["n_links"] is not None]
    assert len(queries) == 4 and sorted(r["n_links"] for r in queries) == [0, 0, 0, 1]
    assert [r["match_conv_id"] for r in queries if r["n_links"]] == [52]


def brute(prints, phases):
    """Pairs of different recordings with a stretch that agrees, over all offsets and phases."""
    out = set()
    for a, every in phases.items():
        for b, other in prints.items():
            if a != b and any(audio.bit_errors(own, other, o) <= audio.MOST_ERRORS for own in every for o in range(-len(other), len(own))):
                out.add((a, b))
    return out


def test_links_against_all_offsets(spark):
    """Passages that recordings share, cut at any sample, with noise of 20 dB: nearly all links are found, and no other."""
    rnd, rng = random.Random(2), np.random.default_rng(5)
    parts = [text(rnd, 60) for _ in range(8)]
    rows = []
    for i in range(48):
        x = audio.render((" ".join(rnd.sample(parts, 1)) + " " + text(rnd, 30)).encode())[rng.integers(0, 128) :]
        x = x + rng.normal(0, np.sqrt((x**2).mean() / 100), len(x))
        rows.append((i, x.astype("<f4").tobytes()))
    df = spark.createDataFrame(rows, "id long, samples binary")
    prints = audio.table(audio.fingerprint(df, ["id"], "samples", None, F.col("id") % 6 == 0), "prints")
    classes, sure = audio.links(prints, "id")
    of = {r["c"]: r["id"] for r in classes.collect()}
    got = {(of[r["a"]], of[r["b"]]) for r in sure.collect()}
    heard = {k: np.frombuffer(x, "<f4") for k, x in rows}
    want = brute({k: audio.codes(audio.chroma(x)) for k, x in heard.items()}, {k: audio.phases(x) for k, x in heard.items() if k % 6 == 0})
    assert len(want) > 20 and got <= want and len(got) >= 0.9 * len(want)


def test_recall_for_every_cut():
    """Shifts of 0 to 127 samples with noise of 20 dB: a key agrees at the right offset, and the stretch passes."""
    rnd, rng = random.Random(7), np.random.default_rng(1)
    noisy = lambda x: x + rng.normal(0, np.sqrt((x**2).mean() / 100), len(x)).astype(np.float32)
    hit = 0
    for shift in range(128):
        x = audio.render(text(rnd, 120).encode())
        b = audio.codes(audio.chroma(noisy(x[shift:])))
        kb, pb = audio.keys(b)
        at = dict(zip(kb.tolist(), pb.tolist(), strict=True))
        found = False
        for own in audio.phases(noisy(x)):
            ka, pa = audio.keys(own)
            found |= any(k in at and audio.bit_errors(own, b, p - at[k]) <= audio.MOST_ERRORS for k, p in zip(ka.tolist(), pa.tolist(), strict=True))
        hit += found
    assert hit >= 0.9 * 128


def test_wav_files(tmp_path):
    import io
    import wave

    def tones(rate):
        t = np.arange(rate // 4) / rate
        return np.concatenate([np.sin(2 * np.pi * 880 * 2 ** (k / 12) * t) for k in (0, 4, 7, 9, 2)])

    x = tones(audio.RATE)
    for rate, width, channels in ((4096, 2, 1), (8192, 2, 2), (16384, 4, 1), (4096, 1, 1), (44100, 2, 2)):
        y = tones(rate)
        data = {1: np.clip(y * 127 + 128, 0, 255).astype("u1"), 2: (y * 32000).astype("<i2"), 4: (y * 2e9).astype("<i4")}[width]
        out = io.BytesIO()
        with wave.open(out, "wb") as f:
            f.setnchannels(channels), f.setsampwidth(width), f.setframerate(rate)
            f.writeframes(np.repeat(data, channels).tobytes())
        got = audio.wav(out.getvalue())
        assert abs(len(got) - len(x)) < 10 and (rate > 4096 or np.abs(got - x).max() < 0.03)
        a, b = audio.chroma(got).argmax(1), audio.chroma(x).argmax(1)
        assert (a[: len(b) - 1] == b[: len(a)][: len(b) - 1]).mean() > 0.9
    empty = io.BytesIO()
    with wave.open(empty, "wb") as f:
        f.setnchannels(1), f.setsampwidth(2), f.setframerate(8000)
    assert len(audio.wav(empty.getvalue())) == 0


def test_heavy_keys_are_dealt(spark, monkeypatch):
    """A passage that all recordings begin with: its keys are dealt over many tasks, and no link is lost."""
    from cuewise.llm import common

    monkeypatch.setattr(common, "MANY", 10)
    rnd = random.Random(3)
    same = text(rnd, 50)
    rows = [(i, 0, same + " " + text(rnd, 30)) for i in range(45, 105)]
    got = {r["conv_id"]: r for r in audio.conversations(spark.createDataFrame(rows, "conv_id long, turn int, text string")).collect()}
    assert got[50]["n_links"] == got[100]["n_links"] == 59 and got[51]["n_links"] is None


def test_empty_table(spark):
    assert audio.conversations(spark.createDataFrame([], "conv_id long, turn int, text string")).count() == 0
