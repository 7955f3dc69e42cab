import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cuewise.llm import dac, packing
from cuewise.llm.queries import tokenizer_path
from cuewise.llm.tokens import WordIds

CASES = [(1, None), (2, ""), (3, "Hello, world! It's 42."), (4, "naïve Straße ÉTÉ é 日本語 \U0001f600 a b"), (5, "x <|endoftext|> y<|startoftext|>z"), (6, "word " * 30_000), (7, "a" * 3000), (8, "same text"), (8, "same text"), (None, "no key"), (9, "İstanbul ǅ ΣΑΣ\x1f\x85q")]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def words():
    return WordIds(tokenizer_path(), most=50)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="aB'sétÀ0 .,!\ńİ<|>", max_size=40))
def test_word_cache_equals_the_library(whole, words, text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(words.text(text.encode()), "<u4").tolist() == whole(text)[:-1]


def test_pieces_rebuild_every_document(spark, docs_of, whole):
    size = 64
    got = packing.pack(docs_of(CASES), tokenizer_path(), size).collect()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == size or at & (at - 1) == 0 and at < size
    for k, t in CASES:
        ids = np.asarray(whole(t), "<u4")
        own = [r for r in got if r["doc_id"] == k and r["doc_tokens"] == len(ids)]
        copies = sum(c == (k, t) for c in CASES)
        assert sum(r["length"] for r in own) == copies * len(ids)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        if copies == 1:
            starts = sorted((r["start"], r["length"]) for r in own)
            assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]


def test_sum_of_squares_rule_equals_trying_every_level():
    rng = np.random.default_rng(0)
    size, levels = 40, packing.LevelArray(40)
    for n in rng.integers(1, size, 500).tolist():
        counts = levels.counts.copy()
        best = None
        for h in range(size - n + 1):
            if h and not counts[h]:
                continue
            after = counts.copy()
            after[h] -= h > 0
            after[h + n] += h + n < size
            best = min(best or (1 << 60, 0), (int((after[1:size] ** 2).sum()), -h))
        assert levels.place(n) == -best[1]


def test_codes_give_any_token():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice([0, 1, 255, 256, 49407, 65535, 65536, 2**32 - 1], n).astype(np.uint32)
        codes = dac.Codes(dac.encode(ids))
        assert len(codes) == n and codes.all().tolist() == ids.tolist()
        assert [codes[i] for i in range(0, n, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        codes[n]


def test_round_trip_in_key_order(spark, docs_of, whole, monkeypatch):
    monkeypatch.setattr(dac, "BLOCK_TOKENS", 100)
    got = dac.round_trip(docs_of(CASES), tokenizer_path()).collect()
    assert len(got) == len(CASES)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    want = sorted((str(k), len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())) for k, t in CASES for ids in [whole(t)])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([]), tokenizer_path()).count() == 0
    assert dac.round_trip(docs_of([]), tokenizer_path()).count() == 0


def test_few_windows_are_open_at_a_time():
    """Bounded windows: every id in one piece, whole windows or powers of two, and most of them closed before the end."""
    rnd = random.Random(4)
    for n, most in ((300, 16), (1500, 64), (200, 1)):
        docs = [(i, np.arange(max(1, int(rnd.lognormvariate(5.5, 1.3))), dtype="<u4").tobytes()) for i in range(n)]
        seen, late, read = {}, 0, []
        stream = packing.pack_stream((read.append(k) or (k, ids) for k, ids in docs), 2048, most)
        for window in stream:
            late += len(read) == n and window[0][0] != n - 1
            at = 0
            for key, start, ids, total, offset in window:
                assert offset == at and total == len(dict(docs)[key]) // 4
                at += len(ids) // 4
                seen.setdefault(key, {})[start] = ids
            assert at == 2048 or at & (at - 1) == 0
        assert all(b"".join(own[s] for s in sorted(own)) == dict(docs)[k] for k, own in seen.items()) and len(seen) == n
        assert late <= most + 12


def test_first_and_last_ids_by_rank(spark, docs_of):
    rows = [(i, "a few words and Straße " * i) for i in range(12)] + [(3, None)]
    got = dac.round_trip(docs_of(rows), tokenizer_path()).collect()
    assert len(got) == 13 and all(r["last_id"] == 1 for r in got)
    first = WordIds(tokenizer_path()).text(b"a few words and Stra\xc3\x9fe")
    assert all(r["first_id"] == (1 if r["n_tokens"] == 1 else int.from_bytes(first[:4], "little")) for r in got)
