import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuewise.llm import common, neardup


def brute(rows, threshold=0.85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = []
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((k, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = {k: k for k, _ in sets if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return sorted((str(k), len(s), str(None if k is None else root(k)), k is None or root(k) == k) for k, s in sets)


def check(spark, docs_of, rows):
    got = neardup.find(docs_of(rows), 0.85).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == brute(rows)


def text(rnd, n):
    return [f"w{rnd.randrange(500)}" for _ in range(n)]


def varied(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return words


def test_equals_brute_force(spark, docs_of):
    rnd = random.Random(4)
    rows, k = [(1, None), (2, ""), (3, "A b"), (4, "a B"), (5, "one two three four"), (6, " \n"), (None, "a b"), (7, "Über über x y z"), (8, "über über x y z")], 100
    for n in (8, 20, 60, 150, 400):
        base = text(rnd, n)
        for edits in (0, 0, 0, 1, 1, 2, 3, n // 40, n // 30, n // 20):
            rows.append((k, " ".join(varied(rnd, base, edits))))
            k += 7
    for _ in range(40):  # a passage that many share
        rows.append((k, " ".join(text(rnd, 30)) + " common passage of many words that repeats across documents " * 2))
        k += 1
    rnd.shuffle(rows)
    check(spark, docs_of, rows)


def test_a_large_group_at_the_threshold(spark, docs_of, monkeypatch):
    """Near copies of which each is similar enough to some others only: no link may be lost, nor made."""
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 16_000)
    rnd = random.Random(9)
    base = text(rnd, 150)
    check(spark, docs_of, [(i, " ".join(varied(rnd, base, 2 + i % 3))) for i in range(260)] + [(1000 + i, " ".join(base)) for i in range(100)])


@pytest.mark.parametrize("rows", [[], [(5, "x")], [(5, "x y"), (5, "x y"), (5, "z")]])
def test_small_tables_and_repeated_rows(spark, docs_of, rows):
    check(spark, docs_of, rows)


def test_estimate_follows_the_sets():
    rng = np.random.default_rng(2)
    for n in (300, 3000, 30000):
        for share in (0.5, 0.85):
            both = rng.integers(0, 2**64, int(n * share), dtype=np.uint64)
            own = [np.unique(np.concatenate([both, rng.integers(0, 2**64, (n - len(both)) // 2, dtype=np.uint64)])) for _ in range(2)]
            j = len(both) / (len(both) + 2 * ((n - len(both)) // 2))
            got = neardup.estimate(neardup.registers(own[0]), neardup.registers(own[1]), len(own[0]), len(own[1]))
            assert abs(got - j) < 0.14


def test_unrelated_sets_meet_as_seldom_as_foretold():
    rng = np.random.default_rng(3)
    hits = trials = 0
    for _ in range(40):
        a, b = (neardup.registers(np.unique(rng.integers(0, 2**64, 4096, dtype=np.uint64))) for _ in range(2))
        hits, trials = hits + int((a == b).sum()), trials + 256
    assert hits / trials < 6 * neardup._chance(24, 24) + 0.001


def test_components_of_a_long_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    got = {r["id"]: r["comp"] for r in neardup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 100: 100, 101: 100}
    assert neardup.components(edges.limit(0)).count() == 0


def test_overlaps_equal_plain_intersections(monkeypatch):
    monkeypatch.setattr(neardup, "CELLS", 3000)
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 900, rng.integers(1, 400)).astype(np.uint64)) for _ in range(14)]
    got = neardup._overlaps(sets[:6], sets[6:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[6:]] for a in sets[:6]]).all()
    assert neardup._overlaps([np.asarray([1], np.uint64)], [np.asarray([2], np.uint64)]).tolist() == [[0]]


def test_heavy_groups_and_very_long_texts(spark, docs_of, monkeypatch):
    """Every heavy key is dealt apart: exact copies, a band and a hub that hold a third of the rows; texts of 20,000 words."""
    from cuewise.llm import common

    monkeypatch.setattr(common, "HEAVY", 20)
    monkeypatch.setattr(common, "MANY", 10)
    rnd = random.Random(13)
    base, long = text(rnd, 120), [f"l{rnd.randrange(5000)}" for _ in range(20_000)]
    rows = [(i, " ".join(varied(rnd, base, rnd.choice((0, 1, 1, 2, 3))))) for i in range(120)] + [(1000 + i, " ".join(base)) for i in range(100)]
    rows += [(2000 + i, " ".join(varied(rnd, long, 300 * i))) for i in range(4)] + [(3000 + i, "") for i in range(60)] + [(4000 + i, " ".join(text(rnd, 40))) for i in range(30)]
    check(spark, docs_of, rows)


def test_batches_of_tables_are_small(spark):
    """Wide rows go to Python a few megabytes at a time when a table is written, and the session's own sizes stay; no row is lost."""
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "bytes"])

    before = {k: spark.conf.get(k, None) for k in common.ARROW}
    for wide, most in ((9_000, 5_000_000), (10, 100_000)):
        df = spark.range(0, 3_500, 1, 1).select(F.repeat(F.lit("x"), wide).cast("binary").alias("b"))
        got = common.table(df.mapInArrow(sizes, "n long, bytes long"), "sizes").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max("bytes").alias("bytes")).first()
        assert got["n"] == 3_500 and got["most"] <= 1_000 and got["bytes"] <= most
    assert before == {k: spark.conf.get(k, None) for k in common.ARROW}
