import hashlib

import pytest

from cuewise.llm import mixing


def brute(rows, most=3):
    """Targets by water-filling one source at a time; thresholds by sorting."""
    size = lambda t: len((t or "").encode().split())
    h = lambda k: int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16)
    own = {}
    for k, t, _, s in rows:
        own.setdefault(s, []).append((h(k), size(t)))
    order = sorted((s for s in own if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in own)
    total = {s: sum(n for _, n in own[s]) for s in order}
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = (sum(total.values()) - sum(most * total[s] for s in capped)) / sum(weight[s] for s in free)
        new = {s for s in free if level * weight[s] > most * total[s]}
        if not new:
            break
        capped |= new
    target = {s: float(most * total[s]) if s in capped else level * weight[s] for s in order}
    taken = {}
    for s in order:
        whole = min(most, int(target[s] // total[s])) if total[s] else 0
        budget, run, groups = target[s] - whole * total[s], 0, {}
        for k, n in own[s]:
            groups[k] = groups.get(k, 0) + n
        last = -1
        for k in sorted(x for x in groups if groups[x]):
            if run + groups[k] <= budget or run <= budget and run + groups[k] - budget < budget - run:
                last = k
            run += groups[k]
        for k, _ in own[s]:
            taken[s, k] = min(most, whole + (k <= last))
    return sorted((str(k), size(t), total[s], round(target[s], 6), size(t) * taken[s, h(k)]) for k, t, _, s in rows)


def check(spark, docs_of, rows):
    got = mixing.mix(docs_of(rows)).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got) == brute(rows)
    return got


def test_equals_brute_force_with_a_hot_source(spark, docs_of):
    rows = [(i, "w " * (i * 7 % 23), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(400)] + [(1000, None, "en", None), (1001, "a b", "en", None), (1002, "", "en", "empty")]
    got = check(spark, docs_of, rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    largest = max(r["size"] for r in got)
    sources = {s for *_, s in rows}
    assert abs(sum(r["taken"] for r in got) - sum(r["size"] for r in got)) <= largest * len(sources)


def test_reruns_agree_and_repeated_rows_go_together(spark, docs_of):
    rows = [(7, "a b c", "en", "x")] * 30 + [(i, "q " * 5, "en", "y") for i in range(100, 160)]
    assert check(spark, docs_of, rows) == check(spark, docs_of, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", None)], [(1, "a", "en", "s")]])
def test_small_tables(spark, docs_of, rows):
    check(spark, docs_of, rows)


def test_long_text(spark, docs_of):
    check(spark, docs_of, [(1, "word " * 200_000, "en", "a"), (2, "x", "en", "b"), (3, "y z", "en", "c")])
