import random

import duckdb

from cuewise.llm import rules

CASES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "a b c a b c"),
    (5, "x " * 60),
    (6, "line\nline\n \n\nother\nline"),
    (7, "#*$ é€ <b> " * 20),
    (8, "日本 語 x " * 30),
    (9, " ".join(f"w{i}" for i in range(3000)) + " w0 w1 w2"),
    (9, "a b c d"),
    (9, "a b c d"),
    (None, "one two"),
    (10, "aa bb cc aa bb cc dd " * 500),
]


def brute(text):
    t = text or ""
    w = t.encode().split()
    w = [x.decode() for x in w]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    hit = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(3)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in t), len(lines) - len(set(lines)), len(hit)


def test_measures_equal_brute_force(spark, docs_of):
    rnd = random.Random(1)
    rows = CASES + [(100 + i, " ".join(rnd.choice("ab c\nd\r#".split(" ")) for _ in range(rnd.randrange(40)))) for i in range(60)]
    got = rules.judge(docs_of(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), *brute(t)) for k, t in rows)
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_sql_gives_the_same(spark, docs_of, tmp_path):
    df = docs_of([c for c in CASES if c[0] not in (9, None)])
    got = rules.judge(df)
    c = duckdb.connect()
    c.register("documents", df.toPandas())
    want = c.sql(rules.ORACLE)
    order = sorted(want.columns)
    assert sorted(tuple(r[k] for k in order) for r in got.collect()) == sorted(tuple(dict(zip(want.columns, r, strict=True))[k] for k in order) for r in want.fetchall())
    want = c.sql(rules.ABLATIONS_ORACLE)
    assert sorted(tuple(r[k] for k in want.columns) for r in rules.all_ablations(df).collect()) == sorted(want.fetchall())


def test_no_python_in_the_plan(spark, docs_of):
    for df in (rules.ledger(docs_of(CASES)), rules.judge(docs_of(CASES))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan.split("Physical Plan")[1]


def test_versions_of_a_policy(spark, docs_of):
    """One stored ledger, two versions: repeated lines fail a text at more than 30 % of them, or only if they are most."""
    line = lambda i: f"line {i} of words that differ in every text and are many enough"
    rows = [(n, "\n".join([line(i) for i in range(10 - n)] + ["same words in this line of the text here"] * n)) for n in (1, 3, 4, 5, 6, 7)]
    got = {r["doc_id"]: (r["n_dup_lines"], r["kept"], r["kept_by_version_1"]) for r in rules.judge(docs_of(rows)).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 0, 3: 2, 4: 3, 5: 4, 6: 5, 7: 6}
    assert {k for k, v in got.items() if v[2]} <= {1, 3, 4} and all(v[1] or not v[2] for v in got.values())
    both = rules.all_ablations(docs_of(rows)).collect()
    assert len(both) == 14 and {r["version"] for r in both} == {"production-1", "production-2"}
    assert rules.all_ablations(docs_of([])).count() == 0


def test_ablations_are_what_the_masks_say(spark, docs_of):
    ledger = rules.ledger(docs_of(CASES))
    masks = [r["failed"] & rules.mask(rules.BASE) for r in ledger.collect()]
    got = {r["rule"]: (r["n_failed"], r["n_failed_alone"], r["n_kept_without"]) for r in rules.ablations(ledger, rules.BASE).collect()}
    for name, bit in (("too_few_words", 1), ("repeated_words", 2)):
        assert got[name] == (sum(bool(m & bit) for m in masks), masks.count(bit), sum(m & ~bit == 0 for m in masks))
    assert rules.mask(rules.Policy("x", ("symbols", "symbols"))) == 4


def test_empty_table(spark, docs_of):
    assert rules.judge(docs_of([])).count() == 0
