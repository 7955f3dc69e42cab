"""The pipeline against its stages taken one by one, and the queries' registration."""

import random

import corpus_pipeline
import pytest
from cuewise.llm import mixing, neardup, queries, secrets
from pyspark.sql import functions as F


def rows():
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("the cat and dog house tree river stone cloud window".split()) + str(rnd.randrange(90)) for _ in range(n))
    out = [(i, text(30 + i), "en", f"s{i % 4}") for i in range(40)]
    out += [(100 + i, out[i][1], "en", "hot") for i in range(10)]  # copies
    out += [(200, None, "en", "x"), (201, "123 456", "en", "x"), (202, text(40) + " token=abcdef123456", "en", None), (203, "", "en", "x")]
    return out


def test_stages_take_effect(spark, docs_of):
    docs = docs_of(rows(), extra=False)
    columns = docs.columns
    state, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, "")
        seen[name] = state.collect()
        assert name == "packing" or state.columns == columns
    ids = lambda name: sorted(r["doc_id"] for r in seen[name])
    letters = sorted(k for k, t, *_ in rows() if t and any(map(str.isalpha, t)))
    assert ids("language_id") == letters
    assert ids("near_dedup") == [k for k in letters if not 100 <= k < 110]
    assert ids("secret_scans") == ids("near_dedup")
    clean = {r["doc_id"]: r["text"] for r in seen["secret_scans"]}
    assert clean[202].endswith(" [REDACTED]") and all(clean[k] == t for k, t, *_ in rows() if k in clean and k != 202)
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secret_scans"])
    assert not any(secrets.Scanner().spans(t) for t in clean.values())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(seen["secret_scans"], docs.schema)).collect()}
    assert ids("mixing") == sorted(k for k, n in copies.items() for _ in range(n))
    tokens = {}
    for r in seen["packing"]:
        tokens.setdefault(r["doc_id"], []).append((r["length"], r["doc_tokens"]))
    assert all(sum(n for n, _ in own) == copies[k] * own[0][1] for k, own in tokens.items()) and set(tokens) == {k for k, n in copies.items() if n}


def test_clashing_columns_and_repeated_rows(spark, docs_of):
    docs = docs_of(rows()[:5] * 2 + [(None, "a b c d", "en", "s")] * 2)
    kept = [r["doc_id"] for r in corpus_pipeline.dedup_stage(spark, docs, "").collect()]
    assert sorted(k for k in kept if k is not None) == [0, 1, 2, 3, 4]
    assert corpus_pipeline.language_stage(spark, docs, "").columns == docs.columns
    assert neardup.find(docs).count() == docs.count()


def test_empty_table(spark, docs_of):
    state = docs_of([], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, "")
    assert state.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(q.startswith(n) for q in queries.QUERIES) == 1 for n in names)
    assert "pipeline" in entry.queries() and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_near_copies_from_a_similarity_of_0_8(spark, docs_of):
    """Two changed words of a hundred: 86 of 106 shingles are shared, 0.81; three: 81 of 111, 0.73."""
    out = []
    for i in range(12):
        base = [f"w{i}x{j}" for j in range(100)]
        two, three = list(base), list(base)
        two[20] = two[60] = three[10] = three[40] = three[80] = "other"
        out += [(k * 100 + i, " ".join(w)) for k, w in enumerate((base, two, three))]
    kept = sorted(r["doc_id"] for r in corpus_pipeline.dedup_stage(spark, docs_of(out), "").collect())
    assert kept == [*range(12), *range(200, 212)]


def test_bands_follow_the_threshold():
    assert neardup.shape(0.85) == (36, 7)
    for t in (0.5, 0.7, 0.8, 0.9, 0.95):
        bands, rows = neardup.shape(t)
        assert bands * rows <= neardup.BUCKETS and (1 - t**rows) ** bands <= 1e-6


def test_documents_stay_where_no_language_is_known(spark, docs_of):
    texts = ["the cat and the dog", "日本語", "123 456 !!", "", None, "12é"]
    docs = docs_of([(i, t, None, "s") for i, t in enumerate(texts)])
    got = corpus_pipeline.language_stage(spark, docs, "")
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [0, 1, 5]


CLASHES = ("row", "id", "d", "h", "n", "t", "words", "lang_pred", "score", "_source", "_last", "_gone", "_h", "_n", "_copy", "_row", "_whole", "k1", "component_id", "kept", "count")


def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns of the stages' own names."""
    rows = [(1, "the cat sat on the mat today", "en", "a", 28), (1, "the cat sat on the mat today", "en", "a", 28), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "123", None, "b", 3),
            (5, "word " * 40_000, None, "b", None), (6, "une autre phrase token=abcdef123456", None, None, 35), (None, "sans nom ici", "fr", "b", 12)]
    rows += [(10 + i, f"the dog number {i} ran over hill {i * 7} and far away", "en", "a", 1) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHES})


def extras(r):
    return tuple(r[c] for c in CLASHES)


def test_every_stage_with_odd_rows(spark):
    docs = odd(spark)
    want = [r.asDict() for r in docs.collect()]
    own = {r["doc_id"]: extras(r) for r in want}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        got = out.collect()
        assert out.columns == docs.columns and all(extras(r) == own[r["doc_id"]] for r in got), name
        ids = sorted((r["doc_id"] for r in got), key=str)
        if name == "language_id":
            assert ids == sorted((r["doc_id"] for r in want if r["text"] and any(map(str.isalpha, r["text"]))), key=str)
            assert all(r["lang"] is not None for r in got) and {r["lang"] for r in got if r["doc_id"] in (1, None)} == {"en", "fr"}
        elif name == "near_dedup":
            assert ids == sorted({str(r["doc_id"]): r["doc_id"] for r in want}.values(), key=str)
        elif name == "secret_scans":
            assert len(got) == len(want)
            for r in got:
                before = next(w for w in want if w["doc_id"] == r["doc_id"])
                assert r["text"] == (before["text"] and before["text"].replace("token=abcdef123456", "[REDACTED]"))
                assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else before["n_chars"])
        else:
            n = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.mix(docs).collect()}
            assert ids == sorted((w["doc_id"] for w in want if w["text"] and w["text"].split() for _ in range(n[w["doc_id"], len(w["text"].split())])), key=str)
    pieces = corpus_pipeline.packing_stage(spark, docs, "").collect()
    whole = {}
    for r in pieces:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole[2] == whole[3] == 1 and whole[5] > 2048 and whole[1] == 2 * next(r["doc_tokens"] for r in pieces if r["doc_id"] == 1)


def test_texts_under_one_id_are_told_apart(spark, docs_of):
    """A text goes only if its own group has another member that stays."""
    a, b, c = (f"{x} one two three four five six seven eight nine ten" for x in "abc")
    rows = [(7, a), (7, b), (5, a), (9, b), (11, c), (11, c), (12, None), (12, ""), (None, c)]
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, docs_of(rows), "").collect()), key=str)
    assert got == sorted([(5, a), (7, b), (11, c), (12, None), (12, ""), (None, c)], key=str)


def test_a_missing_language_is_filled_in(spark, docs_of):
    rows = [(i, t, lang, "s") for i in range(30) for t, lang in (("the cat and the dog", "en"), ("le chien et le chat noir", "fr"))]
    got = corpus_pipeline.language_stage(spark, docs_of(rows + [(100, "the dog and cat", None, "s"), (101, "le chat et chien", None, "s"), (102, "le chat", "en", "s")]), "").collect()
    assert {r["doc_id"]: r["lang"] for r in got if r["doc_id"] >= 100} == {100: "en", 101: "fr", 102: "en"}


def test_tables_of_a_stage_go(spark, docs_of):
    from cuewise.llm import common

    with common.scratch(spark) as keep:
        one, two = common.table(docs_of([(1, "a")]), "one"), keep(common.table(docs_of([(2, "b")]), "two"))
    assert two.count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(one.scratch).count()


def test_a_cluster_without_a_shared_folder_is_refused():
    from cuewise.llm import common

    class Conf:
        get = staticmethod(lambda name, default: default)

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"applicationId": "app-none", "master": "spark://far:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())


def test_heavy_keys_join_like_others(spark, monkeypatch):
    from cuewise.llm import common

    monkeypatch.setattr(common, "MANY", 5)
    left = spark.range(300).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN 8 ELSE id END AS k")
    right = spark.createDataFrame([(7, "seven"), (2, "two"), (5, None)], "k long, name string")
    for how in ("inner", "left"):
        got = common.skew_join(common.table(left, "left"), common.table(right, "right"), ["k"], how)
        want = left.join(right, ["k"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
