"""Language ID and toxicity: held-out accuracy, and defined results of odd rows."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuewise.llm import langid, toxicity

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "123 !!"), (4, "x" * 100_000), (5, "the " * 30_000)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = toxicity.rate(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    # some documents are labelled toxic without a plain term; of those with one nearly all are found
    text = {r["doc_id"]: r["text"].lower() for r in docs.join(labels, "doc_id").collect()}
    insults = {"idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting"}
    toxic = [r for r in rows if r["toxic"] == 1 and insults & set(text[r["doc_id"]].split())]
    assert toxic and sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.02 * len(rows)


def test_no_language_is_lost_to_another(spark, docs_of):
    """A text that fills a language, and a language that comes last in the alphabet: both are learned."""
    rnd = random.Random(2)
    zz = [(1000 + i, " ".join(rnd.choice("zot zil zak zum zeb".split()) for _ in range(12)), "zz", "s") for i in range(300)]
    docs = docs_of([(i, "alpha anna abba", "aa", "s") for i in range(400)] + zz + [(5000 + i, "kilo kappa kuku", f"k{i:02d}", "s") for i in range(40)])
    model = langid.train(docs, per_language=10)
    assert {"aa", "zz"} < {x for own in model.languages.values() for x in own} and len(model.families) == 42
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.where("doc_id < 2000").select("doc_id", "text"), model).collect()}
    assert all(got[i] == "aa" for i in range(400)) and all(got[1000 + i] == "zz" for i in range(300))
    drawn = langid.draw(docs.select(F.col("text").cast("binary").alias("t"), "lang"), 10, 100).groupBy("lang").count().collect()
    n = {r["lang"]: r["count"] for r in drawn}
    assert len(n) == 42 and n["aa"] == n["k05"] == 1 and n["zz"] == 100 // 42


def plain_grams(text):
    """Shares of the hashed 1 to 4-grams of a text, one by one."""
    out = np.zeros(langid.DIMENSIONS)
    for w in text.encode().split():
        w = b"<" + langid.lowered(w) + b">"
        for n in range(1, 5):
            for i in range(len(w) - n + 1):
                h = 0
                for k in range(1, n + 1):
                    h = (h * 0x01000193) % 2**32 ^ ((w[i + k - 1] + k) % 2**32)
                out[((h * 0x9E3779B1) % 2**32 >> 20) % langid.DIMENSIONS] += 1
    return out / out.sum()


def test_prediction_equals_plain_sums():
    """Family, then votes of the pairs within it, from plain n-gram shares; ties go to the first name."""
    rnd = random.Random(3)
    words = {"de": "der die und haus schön", "nl": "het een en huis mooi", "da": "og det hus smukt er", "fr": "le la et maison très", "es": "el la y casa muy"}
    texts = [(" ".join(rnd.choices(own.split(), k=8)), lang) for lang, own in words.items() for _ in range(15)]
    model = langid.fit(np.stack([plain_grams(t) for t, _ in texts]), [lang for _, lang in texts])
    assert model.families == ["germanic", "romance"] and len(model.pairs) == 4
    for t, _ in texts[::3] + [("Haus La casa 12 !", ""), ("x" * 5000, "")]:
        m = plain_grams(t) @ model.weights + model.bias
        langs = model.languages[model.families[int(np.argmax(m[:2]))]]
        votes = {x: sum((m[2 + i] >= 0) == (x == a) for i, (a, b) in enumerate(model.pairs) if x in (a, b)) for x in langs}
        (sums,) = langid._Words(model.weights).sums([t.encode()])
        got, score = model.predict(sums)
        assert votes[got] == max(votes.values()) and 0 <= score <= 1
        assert np.allclose(sums[:-2] / sums[-2], plain_grams(t) @ model.weights, atol=1e-4)
    tie = langid.Model(["own:a", "own:b"], {"own:a": ["a"], "own:b": ["b"]}, [], np.zeros((langid.DIMENSIONS, 2), np.float32), np.zeros(2))
    assert tie.predict(np.asarray([0.0, 0.0, 5.0, 1.0]))[0] == "a"


def test_language_of_odd_rows(spark, docs_of):
    rows = ODD + [(10 + i, t, lang, "s") for i in range(12) for t, lang in (("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chien et le chat", "fr"), ("el perro y el gato", "es"), ("no label", None))]
    got = {r["doc_id"]: r for r in langid.identify(docs_of(rows)).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (1, 2, 3))
    assert got[4]["lang_pred"] != "und" and got[5]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (r["held_out"] is True) for r in got.values())
    assert {r["lang_pred"] for r in langid.identify(docs_of([(1, "a", None, None)])).collect()} == {"und"}
    assert langid.identify(docs_of([])).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs_of([(0, "abc", "xx", "s"), (2, "q", "xx", "s"), (3, "z", "xx", "s")])).collect()} == {"xx"}


def test_labels_of_the_row_are_no_input(spark, docs_of):
    rows = [(i, "the cat and the dog" if i % 2 else "le chien et le chat", "en" if i % 2 else "fr", "s") for i in range(60)]
    model = langid.train(docs_of(rows))
    one = [tuple(r) for r in langid.predict(docs_of(rows).select("doc_id", "text"), model).select("lang_pred", "score").collect()]
    other = [tuple(r) for r in langid.predict(docs_of([(k, t, "fr", "q") for k, t, *_ in rows]), model).select("lang_pred", "score").collect()]
    assert one == other


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_plain_distance():
    rnd = random.Random(6)
    word = lambda a, b: "".join(rnd.choice("abc") for _ in range(rnd.randint(a, b)))
    entries = sorted({word(3, 11) for _ in range(25)} | {word(4, 8) + "*" for _ in range(8)})
    lexicon = toxicity.Lexicon(entries)
    for _ in range(1500):
        w = word(1, 12)
        best = []
        for e in entries:
            stem = e.rstrip("*")
            if w[0] != stem[0]:
                continue
            if e.endswith("*"):
                d, most = min(plain_edits(stem, w[:k]) for k in range(len(w) + 1)), max(0, toxicity.limit(len(stem)) - 1)
            else:
                d, most = plain_edits(stem, w), toxicity.limit(len(stem))
            if d <= most:
                best.append(d)
        found = lexicon.find(w)
        assert (found and found[0]) == (min(best) if best else None), (w, found, best)


def test_misspelled_and_quoted_terms():
    hits = toxicity.Hits(toxicity.Lexicon(["idiot", "worthless"]))
    weights = np.asarray([4.0, 4.0])
    at = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES)), strict=True))
    x = toxicity.features("you are an idoit and a w0rthless idi0t".encode().split(), hits, weights)
    assert x[at["exact"]] > 0 and x[at["addressed"]] > 0 and x[at["quoted"]] == 0
    assert toxicity.features('he said "idiot" to them'.encode().split(), hits, weights)[at["quoted"]] == 1
    assert not toxicity.features("riot idle worth".encode().split(), hits, weights)[:-1].any()


def plain_features(text, entries, weights):
    """The features from all entries, word by word."""
    words = [w.decode("utf-8", "replace") for w in text.encode().split()]
    low = [w.lower() for w in words]
    bare = [w.strip(".,;:!?") for w in low]

    def hit(word):
        best = None
        for form in toxicity._LETTERS.findall(word) + (toxicity._LETTERS.findall(word.translate(toxicity._LOOKALIKES)) if toxicity._MIXED.search(word) else []):
            for place, e in enumerate(entries):
                stem = e.rstrip("*")
                if stem[0] != form[0]:
                    continue
                if e.endswith("*"):
                    d, most = min(plain_edits(stem, form[:k]) for k in range(len(form) + 1)), max(0, toxicity.limit(len(stem)) - 1)
                else:
                    d, most = plain_edits(stem, form), toxicity.limit(len(stem))
                if d <= most and (best is None or (d, place) < best):
                    best = (d, place)
        return best

    hits = {i: h for i, w in enumerate(low) if (h := hit(w))}
    x = dict.fromkeys(toxicity.FEATURES, 0.0)
    x["length"] = np.log1p(len(words)) / 10 if words else 0.0
    if hits:
        kinds = {(p, d > 0) for d, p in hits.values()}
        x["exact"], x["edited"] = (min(12.0, sum(weights[p] for p, odd in kinds if odd == k)) for k in (False, True))
        n = len(hits) / min(1.0, x["exact"] + x["edited"])
        near = lambda i: range(max(0, i - toxicity.WINDOW), min(len(words), i + toxicity.WINDOW + 1))
        x["addressed"] = sum(any(bare[j] in toxicity.SECOND for j in near(i)) for i in hits) / n
        x["clustered"] = sum(sum(j in hits for j in near(i)) > 1 for i in hits) / n
        x["quoted"] = sum(any(bare[j] in toxicity.QUOTING for j in near(i) if i - 3 <= j < i) for i in hits) / n
        x["share"] = 10 * sum(weights[p] for _, p in hits.values()) / len(words)
    return [x[f] for f in toxicity.FEATURES]


def test_features_and_score_equal_plain_ones():
    rnd = random.Random(12)
    entries, weights = ["idiot", "worthless", "scum*", "gut"], np.asarray([3.0, 2.0, 1.5, 0.5])
    hits = toxicity.Hits(toxicity.Lexicon(entries))
    model = toxicity.Model(entries, weights, np.arange(1.0, 8.0), -3.0)
    pool = "the a you idiot idoit 1diot wortless worthles scumbags scam gut gutt said word dein house, Idiot! tree".split()
    for _ in range(300):
        text = " ".join(rnd.choices(pool, k=rnd.randrange(25)))
        x = toxicity.features(text.encode().split(), hits, weights)
        assert np.allclose(x, plain_features(text, entries, weights)), text
        z = sum(a * b for a, b in zip(x, range(1, 8), strict=True)) - 3
        assert abs(model.score(x) - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-12


def test_long_words_are_met_whole():
    long = "unspeakabl" + "e" * 60
    lexicon = toxicity.Lexicon([long, "scum*"])
    assert lexicon.find(long[:-2]) == (2, 0) and lexicon.find(long[:30] + "x" + long[31:]) == (1, 0) and lexicon.find(long[:64]) is None
    assert lexicon.find("scum" + "x" * 100_000) == (0, 1) and lexicon.find(long + "z" * 100_000) is None


def test_misspelled_terms_are_met_after_training(spark, docs_of):
    """Terms are learned as they are written, and met as they are misspelled; contradicting and repeated labels are defined."""
    rnd = random.Random(5)
    plain = "the house by river stood quiet under an old tree while people walked home".split()
    text = lambda *more: " ".join(rnd.choices(plain, k=20) + [*more] + rnd.choices(plain, k=20))
    rows = [(i, text(rnd.choice(["worthless", "disgusting", "moron"])) if i % 4 == 0 else text(), "en", "s") for i in range(400)]
    rows += [(1000 + i, text(w), "en", "s") for i, w in enumerate(["wortless", "disgustng", "worthles", "worthlesss", "m0ron", "disgusting,"])]
    rows += [(2000, text("table"), "en", "s"), (2001, None, "en", "s"), (3000, text("both"), "en", "s"), (0, rows[0][1], "en", "s")]
    labels = [(i, int(i % 4 == 0)) for i in range(400)] * 2 + [(3000, 0), (3000, 1), (None, 1), (2001, None)]
    got = {r["doc_id"]: r for r in toxicity.rate(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[1000 + i]["predicted"] == 1 for i in range(6)), [(i, got[1000 + i]["score"]) for i in range(6)]
    assert got[2000]["predicted"] == got[2001]["predicted"] == got[3000]["predicted"] == 0
    held = [i for i in range(400) if got[i]["held_out"]]
    assert held and all(got[i]["predicted"] == int(i % 4 == 0) for i in held)


def test_entries_are_more_than_chance():
    """Words of toxic texts at the base rate, or in too few texts, are not chosen; all that are sure are."""
    counts = [("sure", 60, 0), ("rare", 3, 0), ("base", 30, 270), ("four", 4, 0), ("sure*", 60, 2)] + [(f"w{i}", 60, 1) for i in range(5000)]
    chosen = [e for e, _ in toxicity.choose(counts, 300, 2700)]
    assert "sure" in chosen and len(chosen) == 5001 and not {"rare", "base", "four"} & set(chosen)


def test_toxicity_of_odd_rows(spark, docs_of):
    rows = ODD + [(10 + i, f"quiet words here {i} " + ("you idiot" if i % 2 else "and there")) for i in range(80)]
    labels = spark.createDataFrame([(10 + i, i % 2) for i in range(80)] + [(1, 0), (2, None)], "doc_id long, toxic int").withColumn("quality", F.lit(1))
    got = {r["doc_id"]: r for r in toxicity.rate(docs_of(rows), labels).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(got[10 + i]["predicted"] == i % 2 for i in range(80)) and not any(got[k]["predicted"] for k in range(1, 6))
    assert {r["score"] for r in toxicity.rate(docs_of(rows), labels.limit(0)).collect()} == {0.0}
    assert toxicity.rate(docs_of([]), labels).count() == 0
