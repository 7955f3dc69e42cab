"""Toxicity: a learned lexicon, met with Levenshtein automata, and scores of the words around each hit.

The lexicon holds words and, beside their common forms, stems (heads of 4 to 10 letters) that labelled toxic texts hold and others
do not, by the lower end of Wilson's interval and beyond what chance gives among so many words; as many as pass that test.
It is kept as a trie. A word is looked up by walking the trie and the word's Levenshtein automaton together: a state
is the row of edit distances so far, branches whose least distance is above the limit are cut, and a stem may end anywhere
in the word. The limit is 0 edits for words under 5 letters, 1 up to 8, and 2 beyond, and for stems one less; the
first letter is never edited. Hits with edits are a feature of their own, whose weight is learned: it starts from that of
exact hits and leaves it as far as the labelled texts say.

Around each hit, `window` words to either side say whether it is quoted or spoken about (quotation marks, words like
"said" or "word") or part of abuse (other hits, a second person). Those shares, the sums of the
weights of the entries hit, and their density are the features of a logistic regression.

Labels are read from at most `per_label` documents of each label (those with the smallest hashes of their ids) among the
rows that the caller has cut off from held-out ones; scoring reads whole texts and nothing else.

Defined results: null and empty texts have no hits and get the score of such texts; rows without a label are scored
like others; without any label 1 every score is 0; a label row that is repeated counts once; an id, or a text, that has
both labels is not learned from; copies of a text count once, and near copies that share their smallest shingle hash too; words and texts of any length are met whole; of entries
with equally few edits the first of the lexicon wins; equal rows get equal scores; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_LABEL = 3000
WINDOW = 6
HEADS = range(4, 11)
#: An entry is tested if so many toxic texts hold it.
LEAST_TEXTS = 4
#: A word stays beside its stem if it is in this share of the toxic texts that hold the stem.
FORM_SHARE = 0.25

# Marks and words that quote, and words that address someone, in the languages at hand.
QUOTES = "\"'“”„«»‘’‹›"
QUOTING = "said says say quote quoted called term word dit mot terme sagte wort begriff dijo palabra término".split()
SECOND = "you your you're tu te toi ton du dich dein vous usted ustedes".split()

_LETTERS = re.compile(r"[^\W\d_]+")


def limit(length: int) -> int:
    return 0 if length < 5 else 1 if length <= 8 else 2


class Lexicon:
    """A trie of words and of stems (entries that end in *)."""

    def __init__(self, entries: list[str]):
        self.entries = list(entries)
        #: No entry meets more letters than this, so a longer word gives the same answer as its head.
        self.reach = max(map(len, self.entries), default=0) + 3
        self.root: dict = {}
        for at, e in enumerate(self.entries):
            node = self.root
            for c in e.rstrip("*"):
                node = node.setdefault(c, {})
            if e.endswith("*"):
                node["*"] = (max(0, limit(len(e) - 1) - 1), at)
            else:
                node["$"] = (limit(len(e)), at)
        for node in self.root.values():
            self._bound(node, 1)

    def _bound(self, node: dict, depth: int) -> tuple[int, int]:
        """Keeps in every node, under "", the most edits that any entry below it allows, and under "#" the lengths of words
        that some entry below it can meet, as bits."""
        most = lengths = 0
        if "$" in node:
            k = most = node["$"][0]
            lengths = ((1 << (2 * k + 1)) - 1) << (depth - k)
        if "*" in node:
            k = node["*"][0]
            most, lengths = max(most, k), lengths | (-1 << max(0, depth - k))
        for c, child in node.items():
            if c not in "$*":
                a, b = self._bound(child, depth + 1)
                most, lengths = max(most, a), lengths | b
        node[""], node["#"] = most, lengths
        return most, lengths

    def _exact(self, node: dict, word: str, at: int = 1) -> tuple[int, int] | None:
        """The entry in this branch that word, from its letter `at` on, holds without edits."""
        while True:
            if "*" in node:
                return 0, node["*"][1]
            if at == len(word):
                return (0, node["$"][1]) if "$" in node else None
            if word[at] not in node:
                return None
            node, at = node[word[at]], at + 1

    @staticmethod
    def _depth(row: list[int]) -> int:
        """How much of the word the branch has taken without edits, or -1."""
        return row.index(0) if 0 in row else -1

    def find(self, word: str) -> tuple[int, int] | None:
        """Edits to the nearest entry within its limit, and its place; the first letter must be the entry's own."""
        word = word[: self.reach]
        if not word or (node := self.root.get(word[0])) is None:
            return None
        n = len(word)
        if not node["#"] >> n & 1:
            return None
        if not node[""]:
            return self._exact(node, word)
        best = (3, -1)
        todo = [(node, list(range(1, -1, -1)) + list(range(1, n)))]
        while todo:
            node, row = todo.pop()
            if "$" in node and row[-1] <= node["$"][0]:
                best = min(best, (row[-1], node["$"][1]))
            if "*" in node and (least := min(row)) <= node["*"][0]:
                best = min(best, (least, node["*"][1]))
            if best[0] == 0:
                return best
            for c, child in node.items():
                if c in "$*#" or not child["#"] >> n & 1:  # and ""
                    continue
                if not child[""]:
                    depth = self._depth(row)
                    if depth >= 0 and word[depth : depth + 1] == c and (found := self._exact(child, word, depth + 1)):
                        best = min(best, found)
                    continue
                most = min(child[""], best[0] - 1)
                left = row[0] + 1
                new, least = [left], left
                for j in range(n):
                    left = left + 1
                    if row[j + 1] < left - 1:
                        left = row[j + 1] + 1
                    if (x := row[j] + (word[j] != c)) < left:
                        left = x
                    new.append(left)
                    if left < least:
                        least = left
                if least <= most:
                    todo.append((child, new))
        return best if best[0] < 3 else None


class Hits(dict):
    """word (UTF-8 bytes) -> 0 for none, else twice the place of the entry plus 2, and 1 more if with edits; starts anew when `most` words are held."""

    def __init__(self, lexicon: Lexicon, most: int = 300_000):
        self.lexicon, self.most = lexicon, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        text = word.decode("utf-8", "replace").lower()
        found = [self.lexicon.find(w) for w in _LETTERS.findall(text)]
        if _MIXED.search(text):
            found += [self.lexicon.find(w) for w in _LETTERS.findall(text.translate(_LOOKALIKES))]
        near = [f for f in found if f]
        out = 2 * min(near)[1] + 2 + (min(near)[0] > 0) if near else 0
        self[word] = out
        return out


_MIXED = re.compile(r"[0-9@$][^\W\d_]|[^\W\d_][0-9@$]")
_LOOKALIKES = str.maketrans("013457@$", "oieastas")
FEATURES = ("exact", "edited", "quoted", "addressed", "clustered", "share", "length")


def features(words: list[bytes], hits: Hits, weights: np.ndarray) -> np.ndarray:
    """exact and edited: the sums of the weights of the distinct entries hit, up to 12."""
    out = np.zeros(len(FEATURES))
    if not words:
        return out
    out[-1] = math.log1p(len(words)) / 10
    found = np.fromiter(map(hits.__getitem__, words), np.int32, len(words))
    places = np.flatnonzero(found)
    if not len(places):
        return out
    quoted = addressed = clustered = 0
    for p in places.tolist():
        around = words[max(0, p - WINDOW) : p + WINDOW + 1]
        near = [w.decode("utf-8", "replace").lower() for w in around]
        before, own, after = near[: min(p, WINDOW)], near[min(p, WINDOW)], near[min(p, WINDOW) + 1 :]
        marks = (own[0] in QUOTES and own[-1].strip(".,;:!?") in (*QUOTES, "")) or own.strip(".,;:!?")[-1:] in QUOTES or (any(w[:1] in QUOTES for w in before if w) and any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after if w.rstrip(".,;:!?")))
        quoted += bool(marks or any(w.strip(".,;:!?") in QUOTING for w in before[-3:]))
        addressed += any(w.strip(".,;:!?") in SECOND for w in near)
        clustered += int((found[max(0, p - WINDOW) : p + WINDOW + 1] > 0).sum() > 1)
    kinds = np.unique(found[places])
    exact, edited = (min(12.0, float(weights[kinds[kinds % 2 == odd] // 2 - 1].sum())) for odd in (0, 1))
    strong = exact + edited
    n = len(places) / min(1.0, strong)
    out[:-1] = exact, edited, quoted / n, addressed / n, clustered / n, 10 * float(weights[found[places] // 2 - 1].sum()) / len(words)
    return out


@dataclass
class Model:
    entries: list[str] = field(default_factory=list)
    of_entries: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    bias: float = -30.0

    def score(self, x: np.ndarray) -> float:
        z = float(np.clip(x @ self.weights + self.bias, -30, 30))
        return 0.0 if z <= -30 else 1 / (1 + math.exp(-z))


def _low(n: int, of: int) -> float:
    """The lower end of Wilson's 95 % interval."""
    if not of:
        return 0.0
    z, p = 1.96, n / of
    return (p + z * z / (2 * of) - z * math.sqrt(p * (1 - p) / of + z * z / (4 * of * of))) / (1 + z * z / of)


def _chance(n: int, of: int, rate: float) -> float:
    """Chernoff's bound on the logarithm of the chance that n or more of so many texts are toxic at this rate."""
    p = n / of
    return -of * (p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0)) if p > rate else 0.0


def choose(counts: list[tuple[str, int, int]], toxic: int, other: int, least_share: float = 0.01) -> list[tuple[str, float]]:
    """counts: (word or stem with *, toxic texts, other texts), all with at least least_share of the toxic texts.

    Chosen is what toxic texts hold more often than chance allows at the 5 % level over all entries tested, and mostly (by
    Wilson's bound). An entry's weight is the log-odds of that bound. Of stems that say the same the longest stays; words
    stay beside their stems unless they are rare forms, as they allow more edits."""
    tested = [(e, n, m) for e, n, m in counts if n >= max(LEAST_TEXTS, least_share * toxic)]
    rate = min(0.5, toxic / max(toxic + other, 1))
    sure = math.log(0.05 / max(len(tested), 1))
    odds = {e: math.log(p / (1 - p)) for e, n, m in tested if (p := _low(n, n + m)) >= 0.55 and _chance(n, n + m, rate) <= sure}
    good = {e: n for e, n, _ in counts if e in odds}
    stems = sorted((e[:-1] for e in good if e.endswith("*")), key=len)
    kept: list[str] = []
    for s in stems:
        longer = max((good[f"{o}*"] for o in stems if len(o) == len(s) + 1 and o.startswith(s)), default=0)
        if longer >= 0.9 * good[f"{s}*"] and len(s) < HEADS[-1]:
            continue  # its longer form says the same
        if not any(s.startswith(k) for k in kept):
            kept.append(s)
    # a stem that is a whole word by itself stays a word, so that words merely beginning like it are left alone
    out = dict.fromkeys(k if good.get(k, 0) >= 0.9 * good[f"{k}*"] else f"{k}*" for k in kept)
    # a word beside its stem is met with more edits; a rare form of a stem is not worth an entry of its own
    of = {e: next((k for k in kept if e.startswith(k)), None) for e in good if not e.endswith("*")}
    out |= dict.fromkeys(e for e, k in of.items() if k is None or good[e] >= FORM_SHARE * good[f"{k}*"])
    one = {e: odds.get(e, odds.get(f"{e}*", 0.0)) for e in out}
    return sorted(((e, min(4.0, w)) for e, w in one.items()), key=lambda x: (-good.get(x[0], 0), x[0]))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method with a small ridge, which draws the weight of hits with edits to that of
    exact ones and the other weights to 0."""
    x = np.hstack([x, np.ones((len(x), 1))])
    x[:, 0] += x[:, 1]
    ridge = np.diag([0.3] * (x.shape[1] - 1) + [0.01])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    w[1] += w[0]
    return w[:-1], float(w[-1])


def sketch(text: Column) -> Column:
    """The smallest hash of a text's shingles (of one without words 0): near copies share it as often as they are alike."""
    from .neardup import shingles

    @F.pandas_udf("long")
    def smallest(texts: pd.Series) -> pd.Series:
        return pd.Series([int(u[0].view(np.int64)) if len(u := shingles(t)) else 0 for t in texts], dtype="int64")

    return smallest(text)


def train(rows: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """rows: labelled rows that may be learned from, a bounded number of documents; label is 0 or 1, others are left out."""
    from .common import table, text_bytes

    rows = rows.select(F.col(label).cast("int").alias("y"), text_bytes(text).alias("t")).where(F.col("y").isin(0, 1))
    # copies count once, and near copies mostly: a word of one copied text says little
    once = rows.groupBy("t").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    drawn = table(once.groupBy("y", sketch(F.col("t")).alias("s")).agg(F.min("t").alias("t")).select("y", "t"), "labelled")
    size = {r["y"]: r["count"] for r in drawn.groupBy("y").count().collect()}
    if not size.get(1):
        return Model()

    def count(batches):
        import pyarrow as pa

        n: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for y, t in zip(b.column(0), b.column(1), strict=True):
                own = set(_LETTERS.findall(t.as_py().decode("utf-8", "replace").lower()))
                n[y.as_py()].update(own | {w[:k] + "*" for w in own for k in HEADS if len(w) >= k})
        every = [e for e in {*n[0], *n[1]} if n[1][e]]  # entries that no toxic text holds are never chosen
        for i in range(0, len(every), 20_000):
            part = every[i : i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([n[1][e] for e in part], pa.int64()), pa.array([n[0][e] for e in part], pa.int64())], names=["e", "n", "m"])
        yield pa.RecordBatch.from_arrays([pa.array([""], pa.string()), pa.array([0], pa.int64()), pa.array([0], pa.int64())], names=["e", "n", "m"])

    toxic = size[1]
    counts = drawn.coalesce(1 + len(size)).mapInArrow(count, "e string, n long, m long").groupBy("e").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    often = counts.where(F.col("n") >= max(LEAST_TEXTS, 0.01 * toxic)).orderBy(F.desc("n"), "e").collect()
    chosen = choose([tuple(r) for r in often], toxic, size.get(0, 0))
    entries, of_entries = [e for e, _ in chosen], np.asarray([w for _, w in chosen])
    lexicon = Lexicon(entries)

    def measure(batches):
        import pyarrow as pa

        hits = Hits(lexicon)
        for b in batches:
            x = [features(t.as_py().split(), hits, of_entries).tolist() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = drawn.mapInArrow(measure, "y int, x array<double>").orderBy("y", "x").collect()
    w, bias = fit(np.asarray([r["x"] for r in got]), np.asarray([float(r["y"]) for r in got]))
    return Model(entries, of_entries, w, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score and predicted; what columns of these names held before is replaced."""
    from .common import text_bytes

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hits = Hits(Lexicon(model.entries))
        for texts in batches:
            yield pd.Series([model.score(features(t.split(), hits, model.of_entries)) for t in texts], dtype="float64")

    return docs.withColumn("score", judge(text_bytes(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def rate(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score, predicted. Rows whose crc32(doc_id) leaves 0 by 5 are never learned from."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    drawn = draw(labels.where(~held), per_label)
    model = train(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "score", "predicted")


def draw(labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, toxic: at most per_label documents of each label, cut down before they meet the texts."""
    from .common import table

    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    own = own.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("z")).where("toxic = z").select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"))
    n = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    share = lambda y: min(1.0, 1.3 * (per_label + 100) / max(n.get(y, 0), 1))
    near = own.where(F.pmod("h", F.lit(1_000_000)) < F.when(F.col("toxic") == 1, share(1)).otherwise(share(0)) * 1_000_000)
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.pmod("h", F.lit(1_000_000)), "h"))
    return table(near.withColumn("i", rank).where(F.col("i") <= per_label).select("doc_id", "toxic"), "drawn")
