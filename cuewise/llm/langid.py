"""Hierarchical language identification: the family first, then one against one within it.

A text is the bag of its lower-cased words; a word is the bag of its hashed n-grams (1 to 4 bytes, with
word borders). The features of a text are the shares of its n-grams, so every linear score of a text is a sum
of scores of words, and words are scored once and cached. Linear support vector machines (squared hinge loss) are
trained: for each family one against the rest, and for each pair of languages of a family one between the two.

Training reads a bounded sample of the labelled rows that the caller has cut off from held-out ones: of each language
the `per_language` distinct texts with the smallest hashes, or fewer where there are so many languages that all
of them would be more than `most_rows` (both are parameters), but one at least. Copies of a text count once, so a text
that fills a third of a language takes one place, and no language can take another's. Prediction reads whole texts
and nothing else.

Defined results: a null text, or one without a letter, is `und` with score 0; with no labelled row at all every
text is `und`; with one language every text with a letter is that language; a text labelled with several languages is
learned as each of them; of families (or languages) that score alike the first by name wins; equal rows get equal
answers, however often they are there; texts of any length are read whole; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, text_bytes

UND = "und"
DIMENSIONS = 1 << 12
#: Distinct texts that are learned from, of each language and in all (16 KB each on the driver).
PER_LANGUAGE, MOST_ROWS = 300, 6000
#: A text's place in the draw is its hash by this; of a language so many times the texts wanted come into it.
GRAIN, SPARE = 1_000_000, 6

# Families of common languages by ISO 639-1 code. Any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
}


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), f"own:{lang}")


def _grams(words: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where each word starts in "<word><word>...", and for n = 1 to 4 the places of n-grams in a word with their hashes."""
    flat = np.frombuffer(b"".join([b"<%b>" % w for w in words]), np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(flat))  # bytes from here to the word's end
    out, h = [], np.zeros(len(flat), np.uint32)
    for n in range(1, 5):
        m = len(flat) - n + 1
        h = h[:m] * np.uint32(0x01000193) ^ (flat[n - 1 :] + np.uint32(n))
        at = np.flatnonzero(left[:m] >= n)
        mixed = h[at] * np.uint32(0x9E3779B1)
        out.append((at, (mixed >> np.uint32(20)).astype(np.int64) % DIMENSIONS))
    return ends - lengths, out


def lowered(word: bytes) -> bytes:
    return word.lower() if word.isascii() else word.decode("utf-8", "replace").lower().encode()


class _Words(dict):
    """word (UTF-8 bytes) -> row in a growing table of scores; starts anew when `most` words are held."""

    def __init__(self, weights: np.ndarray, most: int = 200_000):
        self.weights, self.most = weights, most
        self.rows = np.zeros((0, weights.shape[1] + 2), dtype=np.float32)

    def _learn(self, words: list[bytes]) -> None:
        low = [lowered(w) for w in words]
        starts, grams = _grams(low)
        size = int(starts[-1]) + len(low[-1]) + 2
        each = np.zeros((size, self.weights.shape[1] + 1), np.float32)
        for at, hashes in grams:
            each[at, :-1] += self.weights[hashes]
            each[at, -1] += 1
        new = np.zeros((len(words), self.rows.shape[1]), np.float32)
        new[:, :-1] = np.add.reduceat(each, starts)
        new[:, -1] = [any(map(str.isalpha, w.decode("utf-8", "replace"))) for w in low]
        n = len(self)
        if n + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows[:n], new, np.zeros((n + len(new), self.rows.shape[1]), np.float32)])
        else:
            self.rows[n : n + len(new)] = new
        self.update(zip(words, range(n, n + len(new)), strict=True))

    def sums(self, texts) -> list[np.ndarray]:
        """For each text: sums of word scores, then the number of n-grams, then the number of words with a letter."""
        out = []
        for text in texts:
            words, own = text.split(), np.zeros(self.rows.shape[1])
            for i in range(0, len(words), 20_000):
                part = words[i : i + 20_000]
                if missing := [w for w in dict.fromkeys(part) if w not in self]:
                    if len(self) + len(missing) > self.most:
                        self.clear()
                        missing = list(dict.fromkeys(part))
                    self._learn(missing)
                at = np.fromiter(map(self.__getitem__, part), dtype=np.int64, count=len(part))
                own += self.rows[at].sum(0, dtype=np.float64)
            out.append(own)
        return out


def _svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, steps: int = 150) -> np.ndarray:
    """Weights and, last, the bias of a linear support vector machine with squared hinge loss; y is -1 or 1."""
    x, y = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32), y.astype(np.float32)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    lipschitz = 2 * c * float((share * (x**2).sum(1)).sum()) + 1e-3
    w = np.zeros(x.shape[1], np.float32)
    v, t = w.copy(), 1.0  # 32-bit all through: nothing is copied in a step
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - (np.float32(1e-3) * v - np.float32(2 * c) * (x.T @ (share * y * slack))) / np.float32(lipschitz)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = new + np.float32((old - 1) / t) * (new - w)
        w = new
    return w


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIMENSIONS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steep: float = 4.0

    def predict(self, sums: np.ndarray) -> tuple[str, float]:
        grams, letters = sums[-2], sums[-1]
        if not letters or not self.families:
            return UND, 0.0
        margins = sums[:-2] / grams + self.bias
        k = 0
        sure = 1.0
        if len(self.families) > 1:
            own = margins[: len(self.families)]
            k = int(np.argmax(own))
            sure = _sigmoid(self.steep * (own[k] - np.max(np.delete(own, k))) / 2)
        langs = self.languages[self.families[k]]
        votes, least = dict.fromkeys(langs, 0), dict.fromkeys(langs, np.inf)
        first = len(self.families) if len(self.families) > 1 else 0
        for i, (a, b) in enumerate(self.pairs):
            if a in votes:
                m = margins[first + i]
                votes[a if m >= 0 else b] += 1
                least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(langs, key=lambda x: (votes[x], least[x]))  # of equals the first
        if len(langs) > 1:
            sure *= _sigmoid(self.steep * least[best])
        return best, float(min(1.0, max(0.0, sure)))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """x: shares of n-grams by row; langs: the labels."""
    found = sorted(set(langs))
    if not found:
        return Model()
    labels = np.asarray(langs)
    own: dict[str, list[str]] = {}
    for lang in found:
        own.setdefault(family(lang), []).append(lang)
    families = sorted(own)
    mean, spread = x.mean(0), x.std(0) + 1e-4
    z = ((x - mean) / spread / np.sqrt(x.shape[1])).astype(np.float32)
    of = np.asarray([family(a) for a in langs])
    columns = [_svm(z, np.where(of == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
    pairs = [(a, b) for f in families for i, a in enumerate(own[f]) for b in own[f][i + 1 :]]
    for a, b in pairs:
        two = (labels == a) | (labels == b)
        columns.append(_svm(z[two], np.where(labels[two] == a, 1.0, -1.0)))
    if not columns:
        return Model(families, own, pairs)
    w = np.stack(columns, 1)
    scaled = w[:-1] / (spread * np.sqrt(x.shape[1]))[:, None]
    return Model(families, own, pairs, scaled.astype(np.float32), w[-1] - mean @ scaled)


def draw(rows: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> DataFrame:
    """lang, h, t: the distinct texts to learn from. rows: t (bytes), lang (not null)."""
    rows = rows.withColumn("h", F.xxhash64("t"))
    # a row for each language comes to the driver, as the model holds weights for each
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counts:
        return rows.limit(0).select("lang", "h", "t")
    each = max(1, min(per_language, most_rows // len(counts)))
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, (SPARE * each + 30) / max(r["n"], 1))))])
    near = rows.where(F.pmod("h", F.lit(GRAIN)) < share[F.col("lang")] * GRAIN)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(GRAIN)), "h"))
    few = near.select("lang", "h").distinct().withColumn("i", rank).where(F.col("i") <= each).select("lang", "h")
    few = table(few, "drawn")  # at most most_rows rows, or one a language: broadcast

    def once(batches):
        seen = set()
        for b in batches:
            own = list(zip(b.column("lang").to_pylist(), b.column("h").to_pylist(), strict=True))
            at = [i for i, x in enumerate(own) if not (x in seen or seen.add(x))]
            if at:
                yield b.take(at)

    met = near.join(F.broadcast(few), ["lang", "h"]).select("lang", "h", "t")
    return met.mapInArrow(once, met.schema).dropDuplicates(["lang", "h"])


def train(rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    """rows: labelled rows that may be learned from."""
    rows = rows.select(text_bytes(text).alias("t"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull())

    def shares(batches):
        import pyarrow as pa

        for b in batches:
            out, langs = [], []
            for t, own in zip(b.column("t"), b.column("lang"), strict=True):
                words = [lowered(w) for w in t.as_py().split()]
                if words:
                    x = sum(np.bincount(h, minlength=DIMENSIONS) for _, h in _grams(words)[1]).astype(np.float64)
                    out.append((x / x.sum()).astype("<f4").tobytes())
                    langs.append(own.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "x"])

    got = draw(rows, per_language, most_rows).mapInArrow(shares, "lang string, x binary").orderBy("lang", F.md5("x")).collect()
    if not got:
        return Model()
    return fit(np.stack([np.frombuffer(r["x"], "<f4") for r in got]), [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; what columns of these names held before is replaced."""
    @F.pandas_udf("lang string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(model.weights)
        for texts in batches:
            rows = [model.predict(x) for x in words.sums(texts)]
            yield pd.DataFrame(rows, columns=["lang", "score"])

    p = "_lang_prediction"
    # said not to be deterministic, so that a filter on the answer does not ask a second time
    return docs.withColumn(p, judge.asNondeterministic()(text_bytes(text))).withColumn("lang_pred", F.col(f"{p}.lang")).withColumn("score", F.col(f"{p}.score")).drop(p)


def remainder(of: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Rows whose crc32(doc_id) leaves 1 by 3 are never learned from."""
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    model = train(docs.where(~held), per_language=per_language)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
