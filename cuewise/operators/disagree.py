"""How much two runs over the same recordings differ (no error rate: neither run is the truth)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import distance, textnorm


def pair(first: DataFrame, second: DataFrame, on: tuple[str, ...] = ("rec", "window")) -> DataFrame:
    """Texts of the same window side by side: text_a, text_b. Comparisons stay within windows, as edit distance is quadratic."""
    a = first.select(*on, F.col("text").alias("text_a"))
    return a.join(second.select(*on, F.col("text").alias("text_b")), list(on))


def _bound(value: Column, use) -> Column:
    """use(value) with value computed once for a row, also where use() refers to it for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def char_windows(first: DataFrame, second: DataFrame, size: int = 45, on: tuple[str, ...] = ("rec", "window")) -> DataFrame:
    """Whole texts cut into windows of `size` characters, the same places of both side by side: on, part, text_a, text_b.

    What one text has beyond the other meets an empty window, and null is empty, so every character is compared.
    """
    cut = lambda c: F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    both = F.arrays_zip(cut("text_a").alias("a"), cut("text_b").alias("b"))
    rows = pair(first, second, on).select(*on, F.posexplode(both).alias("part", "w"))
    return rows.select(*on, "part", *[F.coalesce(f"w.{x}", F.lit("")).alias(f"text_{x}") for x in "ab"])


def word_windows(first: DataFrame, second: DataFrame, size: int = 45, on: tuple[str, ...] = ("rec", "window")) -> DataFrame:
    """As char_windows, for the normal forms of words: on, part, words_a, words_b."""

    def pieces(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w), F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(w, i, size))

    def cut(c: str) -> Column:
        return _bound(textnorm.words(F.coalesce(F.col(c), F.lit(""))), pieces)

    none = F.array().cast("array<string>")
    both = F.arrays_zip(cut("text_a").alias("a"), cut("text_b").alias("b"))
    rows = pair(first, second, on).select(*on, F.posexplode(both).alias("part", "w"))
    return rows.select(*on, "part", *[F.coalesce(f"w.{x}", none).alias(f"words_{x}") for x in "ab"])


def windows_by_characters(windows: DataFrame) -> DataFrame:
    """Edits of each window, without Python."""
    rows = windows.withColumn("n_chars", F.char_length("text_a").cast("bigint")).withColumn("edits", F.levenshtein("text_a", "text_b").cast("bigint"))
    return rows.withColumn("disagreement", distance.disagreement(F.col("edits"), F.col("n_chars")))


def windows_by_words(windows: DataFrame) -> DataFrame:
    """Edits of each window, by Arrow: no built-in function has a distance of arrays."""
    rows = windows.withColumn("n_words", F.size("words_a").cast("bigint")).withColumn("edits", distance.word_edits(F.col("words_a"), F.col("words_b")))
    return rows.withColumn("disagreement", distance.disagreement(F.col("edits"), F.col("n_words")))


def pool(**runs: DataFrame) -> DataFrame:
    """All runs in one table with the column model."""
    out = None
    for name, df in runs.items():
        df = df.withColumn("model", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def by_characters(pairs: DataFrame) -> DataFrame:
    e = distance.char_edits(F.col("text_a"), F.col("text_b"))
    return pairs.withColumn("n_chars", F.char_length("text_a").cast("bigint")).withColumn("edits", e).withColumn("disagreement", distance.disagreement(F.col("edits"), F.col("n_chars")))


def by_words(pairs: DataFrame) -> DataFrame:
    rows = pairs.withColumn("_a", textnorm.words(F.col("text_a"))).withColumn("_b", textnorm.words(F.col("text_b")))
    rows = rows.withColumn("n_words", F.size("_a").cast("bigint")).withColumn("edits", distance.word_edits(F.col("_a"), F.col("_b")))
    return rows.withColumn("disagreement", distance.disagreement(F.col("edits"), F.col("n_words"))).drop("_a", "_b")


def total(rows: DataFrame, by: str = "rec", size: str = "n_words") -> DataFrame:
    """Sums by recording and over all (there rec is null): all edits over all words of the first run."""
    s = rows.rollup(by).agg(F.sum("edits").alias("edits"), F.sum(size).alias(size))
    return s.withColumn("disagreement", distance.disagreement(F.col("edits"), F.col(size)))
