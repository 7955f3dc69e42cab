"""The stages of the training-data pipeline, each one of the operators at work on whole documents.

Each takes docs, a table with doc_id, text, lang, source and n_chars among its columns, and gives it back with the same
columns (packing gives pieces). Every stage holds the documents as one struct while it works, so a column of docs may
have any name. All of them read whole texts, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import langid, mixing, neardup, packing, secrets
from .common import bounded_broadcast, packed, skew_join, table

#: Ids up to this many (some 8 bytes each) are broadcast; beyond it they are joined by shuffle.
MOST_BROADCAST = 1_000_000
#: Texts of this similarity or more are near copies here; the query of the operator has its own contract.
NEAR = 0.8


def replaced(columns: list[str], of: dict) -> list:
    """The fields of the struct `row`, with some given anew."""
    return [(of[c] if c in of else F.col(f"row.`{c}`")).alias(c) for c in columns]


def language(docs: DataFrame) -> DataFrame:
    """Documents without a language (operator 7 says `und`: a null text, or one without a letter) go; a null lang becomes
    the predicted one.

    Learns from rows of docs with a lang that are not held out. Where no row has one, nothing is learned: then only the
    letter counts and lang stays null. A given lang stays, whatever is predicted. Ties between languages: see
    langid. Repeated rows are judged alike and all stay; very long texts are read whole.
    """
    model = langid.train(docs.where(~F.coalesce(langid.remainder(3) == 1, F.lit(False))))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    marked = langid.predict(packed(docs).withColumn("text", F.col("row.text")), model).where(F.col("lang_pred") != langid.UND)
    return marked.select(*replaced(docs.columns, {"lang": F.coalesce("row.lang", "lang_pred")}))


def near_dedup(docs: DataFrame) -> DataFrame:
    """Of every group of near copies one document stays: the one with the smallest id.

    Null texts and texts without words are like nothing and stay, as do rows with a null id. Rows that share an id are told
    apart by their text: different texts under one id stay or go each with its own group; of several rows of one
    group with the group's smallest id, one stays (by a hash of the row, so reruns agree). Texts of any length are compared whole.
    """
    finder = neardup.Finder(docs, NEAR, "doc_id", "text")
    rows = table(finder.rows().select("doc_id", "n_shingles", "k1", "k2", "component_id", "kept"), "dedup")
    repeated = table(rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("id")), "repeated")
    n = repeated.count()
    twice = bounded_broadcast(repeated, n, MOST_BROADCAST)
    gone = table(rows.where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct().join(twice, "id", "left_anti"), "gone")
    whole = packed(docs).withColumn("id", F.col("row.doc_id").cast("long"))
    left_out = table(gone.select("id").unionByName(repeated), "left_out") if n else gone
    single = whole.join(bounded_broadcast(left_out, left_out.count(), MOST_BROADCAST), "id", "left_anti").select("row.*")
    if not n:
        return single
    # rows under an id that is there more than once: their sets' digests say which group each belongs to
    several = whole.join(twice, "id", "left_semi")
    several = table(several.withColumn("d", neardup.digest(F.col("row.text"))).select("id", "row", "d.n", "d.k1", "d.k2"), "several")
    groups = finder.groups().select("k1", "k2", "component_id")
    grouped = skew_join(several.where("n > 0"), groups, ["k1", "k2"], "left")
    first = grouped.where("id = component_id").groupBy("id", "component_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.unionByName(first.select("row.*")).unionByName(several.where("n = 0").select("row.*"))


def secret_scan(docs: DataFrame) -> DataFrame:
    """Every secret in a text is replaced by a mark, and n_chars follows the text; all rows stay.

    A null text stays null, and its n_chars as it is; an empty one stays empty. Of overlapping spans the union goes. Formats
    are learned from docs and from public ones (see secrets). Repeated rows are treated alike; texts are scanned whole.
    """
    clean = secrets.redact(packed(docs).withColumn("text", F.col("row.text")), scanner=secrets.learn(docs))
    n = F.coalesce(F.char_length("text").cast("long"), F.col("row.n_chars").cast("long"))
    return clean.select(*replaced(docs.columns, {"text": F.col("text"), "n_chars": n}))


def mix(docs: DataFrame) -> DataFrame:
    """Each document as many times as the mix takes it, 0 to 3 times.

    Null and empty texts have no size and are taken 0 times; a null source is a source; rows with one id share one hash and
    are taken alike, repeated rows each; a table without words gives no rows. Ties of hashes fall together.
    """
    sized = table(mixing.sized(docs), "sizes")
    plan = mixing.plan(sized)
    own = packed(docs).select("row", mixing.hashed(F.col("row.doc_id")).alias("h"), F.col("row.source").alias("source"), mixing.words(F.col("row.text")).alias("words"))
    met = own.join(bounded_broadcast(plan, plan.count(), mixing.MOST_BROADCAST), F.col("source").eqNullSafe(F.col("_source")))
    n = F.when(F.col("words") > 0, mixing.copies(F.col("_whole"), F.col("h"), F.col("_last"))).otherwise(0)
    taken = met.select("row", n.alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of all sequences; a null or empty text is its end id alone, repeated rows are packed one by one, very long
    texts fill as many windows as they need. See packing.pack."""
    return packing.pack(docs, tokenizer)
