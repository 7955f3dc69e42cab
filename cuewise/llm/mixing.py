"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash. A source's share is all its documents a whole number of times and, for the
rest of its target, those whose hash is not above a threshold. The threshold is found without sorting: sizes
are summed by source and by the next 12 bits of the hash, the bucket in which the running sum crosses the budget
is kept, and only that bucket is split by the following 12 bits, until it holds one hash. Thresholds of growing
budgets are nested, and reruns agree since the hash depends on the key alone.

Defined results: a null text has size 0; a null source is a source of its own and comes last; sources without
words get target 0; an empty table gives an empty mix; texts of any length are counted whole; of two thresholds equally
near the budget the smaller wins; rows with one key share one hash, so they are taken or left
together; columns other than the key, source and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_PATTERN, bounded_broadcast, table

BITS, LEVELS = 12, 5
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Sources up to this many are broadcast to the documents (some 100 bytes each); beyond it they are joined by shuffle.
MOST_BROADCAST = 100_000


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """key, source, size in words and hash, and nothing else."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        words(F.col(text)).alias("size"),
        hashed(F.col(key)).alias("h"),
    )


def words(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def hashed(key: Column) -> Column:
    """The 60-bit hash of a key; null counts as an empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def ranked(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """sources with rank from 0 by code point, null last: ranges are numbered in parallel, then shifted."""

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield b.append_column("part", pa.array([part] * b.num_rows, pa.int32())).append_column("i", pa.array(range(n, n + b.num_rows), pa.int64()))
            n += b.num_rows

    schema = T.StructType([*sources.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("i", T.LongType())])
    by = F.col("source").asc_nulls_last()
    numbered = table(sources.repartitionByRange(by).sortWithinPartitions(by).mapInArrow(number, schema), "sources")
    base, before = {}, 0
    for r in sorted(numbered.groupBy("part").count().collect()):  # a row for each partition
        base[r["part"]], before = before, before + r["count"]
    if not base:
        return numbered.select("source", "total", F.lit(0).cast("long").alias("rank"))
    starts = F.create_map(*[x for k, v in base.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return numbered.select("source", "total", (F.col("i") + starts[F.col("part")]).alias("rank"))


def targets(spark: SparkSession, sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, total, target. The sum of all sizes is shared by weight; no target is above most times its total.

    With a set of capped sources fixed, every other target is weight * level; sources above their cap join the
    set until none is above. Each round is one aggregate over the written table of sources and caps one source more at least,
    so there are no more rounds than sources; as the level follows a concave line of pieces, it is a handful in practice
    (each round that caps anything raises the level, and only sources between the old level and the new one remain).
    """
    ranks = ranked(spark, sized.groupBy("source").agg(F.sum("size").alias("total")))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = ranks.select("source", "total", weight.alias("weight"))
    level, capped = None, -1
    while True:
        cap = F.lit(most) * F.col("total")
        # a source is above its cap at the level so far; capped ones stay capped since the level only rises
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        zero = F.lit(0).cast("long")
        x = t.agg(
            F.sum("total").alias("all"),
            F.sum(F.when(above, cap).otherwise(zero)).alias("held"),
            F.sum(F.when(above, zero).otherwise(F.col("weight"))).alias("weights"),
            F.sum(F.when(above, 1).otherwise(0)).alias("n"),
        ).first()
        if not x["weights"] or x["n"] == capped:
            break
        capped, level = x["n"], (x["all"] - x["held"]) / x["weights"]
    cap = (F.lit(most) * F.col("total")).cast("double")
    if level is None:
        return t.select("source", "total", F.lit(0.0).alias("target"))
    return t.select("source", "total", F.least(F.lit(level) * F.col("weight"), cap).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, last: the hash up to which a source's documents are taken, -1 for none.

    budgets: source, budget in words. The sums up to last come as near to the budget as one hash allows; of two
    as near, the smaller. Each level sums the documents of the boundary buckets only.
    """
    spark = sized.sparkSession
    n = budgets.count()
    state = budgets.select("source", F.col("budget").cast("double").alias("budget"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(False).alias("found"), F.lit(-1).cast("long").alias("last"))
    rows = sized.select("source", "size", "h").where(F.col("size") > 0)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        s = bounded_broadcast(state.where(~F.col("found")).select(F.col("source").alias("s"), "prefix"), n, MOST_BROADCAST)
        inside = rows.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + BITS) == F.col("prefix")))
        buckets = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        w = Window.partitionBy("source").orderBy("bucket")
        ran = buckets.withColumn("upto", F.sum("n").over(w)).join(
            bounded_broadcast(state.where(~F.col("found")).select(F.col("source").alias("s"), "budget", "before", "last"), n, MOST_BROADCAST), F.col("source").eqNullSafe(F.col("s"))
        )
        upto = F.col("before") + F.col("upto")
        ran = ran.withColumn("to", upto).withColumn("from", upto - F.col("n"))
        under = F.col("to") <= F.col("budget")
        crossing = ~under & (F.col("from") <= F.col("budget"))
        zero = F.lit(None)
        found = ran.groupBy("source").agg(
            F.max(F.when(under, F.col("hi"))).alias("under"),
            F.max(F.when(under, F.col("to"))).alias("under_n"),
            F.max(F.when(crossing, F.col("bucket")).otherwise(zero)).alias("bucket"),
            F.max(F.when(crossing, F.col("lo"))).alias("lo"),
            F.max(F.when(crossing, F.col("hi"))).alias("hi"),
            F.max(F.when(crossing, F.col("to"))).alias("over_n"),
        )
        old = state.select(F.col("source").alias("s"), F.col("budget"), F.col("prefix").alias("p0"), F.col("before").alias("b0"), F.col("found").alias("f0"), F.col("last").alias("l0"))
        j = old.join(found, F.col("s").eqNullSafe(F.col("source")), "left")
        last = F.coalesce(F.col("under"), F.col("l0"))
        before = F.coalesce(F.col("under_n"), F.col("b0"))
        one = F.col("lo") == F.col("hi")
        nearer = F.col("over_n") - F.col("budget") < F.col("budget") - before
        state = table(
            j.select(
                F.col("s").alias("source"),
                "budget",
                F.when(F.col("f0"), F.col("p0")).otherwise(F.coalesce(F.col("bucket"), F.col("p0"))).alias("prefix"),
                F.when(F.col("f0"), F.col("b0")).otherwise(before).alias("before"),
                (F.col("f0") | F.col("bucket").isNull() | one).alias("found"),
                F.when(F.col("f0"), F.col("l0")).when(F.col("bucket").isNotNull() & one & nearer, F.col("hi")).otherwise(last).alias("last"),
            ).coalesce(8 if n <= MOST_BROADCAST else 200),
            f"budgets{level}",
        )
        if not state.where(~F.col("found")).limit(1).count():
            break
    return state.select("source", "last")


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """_source, _total, _target, _whole (times that all of it is taken), _last (up to which hash once more)."""
    t = targets(sized.sparkSession, sized, weights, most)
    whole = F.when(F.col("total") > 0, F.least(F.floor(F.col("target") / F.col("total")), F.lit(most))).otherwise(F.lit(0)).cast("long")
    t = table(t.withColumn("whole", whole), "targets")
    last = thresholds(sized, t.select("source", (F.col("target") - F.col("whole") * F.col("total")).alias("budget")))
    j = t.join(last.select(F.col("source").alias("_source"), F.col("last").alias("_last")), F.col("source").eqNullSafe(F.col("_source")))
    return table(j.select("_source", F.col("total").alias("_total"), F.col("target").alias("_target"), F.col("whole").alias("_whole"), "_last"), "plan")


def copies(whole: Column, h: Column, last: Column, most: int = MOST_REPEATS) -> Column:
    return F.least(whole + F.when(h <= last, 1).otherwise(0), F.lit(most)).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs; taken is size times the copies the mix holds."""
    s = table(sized(docs), "sizes")
    p = plan(s, weights, most)
    out = s.join(bounded_broadcast(p, p.count(), MOST_BROADCAST), F.col("source").eqNullSafe(F.col("_source")))
    n = copies(F.col("_whole"), F.col("h"), F.col("_last"), most)
    return out.select("doc_id", "size", F.col("_total").alias("source_size"), F.col("_target").alias("target"), (F.col("size") * n).cast("long").alias("taken"), n.alias("copies"))


ORACLE = rf"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS total,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM s GROUP BY source
), o AS (
  SELECT *, sum(3 * total) OVER w AS held_after, sum(weight) OVER w AS weight_after,
         sum(total) OVER () AS every, sum(weight) OVER () AS weights
  FROM t WINDOW w AS (ORDER BY total::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), c AS (
  SELECT *, (every - (held_after - 3 * total))::DOUBLE / (weights - (weight_after - weight))::DOUBLE AS level FROM o
), l AS (
  SELECT max(level) FILTER (WHERE level * weight <= 3 * total) AS level FROM c
), g AS (
  SELECT source, total, least(l.level * weight, (3 * total)::DOUBLE) AS target FROM t, l
), k AS (
  SELECT *, CASE WHEN total > 0 THEN least(floor(target / total), 3) ELSE 0 END::BIGINT AS whole FROM g
), b AS (
  SELECT *, target - whole * total AS budget FROM k
), h AS (
  SELECT source, h, sum(size) AS n FROM s WHERE size > 0 GROUP BY source, h
), r AS (
  SELECT h.source, h.h, n, sum(n) OVER (PARTITION BY h.source ORDER BY h.h) AS upto, b.budget
  FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source
), u AS (
  SELECT source, max(h) AS last FROM r
  WHERE upto <= budget OR (upto - n <= budget AND upto - budget < budget - (upto - n)) GROUP BY source
)
SELECT s.doc_id, s.size, b.total AS source_size, b.target,
       (s.size * least(b.whole + CASE WHEN s.h <= coalesce(u.last, -1) THEN 1 ELSE 0 END, 3))::BIGINT AS taken,
       least(b.whole + CASE WHEN s.h <= coalesce(u.last, -1) THEN 1 ELSE 0 END, 3)::INTEGER AS copies
FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN u ON s.source IS NOT DISTINCT FROM u.source
"""
