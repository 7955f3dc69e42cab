"""Quality rules as a bitmask ledger (native DataFrame operations only).

`ledger` evaluates every rule of a rule set once and gives, per document, the measurements and one integer whose bit k
says that rule k failed. It is written once; a `Policy` is a versioned mask over those bits, so every policy is applied to
the stored ledger without reading a text again, and ablations (what each rule removes alone, and what would come
back without it) are sums over distinct masks.

Defined results: a null text has no words, symbols or lines and counts 0 everywhere; an empty table gives an
empty ledger and ablations of 0 rows; a measurement just at a rule's limit passes; repeated rows are judged one by one;
other columns of the table, whatever their names, are not read. Whole texts are measured, however long. Three-word
windows are told apart by 64-bit hashes: two different ones of a text of a million words agree with a chance of 3e-8.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD_PATTERN, table

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """fails: SQL over the measurements n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words and n_capitals
    that is true where the rule fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


#: The order gives the bits and is never changed; new rules are appended.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("shouting", "2 * n_capitals > word_chars"),
    Rule("many_duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
)
BASE = Policy("base-1", ("too_few_words", "repeated_words"))
STRICT = Policy("production-1", ("symbols", "many_duplicate_lines", "short_words", "long_words", "shouting"))
#: Since version 2 repeated lines fail a text only if they are most of it.
PRODUCTION = Policy("production-2", ("symbols", "duplicate_lines", "short_words", "long_words", "shouting"))


def let(value: Column, use) -> Column:
    """use(value) with value computed once for a row, although use() refers to it inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window that the array w holds twice or more.

    Windows are sorted by hash with their place, so equal ones are neighbours: no group leaves the row.
    """

    def marked(s: Column) -> Column:
        n = F.size(s)
        same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
        hits = F.filter(
            F.transform(
                s,
                lambda x, i: F.when(((i > 0) & same(i, i - 1)) | ((i + 1 < n) & same(i, i + 1)), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )
        # hits in order of place: each adds its three words but for those that the next one adds
        return let(F.sort_array(hits), lambda h: F.aggregate(F.transform(h, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(h, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    def counted(h: Column) -> Column:
        # most texts repeat no window, which a set of hashes tells faster than a sort
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(placed), marked))

    windows = F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, counted))


def measures(text: Column) -> Column:
    """A struct of all measurements of a text."""
    t = F.coalesce(text.cast("string"), F.lit(""))

    def lines(s: Column) -> Column:
        worded = F.filter(F.split(s, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return let(worded, lambda a: F.struct((F.size(a) - F.size(F.array_distinct(a))).alias("dup"), F.size(a).alias("n")))

    def of(w: Column) -> Column:
        two = lines(t)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
            (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            two.alias("lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
            (F.char_length(t) - F.char_length(F.translate(t, CAPITALS, ""))).cast("long").alias("n_capitals"),
        )

    return let(words(t), of)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: the key, every measurement, and failed, whose bit k stands for rules[k]."""
    m = docs.select(F.col(key), measures(F.col(text)).alias("m"))
    flat = m.select(
        key,
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        F.col("m.lines.dup").cast("long").alias("n_dup_lines"),
        F.col("m.lines.n").cast("long").alias("n_lines"),
        "m.n_repeat_words",
        "m.n_capitals",
    )
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return flat.withColumn("failed", bits)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    at = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << at[name] for name in dict.fromkeys(policy.rules))


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(ledger: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    The ledger is summed by distinct mask first (at most 2 ** rules rows), and the rest is bit arithmetic.
    """
    by_mask = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    at = {r.name: k for k, r in enumerate(rules)}
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << at[name]).cast("long").alias("bit")) for name in dict.fromkeys(policy.rules)]))
    each = by_mask.select("m", "n", rows.alias("r")).select("m", "n", "r.rule", "r.bit")
    hit = F.col("m").bitwiseAND(F.col("bit")) != 0
    zero = F.lit(0).cast("long")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(zero)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("bit"), F.col("n")).otherwise(zero)).alias("n_failed_alone"),
        F.sum(F.when((F.col("m") == 0) | (F.col("m") == F.col("bit")), F.col("n")).otherwise(zero)).alias("n_kept_without"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """The stored ledger under the base policy and the production policy, and under the production policy's first version."""
    return table(ledger(docs), "ledger").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(PRODUCTION)).alias("kept"),
        "failed",
        (passes(BASE) & passes(STRICT)).alias("kept_by_version_1"),
    )


def all_ablations(docs: DataFrame) -> DataFrame:
    """version and the ablations of both versions of the production policy, the base rules with them, from one stored ledger."""
    stored, out = table(ledger(docs), "ledger"), None
    for policy in (STRICT, PRODUCTION):
        one = ablations(stored, Policy(policy.version, BASE.rules + policy.rules)).withColumn("version", F.lit(policy.version))
        out = one if out is None else out.unionByName(one)
    return out


_LEDGER = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS w
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM w WHERE len(w) >= 4
), k AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM g
), r AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM k WHERE n > 1) GROUP BY doc_id
), l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_PATTERN}')) AS a FROM w
), m AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(a) - len(list_distinct(a)))::BIGINT AS n_dup_lines, len(a)::BIGINT AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, ((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 128 ELSE 0 END))::BIGINT AS failed
  FROM m
)"""
ORACLE = f"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, (failed & 127) = 0 AS kept, failed, (failed & 247) = 0 AS kept_by_version_1
FROM f
"""
ABLATIONS_ORACLE = f"""{_LEDGER}, p(version, masked) AS (VALUES ('production-1', 247), ('production-2', 127)),
b(rule, bit) AS (VALUES ('too_few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('short_words', 16),
  ('long_words', 32), ('shouting', 64), ('many_duplicate_lines', 128)),
e AS (SELECT version, rule, bit, masked FROM p JOIN b ON (masked & bit) <> 0)
SELECT version, rule, count(*) FILTER (WHERE (failed & bit) <> 0)::BIGINT AS n_failed,
       count(*) FILTER (WHERE (failed & masked) = bit)::BIGINT AS n_failed_alone,
       count(*) FILTER (WHERE (failed & masked) IN (0, bit))::BIGINT AS n_kept_without
FROM f, e GROUP BY version, rule
"""
