"""URL filters by a sort-merge range join.

A host's labels are reversed and each closed by \\x01, so "www.example.com" becomes "com\\x01example\\x01www\\x01" and
a host with all its subdomains is one interval of keys: those that start with the host's own key. URLs and rules are
laid out by ranges of that key; each range is sorted and swept once, with a stack of the rules whose interval is
open. Stacked rules are nested, so the stack is no higher than a host has labels (times the rules of one host). A
rule is sent to every range that its interval meets. Range borders come from a bounded sample of keys; they hold
the path and a hash of the page as well, so one host, or one url, that fills a third of the table is split too.

A rule fits the urls of its host and all subdomains whose path starts with the rule's path; the longest fitting
rule (host and path as written) wins, of two as long the one with the longer host; of rules with one host and path but
different verdicts the verdict that comes last in the alphabet wins, so `block` before `allow`. Without one the
verdict is `default`.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule; an empty host fits
no rule; repeated rows are judged one by one, urls of any length whole; an empty table or rule set is allowed; other columns are not read.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys sampled for each range border; the driver holds at most this times the ranges.
SAMPLE = 40


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(line: str) -> Rule:
    """"block example.com/en/" -> Rule."""
    verdict, _, rest = line.partition(" ")
    host, slash, path = rest.partition("/")
    return Rule(verdict, host.lower(), slash + path)


RULES = tuple(map(parse_rule, ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")))
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, CAPITALS, SMALL)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(h: Column) -> Column:
    return F.when(h == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(h, r"\.")), "\x01"), F.lit("\x01")))


class Stack:
    """The rules whose interval holds the key last seen; keys come in ascending order."""

    def __init__(self):
        self.open: list[tuple[str, list]] = []

    def _close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def push(self, key: str, rule: tuple[str, str, str, str]) -> None:
        self._close(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, []))
        self.open[-1][1].append(rule)

    def best(self, key: str, host: str, path: str):
        """The longest fitting rule: (name, path, verdict, host). Hosts are compared once more, as a host with control
        characters may have another host's key."""
        self._close(key)
        fits = [(len(r[0]), len(r[3]), r) for _, own in self.open for r in own if path.startswith(r[1]) and (host == r[3] or host.endswith("." + r[3]))]
        return max(fits)[2] if fits else None


def judge(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, key: str = "page_id", url: str = "url", default: str = "allow", ranges: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row. rules: Rule objects or a table of verdict, host, path."""
    spark = pages.sparkSession
    ranges = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    u = F.col(url).cast("string")
    urls = pages.select(F.col(key).cast("long").alias("page_id"), host(u).alias("host"), path(u).alias("path"))
    salt = F.concat(F.lit("\x02"), F.hex(F.xxhash64("page_id")))
    urls = urls.select("page_id", "host", "path", host_key(F.col("host")).alias("k")).withColumn("at", F.concat("k", "path", salt))
    total = urls.count()
    share = min(1.0, 4.0 * SAMPLE * ranges / max(total, 1))
    sample = urls.where(F.abs(F.xxhash64(F.lit("sample"), "at") % 1_000_000) < int(share * 1_000_000) + 1).select("at")
    keys = sorted(r["at"].encode() for r in sample.orderBy(F.xxhash64("at")).limit(SAMPLE * ranges).collect())
    borders = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return _sweep(urls, rules, borders, default)


def _sweep(urls: DataFrame, rules: DataFrame, borders: list[bytes], default: str) -> DataFrame:
    @F.pandas_udf("int")
    def place(at: pd.Series) -> pd.Series:
        return at.map(lambda x: bisect.bisect_right(borders, x.encode())).astype("int32")

    @F.pandas_udf("array<int>")
    def places(k: pd.Series) -> pd.Series:
        return k.map(lambda x: list(range(bisect.bisect_right(borders, x.encode()), bisect.bisect_right(borders, x.encode() + b"\xff") + 1)))

    none = F.lit(None).cast("string")
    left = urls.select(place("at").alias("part"), "at", "k", F.lit(1).alias("kind"), "page_id", "host", "path", none.alias("verdict"))
    r = rules.select(host_key(F.col("host")).alias("k"), "host", "path", "verdict").where(F.col("k") != "")
    right = r.select(F.explode(places("k")).alias("part"), F.col("k").alias("at"), "k", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    n = len(borders) + 1
    laid = left.unionByName(right).repartitionById(n, "part").sortWithinPartitions("part", "at", "kind")

    def sweep(batches):
        import pyarrow as pa

        part, stack = None, Stack()
        for b in batches:
            ids, hosts, paths, names, verdicts = [], [], [], [], []
            for p, k, kind, page, h, w, v in zip(*(b.column(c).to_pylist() for c in ("part", "k", "kind", "page_id", "host", "path", "verdict")), strict=True):
                if p != part:
                    part, stack = p, Stack()
                if kind == 0:
                    stack.push(k, (h + w, w, v, h))
                    continue
                best = stack.best(k, h, w)
                ids.append(page)
                hosts.append(h)
                paths.append(w)
                names.append(best and best[0])
                verdicts.append(best[2] if best else default)
            s = pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hosts, s), pa.array(paths, s), pa.array(names, s), pa.array(verdicts, s)], names=["page_id", "host", "path", "rule", "verdict"])

    return laid.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")


ORACLE = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), r(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), j AS (
  SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE n = 1
"""
