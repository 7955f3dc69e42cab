"""Near-duplicate documents with HyperMinHash registers.

1. Every text becomes its set of five-word shingles (64-bit hashes). The top 8 bits of a hash name one of 256 buckets;
   the smallest rest in a bucket is stored as a register of 16 bits: its leading zeros (6) and the 10 bits that follow
   the first one. Equal sets are folded into one class at once, so that copies never meet each other.
2. Empty registers borrow from a filled one that their own chain of probes finds (and remember which); bands of registers are hashed: as
   wide ones as miss at most 1 pair in a million at the threshold (36 of 7 at 0.85, 51 of 5 at 0.8).
3. In each band bucket every class is paired with the bucket's first and last class only, whatever its size: counts and
   extremes are aggregated, not grouped, and come back to the members by a join that deals large buckets over all tasks.
   Each class's best pair (most shared bands) is confirmed first; connected components of these links settle the dense
   groups with about one confirmation a class.
4. What is left: in buckets of up to three classes the pairs that join two components (first and last meet everyone
   there), and in larger buckets from several components all links across them. Those buckets are cut into blocks of full
   sets of about BLOCK_BYTES each; every two blocks are one row, dealt on its own, and are compared at once by a product of
   0/1 matrices, which is exact. A pair of blocks gives one link for each two components that it joins, so far fewer rows
   come out than there are pairs, and none is capped.
5. The similarity of a pair from step 3 is estimated from its registers, corrected for chance collisions; pairs clearly
   below the threshold go, and the others are confirmed on their full sets of 64-bit hashes (two different shingles share
   one with a chance of 2e-11 even between two sets of 20,000).

Components are found by alternating large-star and small-star steps over tables in the shared folder, hubs of any
size included; nothing is collected to the driver.

Defined results: null texts and texts without words have the empty set, link with nothing and are kept; a text of one
to four words is one shingle; equal rows are one class; rows that share an id are told apart by their sets; rows with a null
doc_id are their own component with a null id and are kept; texts just at the threshold are linked; an empty table gives
no rows; other columns are not read; whole texts are used, however long.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, limit, scratch, skew_join, table, text_bytes

WORDS = 5
BUCKETS, MANTISSA = 256, 10
#: The share of pairs just at the threshold that may meet in no band.
MISSED = 1e-6
#: Ids up to this many (8 bytes each) are broadcast to the texts; beyond it they are joined by shuffle.
MOST_BROADCAST = 1_000_000
#: Estimates this many standard deviations below the threshold are dropped unconfirmed.
DEVIATIONS = 4.5
#: Bytes of sets in a block, and cells of a matrix that compares two of them.
BLOCK_BYTES, CELLS = 1 << 20, 1 << 22
_M = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=64)
def shape(threshold: float) -> tuple[int, int]:
    """Bands and registers a band: the widest bands of which texts at the threshold share one but for MISSED of the pairs."""
    for rows in range(BUCKETS, 1, -1):
        if (1 - threshold**rows) ** (BUCKETS // rows) <= MISSED:
            return BUCKETS // rows, rows
    return BUCKETS, 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    import xxhash

    own = text.lower().split()  # bytes: lower-cases A-Z alone and splits at the six ASCII white spaces
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, n)
    k = min(words, n)
    out = h[: n - k + 1].copy()
    for i in range(1, k):
        out = out * _M + h[i : n - k + 1 + i]
    return np.unique(_mix(out + np.uint64(k)))


def registers(u: np.ndarray) -> np.ndarray:
    """256 registers of a sorted set of hashes; 0 is an empty one."""
    out = np.zeros(BUCKETS, np.uint16)
    if len(u):
        bucket = (u >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = u[first] & np.uint64((1 << 56) - 1)
        bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)  # of a number's length, rounded alike in all texts
        up = np.maximum(MANTISSA + 1 - bits, 0).astype(np.uint64)
        down = np.maximum(bits - MANTISSA - 1, 0).astype(np.uint64)
        mantissa = ((rest >> down) << up) & np.uint64((1 << MANTISSA) - 1)
        out[bucket[first]] = ((57 - np.minimum(bits, 56)) << MANTISSA) | mantissa.astype(np.int64)
    return out


@functools.lru_cache(maxsize=1)
def _probes() -> np.ndarray:
    """For each attempt and bucket the bucket to borrow from."""
    return (_mix(np.arange(4096 * BUCKETS, dtype=np.uint64) * _M + np.uint64(7)) >> np.uint64(56)).astype(np.int64).reshape(4096, BUCKETS)


def _sources(filled: np.ndarray) -> np.ndarray:
    """For each bucket itself if filled, else the first filled one of its attempts: small sets are spread evenly too."""
    out = np.tile(np.arange(BUCKETS), (len(filled), 1))
    row, bucket = np.nonzero(~filled)
    for probe in _probes():
        if not len(row):
            return out
        p = probe[bucket]
        hit = filled[row, p]
        out[row[hit], bucket[hit]] = p[hit]
        row, bucket = row[~hit], bucket[~hit]
    out[row, bucket] = filled.argmax(1)[row]
    return out


def band_keys(r: np.ndarray, threshold: float = 0.85) -> np.ndarray:
    """r: rows of registers, none all empty. One 64-bit key a band."""
    bands, rows = shape(threshold)
    source = _sources(r > 0)
    value = (np.take_along_axis(r, source, 1).astype(np.uint64) << np.uint64(8)) | source.astype(np.uint64)
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(r), 1))
    for j in range(rows):
        keys = _mix(keys * _M + value[:, j * bands : (j + 1) * bands])
    return keys.astype(np.int64)


@functools.lru_cache(maxsize=4096)
def _chance(a: int, b: int) -> float:
    """The chance that two unrelated sets of 2**(a/2) and 2**(b/2) shingles agree in a register that both have filled."""
    edges = np.concatenate([[0.0], *[2.0**-z * (1 + np.arange(32) / 32) / 2 for z in range(56, -1, -1)], [1.0]])
    p = []
    for n in (a, b):
        rate = max(2 ** (n / 2) / BUCKETS, 1e-9)
        p.append(-np.diff(np.exp(-rate * edges)) / -np.expm1(-rate))
    return float((p[0] * p[1]).sum() / 32)  # a cell here holds 32 of the 1024 mantissas


def estimate(r: np.ndarray, s: np.ndarray, n: int, m: int) -> np.ndarray:
    """Jaccard similarity by row, corrected for chance collisions. r, s: registers; n, m: sizes of the sets."""
    either = ((r > 0) | (s > 0)).sum(-1)
    same = ((r == s) & (r > 0)).sum(-1)
    c = _chance(int(2 * np.log2(max(n, 1))), int(2 * np.log2(max(m, 1))))
    return np.clip((same / np.maximum(either, 1) - c) / (1 - c), 0, 1)


def cut(threshold: float, either: np.ndarray | float) -> np.ndarray:
    """Below it an estimate from that many registers rules the threshold out."""
    return threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(either, 1))


def _signature(text: bytes) -> tuple[np.ndarray, int, int]:
    """The set of a text, and its digest in two whole numbers."""
    u = shingles(text)
    k1, k2 = np.frombuffer(hashlib.blake2b(u.tobytes(), digest_size=16).digest(), np.int64)
    return u, int(k1), int(k2)


def digest(text: Column) -> Column:
    """n, k1, k2 of a text: the size of its set, and the digest that equal sets share."""

    @F.pandas_udf("n long, k1 long, k2 long")
    def of(texts: pd.Series) -> pd.DataFrame:
        got = [_signature(t) for t in texts]
        return pd.DataFrame({"n": [len(u) for u, _, _ in got], "k1": [k for _, k, _ in got], "k2": [k for _, _, k in got]}, dtype="int64")

    return of(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _sign(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, n long, k1 long, k2 long, regs binary"

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for k, t in zip(b.column(0), b.column(1), strict=True):
                u, k1, k2 = _signature(t.as_py())
                rows.append((k.as_py(), len(u), k1, k2, registers(u).tobytes() if len(u) else None))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return docs.mapInArrow(run, schema)


def _bands(classes: DataFrame, threshold: float) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                r = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in part.column(1)])
                ids = np.repeat(part.column(0).to_numpy(), shape(threshold)[0])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(band_keys(r, threshold).ravel())], names=["rep", "band"])

    return classes.select("rep", "regs").mapInArrow(run, "rep long, band long")


def components(edges: DataFrame) -> DataFrame:
    """id, comp (the smallest id it is connected with) for every end of the edges a, b. A hub may have any number of edges."""
    e = table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not state[0] or tuple(state) == seen:
            break
        seen = tuple(state)
        with scratch(edges.sparkSession) as keep:
            # large star: every larger neighbour of u is tied to u's smallest neighbour
            both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            many = limit(state[0])
            least = table(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"), "c"), "least")
            big = skew_join(e, least.drop("c"), ["v"], hot=least.where(F.col("c") > many).select("v"), n=state[0]).select("u", F.col("m").alias("v")).distinct()
            # small star: every smaller neighbour of u, and u itself, is tied to the smallest of them
            big = table(big.where("u <> v"), "star")
            low = table(big.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")), "low")
            small = skew_join(big, low.drop("c"), ["u"], hot=low.where(F.col("c") > many).select("u"), n=state[0])
            pairs = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")
            e = keep(table(small.select(pairs).select("p.u", "p.v").where("u <> v").distinct(), "edges"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


class Finder:
    """docs: a table with columns of the names key and text. A class is a distinct set; rep numbers it."""

    def __init__(self, docs: DataFrame, threshold: float, key: str, text: str):
        self.docs = docs.select(F.col(key).cast("long").alias("doc_id"), text_bytes(text).alias("t"))
        self.threshold = threshold
        self.signed = table(_sign(self.docs), "signed")
        self.filled = self.signed.where("n > 0 and doc_id is not null")
        self.repeats = bool(self.filled.groupBy("doc_id").count().where("count > 1").limit(1).count())
        own = self.filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("regs").alias("regs"))
        self.classes = table(own.withColumn("rep", F.monotonically_increasing_id()), "classes")
        self.n = self.filled.count()
        self._groups: DataFrame | None = None

    def links(self) -> DataFrame:
        """Confirmed links a, b between classes, enough of them to connect every component."""
        bands = table(_bands(self.classes, self.threshold), "bands")
        ends = bands.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi")
        ends, many = table(ends, "ends"), limit(bands.count())
        met = table(skew_join(bands, ends, ["band"], hot=ends.where(F.col("c") > many).select("band")), "met")
        two = F.explode(F.array(F.col("lo"), F.col("hi"))).alias("o")
        pairs = met.select("rep", "c", two).where("rep <> o").groupBy(F.least("rep", "o").alias("a"), F.greatest("rep", "o").alias("b")).agg(F.count(F.lit(1)).alias("votes"), F.min("c").alias("c"))
        pairs = table(pairs, "pairs")
        ways = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "votes").union(pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "votes"))
        best = ways.groupBy("x").agg(F.max(F.struct("votes", (-F.col("y")).alias("y"))).alias("top"))
        first = best.select(F.least("x", -F.col("top.y")).alias("a"), F.greatest("x", -F.col("top.y")).alias("b")).distinct()
        first = table(first, "first")
        sure = self.confirmed(first)
        of = table(components(sure), "components")

        def with_component(df: DataFrame, column: str, name: str) -> DataFrame:
            # no class is here more often than it has bands
            j = df.join(of.select(F.col("id").alias("_id"), F.col("comp").alias("_comp")), F.col(column) == F.col("_id"), "left")
            return j.withColumn(name, F.coalesce("_comp", column)).drop("_id", "_comp")

        small = pairs.where("c < 4").select("a", "b").join(first, ["a", "b"], "left_anti")
        across = with_component(with_component(small, "a", "ca"), "b", "cb").where("ca <> cb").select("a", "b")
        members = with_component(met.where("c >= 4").select("band", "rep", "c"), "rep", "comp")
        members = table(members.join(self.classes.select("rep", "n"), "rep"), "members")
        mixed = members.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.sum(8 * F.col("n")).alias("bytes")).where("x < y")
        mixed = table(mixed.select("band", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("chunks")), "mixed")
        hot = members.where(F.col("c") > limit(members.count())).select("band").distinct()
        rest = self.blocks(table(skew_join(members, mixed, ["band"], hot=hot).select("band", "rep", "comp", "chunks"), "apart"))
        return sure.union(self.confirmed(table(across, "across"))).union(rest)

    def blocks(self, members: DataFrame) -> DataFrame:
        """Confirmed links a, b across the components of each bucket. members: band, rep, comp, chunks."""
        threshold = self.threshold
        sets = self.sets(members.select("rep").distinct())
        chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
        rows = members.join(sets, "rep").groupBy("band", "chunks", chunk.alias("chunk")).agg(F.collect_list(F.struct("rep", "comp", "u")).alias("ms"))
        held = table(rows, "blocks")
        # a block goes to each pair that it is in, so the pairs of one bucket are spread over all tasks
        left = held.select("band", F.col("chunk").alias("i"), F.explode(F.sequence(F.col("chunk"), F.col("chunks") - 1)).alias("j"), F.col("ms").alias("l"))
        right = held.select("band", F.explode(F.sequence(F.lit(0), F.col("chunk"))).alias("i"), F.col("chunk").alias("j"), F.col("ms").alias("r"))
        both = left.join(right, ["band", "i", "j"]).select("l", "r")

        def run(batches):
            import pyarrow as pa

            for b in batches:
                for l, r in zip(b.column(0), b.column(1), strict=True):
                    out = _linked(l.as_py(), r.as_py(), threshold)
                    yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in out], pa.int64()), pa.array([max(x) for x in out], pa.int64())], names=["a", "b"])

        return table(both.mapInArrow(run, "a long, b long").distinct(), "links")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs a, b (a table) those whose full sets are similar enough."""
        threshold = self.threshold
        regs = self.classes.select("rep", "n", "regs")
        side = lambda x, *columns: regs.select(F.col("rep").alias(x), *[F.col(c).alias(c[0] + x) for c in columns])
        half = skew_join(pairs, side("a", "n", "regs"), ["a"])
        sized = skew_join(table(half, "half"), side("b", "n", "regs"), ["b"])
        # sets whose sizes differ by more cannot be similar enough
        sized = sized.where(F.least("na", "nb") >= F.lit(threshold - 1e-9) * F.greatest("na", "nb"))

        def likely(batches):
            import pyarrow as pa

            for t in batches:
                keep = []
                for n, m, r, s in zip(*(t.column(c).to_pylist() for c in ("na", "nb", "ra", "rb")), strict=True):
                    r, s = np.frombuffer(r, np.uint16), np.frombuffer(s, np.uint16)
                    keep.append(bool(estimate(r, s, n, m) >= cut(threshold, ((r > 0) | (s > 0)).sum())))
                yield pa.RecordBatch.from_arrays([t.column("a").filter(pa.array(keep, pa.bool_())), t.column("b").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

        good = table(sized.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(likely, "a long, b long"), "likely")
        sets = self.sets(good.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
        half = table(skew_join(good, sets.select(F.col("rep").alias("a"), F.col("u").alias("ua")), ["a"]), "half")
        whole = skew_join(half, sets.select(F.col("rep").alias("b"), F.col("u").alias("ub")), ["b"])

        def check(batches):
            import pyarrow as pa

            for t in batches:
                keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold) for x, y in zip(t.column("ua"), t.column("ub"), strict=True)]
                k = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([t.column("a").filter(k), t.column("b").filter(k)], names=["a", "b"])

        return table(whole.select("a", "b", "ua", "ub").mapInArrow(check, "a long, b long").distinct(), "links")

    def sets(self, reps: DataFrame) -> DataFrame:
        """rep, u: the full sets (64-bit hashes, ascending) of these classes, one row each."""

        def run(batches):
            import pyarrow as pa

            for b in batches:
                reps, sets = [], []
                for rep, k1, k2, t in zip(*(b.column(c) for c in ("rep", "k1", "k2", "t")), strict=True):
                    u, a, c = _signature(t.as_py())
                    if (a, c) == (k1.as_py(), k2.as_py()):  # another text may have the same id
                        reps.append(rep.as_py())
                        sets.append(u.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sets, pa.binary())], names=["rep", "u"])

        wanted = table(self.classes.join(reps, "rep", "left_semi").select("rep", "k1", "k2", F.col("doc").alias("doc_id")), "wanted")
        met = self.docs.join(bounded_broadcast(wanted, wanted.count(), MOST_BROADCAST), "doc_id")
        got = met.mapInArrow(run, "rep long, u binary")
        return table(got.groupBy("rep").agg(F.first("u").alias("u")) if self.repeats else got, "sets")

    def groups(self) -> DataFrame:
        """k1, k2, component_id: for every class the smallest id of a document that it is connected with."""
        if self._groups is None:
            with scratch(self.docs.sparkSession) as keep:
                of = components(self.links()).select(F.col("id").alias("rep"), "comp")
                named = table(self.classes.select("k1", "k2", "rep", "doc").join(of, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "named")
                least = table(named.groupBy("comp").agg(F.min("doc").alias("component_id")), "least")
                self._groups = keep(table(skew_join(named, least, ["comp"]).select("k1", "k2", "component_id"), "groups"))
        return self._groups

    def rows(self) -> DataFrame:
        """doc_id, n_shingles, k1, k2, component_id, kept for every row of docs."""
        groups, rest = self.groups(), self.signed.where("n = 0 or doc_id is null")
        hot = self.classes.where(F.col("copies") > limit(self.n)).select("k1", "k2")
        found = skew_join(self.filled.select("doc_id", "n", "k1", "k2"), groups, ["k1", "k2"], hot=hot)
        rest = rest.select("doc_id", "n", "k1", "k2", F.col("doc_id").alias("component_id"))
        out = found.select(*rest.columns).unionByName(rest).withColumnRenamed("n", "n_shingles")
        return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    if min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= threshold * (len(x) + len(y) - both) - 1e-9


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set on the left shares with each on the right: products of 0/1 matrices, column by column."""
    flat = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    common = np.intersect1d(np.unique(flat[0][0]), np.unique(flat[1][0]))
    out = np.zeros((len(left), len(right)), np.float32)
    width = max(256, CELLS // max(len(left), len(right)))
    placed = []
    for values, row in flat:
        at = np.searchsorted(common, values)
        hit = common[np.minimum(at, len(common) - 1)] == values if len(common) else np.zeros(len(values), bool)
        order = np.argsort(at[hit], kind="stable")
        placed.append((at[hit][order], row[hit][order]))
    for lo in range(0, len(common), width):
        m = []
        for (at, row), s in zip(placed, (left, right), strict=True):
            i, j = np.searchsorted(at, (lo, lo + width))
            x = np.zeros((len(s), min(width, len(common) - lo)), np.float32)
            x[row[i:j], at[i:j] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


def _linked(left: list[dict], right: list[dict], threshold: float) -> list[tuple[int, int]]:
    """Links between members of two blocks of a bucket, at most one for each two components joined here."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (p := parent.get(c, c)) != c:
            parent[c] = parent.get(p, p)
            c = p
        return c

    ls, rs = ([np.frombuffer(m["u"], np.uint64) for m in ms] for ms in (left, right))
    lc, rc = (np.asarray([m["comp"] for m in ms]) for ms in (left, right))
    if lc.min() == lc.max() == rc.min() == rc.max():
        return []
    both = _overlaps(ls, rs).astype(np.float64)
    every = np.asarray([len(s) for s in ls])[:, None] + np.asarray([len(s) for s in rs])[None, :] - both
    near = (both >= threshold * every - 1e-9) & (lc[:, None] != rc[None, :])
    out = []
    for i, j in np.argwhere(near).tolist():
        a, b = root(int(lc[i])), root(int(rc[j]))
        if a != b:
            parent[a] = b
            out.append((left[i]["rep"], right[j]["rep"]))
    return out


def find(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    return Finder(docs, threshold, key, text).rows().drop("k1", "k2")
