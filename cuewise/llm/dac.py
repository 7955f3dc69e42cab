"""Token ids as directly addressable codes, in files that give any token without decoding a block.

An id is split into chunks of `width` bits. Level 0 holds the lowest chunk of every id; a bitmap says which ids go
on, and the next level holds the next chunk of those alone, in order. A rank directory keeps the number of set
bits before every 512th, so token i is found with one rank per level.

A file is a Parquet file of blocks in ascending document order; a block is one row: its partition and number, the
tokens of its partition before it and its own, the documents' keys and end positions (little-endian 64-bit), and the payload:
b"DAC1", then little-endian unsigned 32-bit width, levels, and per level the number of chunks, the chunks (one byte
each), the bitmap (least significant bit first) and the directory.

Defined results: a null or empty text is its end id alone; rows with one doc_id follow each other in the order of
their text's hash; null doc_ids come first; an empty table gives no blocks; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, shared_folder, text_bytes
from .tokens import END_ID, word_ids

MAGIC, WIDTH, STEP = b"DAC1", 8, 512
BLOCK_TOKENS = 1 << 19
BLOCKS = "part int, block int, before long, n long, doc_ids binary, ends binary, payload binary"
DOCS = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long, first_id long, last_id long"
#: Files up to this many send their starts (16 bytes each) by broadcast; beyond it they are joined by shuffle.
MOST_BROADCAST = 1_000_000
_NULL = np.iinfo(np.int64).min
_END = np.asarray([END_ID], dtype="<u4").tobytes()


def encode(ids: np.ndarray) -> bytes:
    out, levels, rest = [], 0, np.asarray(ids, dtype=np.uint32)
    while True:
        more = rest >> WIDTH
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little").tobytes()
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(rest), STEP), dtype=np.int64))]) if len(rest) else np.zeros(1)
        out += [struct.pack("<I", len(rest)), (rest & ((1 << WIDTH) - 1)).astype(np.uint8).tobytes(), bits, ranks.astype("<u4").tobytes()]
        levels, rest = levels + 1, more[goes_on]
        if not len(rest):
            return MAGIC + struct.pack("<II", WIDTH, levels) + b"".join(out)


class Codes:
    """A payload, opened without copying it."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a payload of directly addressable codes")
        self.width, n = struct.unpack_from("<II", payload, 4)
        at, self.levels = 12, []
        for _ in range(n):
            (m,) = struct.unpack_from("<I", payload, at)
            chunks = np.frombuffer(payload, np.uint8, m, at + 4)
            bits = np.frombuffer(payload, np.uint8, -(-m // 8), at + 4 + m)
            ranks = np.frombuffer(payload, "<u4", -(-m // STEP) + 1, at + 4 + m + len(bits))
            at += 4 + m + len(bits) + 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """Token i, from one chunk and one rank a level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // STEP * STEP
            i = int(ranks[i // STEP]) + int(np.unpackbits(bits[first >> 3 : (i >> 3) + 1], bitorder="little")[: i - first].sum())
            shift += self.width
        return value

    def all(self) -> np.ndarray:
        out, at = np.zeros(len(self), dtype="<u4"), None
        for k, (chunks, bits, _) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << (k * self.width)
            if at is None:
                out[:] = part
                at = np.arange(len(out))
            else:
                out[at] |= part
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write(docs: DataFrame, tokenizer: str, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Encodes all texts and writes the block files, in ascending order of the key."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, words, block, before = TaskContext.get().partitionId(), word_ids(tokenizer), 0, 0
        keys, ends, ids, n = [], [], [], 0

        def row():
            payload = encode(np.frombuffer(b"".join(ids), "<u4"))
            cells = [[part], [block], [before], [n], [np.asarray(keys, "<i8").tobytes()], [np.asarray(ends, "<i8").tobytes()], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=[f.split()[0] for f in BLOCKS.split(", ")])

        for b in batches:
            for k, t in zip(b.column(0), b.column(1), strict=True):
                own = words.text(t.as_py()) + _END
                k = k.as_py()
                keys.append(_NULL if k is None else k)
                ids.append(own)
                n += len(own) // 4
                ends.append(n)
                if n >= BLOCK_TOKENS:
                    yield row()
                    block, before = block + 1, before + n
                    keys, ends, ids, n = [], [], [], 0
        if keys:
            yield row()

    rows = docs.select(docs[key].cast("long").alias("doc_id"), text_bytes(text).alias("t"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("t").asc()]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read(spark, path: str) -> DataFrame:
    """A row for each document of the files: doc_id, start, n_tokens, ids_crc32 of all its ids, and its first and last id,
    which are read on their own by rank, without decoding what lies before them."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                keys, ends, codes = np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["ends"], "<i8"), Codes(r["payload"])
                ids = codes.all()
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
                null = keys == _NULL
                firsts, lasts = [codes[s] for s in starts.tolist()], [codes[e - 1] for e in ends.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(keys), pa.int32()), pa.array(keys, pa.int64(), mask=null), pa.array(starts + r["before"]), pa.array(ends - starts), *(pa.array(x, pa.int64()) for x in (crc, firsts, lasts))],
                    names=[f.split()[0] for f in DOCS.split(", ")],
                )

    # the tokens of each file, from a column of whole numbers alone: a row for each partition comes to the driver
    sums, before, base = blocks.groupBy("part").agg(F.sum("n").alias("n")).collect(), 0, {}
    for r in sorted(sums):
        base[r["part"]], before = before, before + r["n"]
    each = blocks.mapInArrow(run, DOCS)
    starts = spark.createDataFrame(sorted(base.items()), "p int, base long")
    met = each.join(bounded_broadcast(starts, len(base), MOST_BROADCAST), F.col("part") == F.col("p"))
    return met.select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "first_id", "last_id")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files to the shared folder and reads every document back from them."""
    import uuid

    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/dac-{uuid.uuid4().hex[:12]}"
    write(docs, tokenizer, path)
    return read(spark, path)
