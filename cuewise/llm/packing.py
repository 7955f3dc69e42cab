"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

A document's full windows are cut off first; what is left of it goes whole into the fill level that minimises the
sum, over levels, of the squared number of partially filled windows (a new window counts as level 0). Only the
number of windows per level steers the choice, so the state is one array of `size` counters. Each partition packs
its own rows, so nothing is shuffled.

At most `most_open` windows are open at a time, which bounds the memory and keeps windows closing all along: when the
rule wants one more, the fullest window is closed by the head of the piece at hand, and the rest of that piece is placed by
the rule. At the end of a partition the few windows still open are joined: their pieces run on from one window into
the next, cut where one is full, and the last stretch is cut into powers of two, which need no padding. Thus nothing is
padded at all; the price is at most one cut for each window.

Defined results: a null or empty text is its end id alone; repeated rows are packed one by one; of levels that are
equally good the fullest is taken; an empty table gives no pieces; very long texts give as many full windows as they
hold; other columns are not read. A lost task is packed again from the same rows with the same result.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame

from .common import text_bytes
from .tokens import END_ID, word_ids

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Windows that a task holds open (8 KB each).
MOST_OPEN = 64
_END = np.asarray([END_ID], dtype="<u4").tobytes()


class LevelArray:
    """The sum-of-squares rule. counts[h]: windows filled up to h tokens, 0 < h < size."""

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)

    def place(self, length: int, new: bool = True) -> int | None:
        """The level to put a piece of this length on (0: a new window), and the counters after it. Without new ones: None if
        no open window has room."""
        n, size = self.counts, self.size
        top = size - length
        # the change of the sum of squares: level h loses a window, level h + length gains one; full ones do not count
        change = 2 * (n[length : size + 1] - n[: top + 1]) + 2
        change[top] = 1 - 2 * n[top]
        change[0] = 2 * n[length] + 1
        open_levels = n[: top + 1] > 0
        open_levels[0] = new
        if not open_levels.any():
            return None
        change[~open_levels] = np.iinfo(np.int64).max
        h = top - int(np.argmin(change[::-1]))  # of equals the fullest
        if h:
            n[h] -= 1
        if h + length < size:
            n[h + length] += 1
        return h


def pack_stream(docs, size: int, most_open: int = MOST_OPEN):
    """docs: (key, ids as bytes). Yields lists of (key, start, ids, doc_tokens, offset), one for each sequence."""
    levels = LevelArray(size)
    waiting: dict[int, list[list]] = {}
    n_open = 0

    def put(h: int, piece: tuple):
        """The window of level h with the piece, if that fills it."""
        nonlocal n_open
        own = waiting.get(h)
        window = own.pop() if h else []
        if own == []:
            del waiting[h]
        n_open += not h
        window.append((*piece, h))
        filled = h + len(piece[2]) // 4
        if filled == size:
            n_open -= 1
            return window
        waiting.setdefault(filled, []).append(window)
        return None

    for key, ids in docs:
        n = len(ids) // 4
        start = n - n % size
        for at in range(0, start, size):
            yield [(key, at, ids[4 * at : 4 * (at + size)], n, 0)]
        while start < n:
            h = levels.place(n - start, n_open < most_open)
            end = n
            if h is None:  # no room: the head closes the fullest window
                h = max(waiting)
                levels.counts[h] -= 1
                end = start + size - h
            if done := put(h, (key, start, ids[4 * start : 4 * end], n)):
                yield done
            start = end
    yield from _joined((piece for h in sorted(waiting, reverse=True) for window in waiting[h] for piece in window), size)


def _joined(pieces, size: int):
    """The pieces one after another, cut into full windows; the last stretch into powers of two, largest first."""
    run, filled = [], 0
    for key, start, ids, n, _ in pieces:
        while ids:
            take = min(len(ids) // 4, size - filled)
            run.append((key, start, ids[: 4 * take], n, filled))
            ids, start, filled = ids[4 * take :], start + take, filled + take
            if filled == size:
                yield run
                run, filled = [], 0
    while filled:
        part = 1 << (filled.bit_length() - 1)
        head, rest, at = [], [], 0
        for key, start, ids, n, _ in run:
            take = min(len(ids) // 4, max(0, part - at))
            if take:
                head.append((key, start, ids[: 4 * take], n, at))
            if 4 * take < len(ids):
                rest.append((key, start + take, ids[4 * take :], n, max(0, at + take - part)))
            at += len(ids) // 4
        yield head
        run, filled = rest, filled - part
        at = 0
        for i, p in enumerate(run):
            run[i] = (*p[:4], at)
            at += len(p[2]) // 4


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece; sequence_id is unique, offset runs gapless from 0 in each sequence."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base, words, most = TaskContext.get().partitionId() << 40, word_ids(tokenizer), 20_000
        schema = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])

        def read():
            for b in batches:
                for k, t in zip(b.column(0), b.column(1), strict=True):
                    yield k.as_py(), words.text(t.as_py()) + _END

        out: list[tuple] = []
        for i, sequence in enumerate(pack_stream(read(), size)):
            out += [(k, start, len(ids) // 4, zlib.crc32(ids), n, base + i, offset) for k, start, ids, n, offset in sequence]
            if len(out) >= most:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    return docs.select(docs[key].cast("long").alias("doc_id"), text_bytes(text).alias("t")).mapInArrow(run, SCHEMA)
