"""Packing documents into windows of a fixed number of tokens by the sum-of-squares rule.

Each task packs the documents of its own scan, in one pass and without a shuffle. A level array
counts the partly filled windows of each fill. A document's full windows are cut off first; the
rest of s tokens goes to the level h that keeps the sum of the squared counts smallest: moving a
window from h to h + s changes it by 2 (N[h+s] - N[h]) + 2, a new window by 2 N[s] + 1, and closing
one by 1 - 2 N[h]. At the end of a task, and when it holds more than `most_open` windows, what is
still open is poured together, cut where a window is full; the last window is cut into lengths that
are powers of two, which need no padding.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import map_batches, text_or_empty
from bidlake.llm.tokens import WordEncoder

SIZE, END = 2048, 1
#: (doc_id, start, ids, tokens of the document)
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Sum-of-squares packing of one stream; gives closed windows as lists of pieces."""

    def __init__(self, size: int = SIZE, most_open: int = 2048):
        self.size, self.most_open = size, most_open
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.open = 0

    def level(self, s: int) -> int:
        """The fill (0: a new window) to which a rest of s tokens goes; the fuller of equals."""
        n, top = self.levels, self.size - s
        change = np.full(top + 1, np.iinfo(np.int64).max)
        held = np.flatnonzero(n[: top + 1])
        change[held] = 2 * (n[held + s] - n[held]) + 2
        if n[top] and top:
            change[top] = 1 - 2 * n[top]
        change[0] = 2 * n[s] + 1
        return top - int(np.argmin(change[::-1]))

    def add(self, doc: int | None, ids: bytes) -> Iterator[list[Piece]]:
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            yield [(doc, at, ids[4 * at : 4 * (at + self.size)], total)]
            at += self.size
        if (s := total - at) == 0:
            return
        h = self.level(s)
        window = self.windows[h].pop() if h else []
        self.levels[h] -= bool(h)
        self.open += not h
        window.append((doc, at, ids[4 * at :], total))
        if h + s == self.size:
            self.open -= 1
            yield window
        else:
            self.levels[h + s] += 1
            self.windows[h + s].append(window)
            if self.open > self.most_open:
                yield from self.pour(last=False)

    def pour(self, last: bool = True) -> Iterator[list[Piece]]:
        """Pour the open windows together, fullest first: a cut at most where a window is full."""
        stream = [p for level in reversed(self.windows) for w in level for p in w]
        self.windows = [[] for _ in range(self.size + 1)]
        self.levels[:], self.open = 0, 0
        window, room = [], self.size
        left = sum(len(p[2]) // 4 for p in stream)
        for doc, start, ids, total in stream:
            while ids:
                if last and not window and left < self.size:
                    room = 1 << (left.bit_length() - 1)
                part, ids = ids[: 4 * room], ids[4 * room :]
                n = len(part) // 4
                window.append((doc, start, part, total))
                start, room, left = start + n, room - n, left - n
                if not room:
                    yield window
                    window, room = [], self.size
        if window:
            fill = self.size - room
            self.windows[fill].append(window)
            self.levels[fill], self.open = 1, 1


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _pack(path: str, size: int, most_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, end = WordEncoder.at(path), Packer(size, most_open), np.uint32(END).tobytes()
        number = TaskContext.get().partitionId() << 40

        def rows(windows: Iterator[list[Piece]]) -> Iterator[tuple]:
            nonlocal number
            for window in windows:
                offset = 0
                for doc, start, ids, total in window:
                    yield doc, start, len(ids) // 4, zlib.crc32(ids), total, number, offset
                    offset += len(ids) // 4
                number += 1

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

        for batch in batches:
            texts = encoder.encode(batch.column("text").cast(pa.binary()).to_pylist())
            out = [r for doc, ids in zip(batch.column("doc_id").to_pylist(), texts) for r in rows(packer.add(doc, ids + end))]
            if out:
                yield as_batch(out)
        if out := list(rows(packer.pour())):
            yield as_batch(out)

    return run


def pack(docs: DataFrame, path: str, size: int = SIZE, most_open: int = 2048) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of docs(doc_id, text).

    Every token id of every row, with the end id 1 after each text, lies in exactly one piece. A null or
    empty text is its end id alone. Repeated rows are packed each; a null doc_id stays null; other
    columns are not read; an empty table gives no rows. Sequences have `size` tokens, but for the last
    few of each task, whose lengths are powers of two.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(docs, _pack(path, size, most_open), SCHEMA, keeps=True)
