"""Packing documents into sequences by the online sum-of-squares rule.

A document's full windows become sequences of their own.  What remains is
placed in a partly filled window, or a new one, such that the sum over all
fill levels of the squared number of windows at that level stays smallest.
The state is an array with the number of windows at each level, so a placement
costs one pass over the levels whatever the number of documents.  Every task
packs its own partition: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import small_batches, whole_text
from chaffsieve.llm.text64 import utf8
from chaffsieve.llm.tokens import byte_ids, vocabulary_paths

WINDOW = 2048
END_ID = 1
# Partly filled windows a task holds before it closes them all: 8 MB of ids.
MAX_OPEN = 1024

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

# A piece: (doc_id, start in the document, ids, tokens of the document).
Piece = tuple


class Levels:
    """Partly filled windows by fill level."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(window)]

    def best(self, size: int) -> int:
        """The level to add ``size`` to: least growth of the sum of squares, then the fullest.

        Moving a window from level h to h + size changes the sum by
        2 * (count[h + size] - count[h]) + 2, filling it by 1 - 2 * count[h],
        and opening one by 2 * count[size] + 1.
        """
        count, last = self.count, self.window - size
        growth = 2 * (count[size : last + size + 1] - count[: last + 1]) + 2
        growth[last] = 1 - 2 * count[last]
        growth[0] = 2 * count[size] + 1
        usable = count[: last + 1] > 0
        usable[0] = True
        growth[~usable] = np.iinfo(np.int64).max
        return last - int(np.argmin(growth[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Add a piece; the window if that fills it."""
        size = len(piece[2])
        level = self.best(size)
        window = self.at[level].pop() if level else []
        self.count[level] -= 1 if level else 0
        window.append(piece)
        if level + size == self.window:
            return window
        self.at[level + size].append(window)
        self.count[level + size] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Empty all levels: the fullest windows are filled up with pieces of the emptiest.

        One window is left in the end; it is cut where a power of two ends,
        so that no sequence needs padding.
        """
        left = [w for level in self.at[::-1] for w in level]
        self.count[:] = 0
        self.at = [[] for _ in range(self.window)]
        fill = [sum(len(p[2]) for p in w) for w in left]
        i, j = 0, len(left) - 1
        while i < j:
            gap = self.window - fill[i]
            if not gap:
                yield left[i]
                i += 1
                continue
            piece = left[j].pop()
            head, tail = _cut(piece, gap)
            left[i].append(head)
            fill[i] += len(head[2])
            fill[j] -= len(head[2])
            if tail:
                left[j].append(tail)
            if not left[j]:
                j -= 1
        if i == j:
            rest = left[i]
            size = 1 << (fill[i].bit_length() - 1)
            while rest:
                part, need = [], size
                while need and rest:
                    head, tail = _cut(rest.pop(0), need)
                    part.append(head)
                    need -= len(head[2])
                    if tail:
                        rest.insert(0, tail)
                yield part
                remaining = sum(len(p[2]) for p in rest)
                size = 1 << (remaining.bit_length() - 1) if remaining else 0


def _cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    doc, start, ids, total = piece
    if len(ids) <= size:
        return piece, None
    return (doc, start, ids[:size], total), (doc, start + size, ids[size:], total)


def sequences(
    documents: Iterator[tuple[int, np.ndarray]], window: int = WINDOW, max_open: int = MAX_OPEN
) -> Iterator[list[Piece]]:
    """Pack (doc_id, ids) online; each sequence is a list of pieces."""
    levels, opened = Levels(window), 0
    for doc, ids in documents:
        total, full = len(ids), len(ids) - len(ids) % window
        for at in range(0, full, window):
            yield [(doc, at, ids[at : at + window], total)]
        if full == total:
            continue
        # A copy: the rest of a batch need not stay in memory for it.
        done = levels.place((doc, full, ids[full:].copy(), total))
        if done:
            yield done
        opened = int(levels.count.sum())
        if opened > max_open:
            yield from levels.close()
    yield from levels.close()


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's token ids, little-endian unsigned 32-bit.  A
    document is its ids and ``end_id``; a NULL or empty text is ``end_id``
    alone.  Each id lies in exactly one piece, and the pieces of a sequence
    are gapless from offset 0.  Sequences hold ``window`` ids, or a power of
    two fewer.  Rows repeated under one doc_id, or without one, are packed
    each for itself.  sequence_id is unique, not dense, and the same for the
    same partitions; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    paths = vocabulary or vocabulary_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_ids(*paths)
        end = np.array([end_id], "<u4")

        def documents():
            for batch in batches:
                data, offsets = utf8(batch.column("text"))
                found = encoder.documents(data, offsets)
                for doc, ids in zip(batch.column("doc_id").to_pylist(), found):
                    yield doc, np.concatenate((ids, end))

        # Partitions are numbered the same way when a task is run again.
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        for sequence in sequences(documents(), window):
            offset = 0
            for doc, start, ids, total in sequence:
                rows.append((doc, start, len(ids), ids.tobytes(), total, number, offset))
                offset += len(ids)
            number += 1
            if len(rows) >= 1024:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(
        run, SCHEMA
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)
