"""Token ids in files that readers can open at any document.

A file holds the ids of consecutive documents, in ascending doc_id order over
all files:

    frame frame ... index end

A frame is an independent zstandard frame over little-endian unsigned 32-bit
ids: some whole documents, or a part of one that is longer than a frame.  The
index is a zstandard skippable frame, so any zstandard tool decompresses a file
as a whole.  It holds, in this order,

    documents   doc_id (int64) of each, then the number of ids (int64) of each,
                as one zstandard frame
    seek table  per frame its bytes, its ids and its checksum (uint32 each);
                the checksum is the low half of the 64-bit xxHash of the ids
    footer      see FOOTER; documents without an id come first and are counted

and the end is an empty skippable frame.  Its eight bytes are plain ASCII: they
are the line separator with which Spark's text writer closes a record, and each
record is one file, so the files are committed by Spark's own protocol and a
lost executor leaves none of its half-written ones behind.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chaffsieve.llm.tables import meet, small_batches, whole_text
from chaffsieve.llm.text64 import utf8
from chaffsieve.llm.tokens import word_ids, word_vocabulary_path
from chaffsieve.sources.staging import scratch_root, stage

END_ID = 1
FRAME_IDS = 1 << 16  # 256 KB before compression
FILE_BYTES = 32 << 20  # a file is closed when it reaches this size
LEVEL = 3

SKIPPABLE = 0x184D2A5E
END_MARK = struct.pack("<II", 0x184D2A50, 0)  # an empty skippable frame: "P*M\x18\0\0\0\0"
MAGIC = b"idx1"


class Footer(NamedTuple):
    """Where a file stands (its task, its number there), and what its index holds."""

    part: int
    number: int
    documents: int
    without_id: int
    frames: int
    document_bytes: int
    magic: bytes


FOOTER = struct.Struct("<qqqqqq4s")
_SEEK = np.dtype([("bytes", "<u4"), ("ids", "<u4"), ("checksum", "<u4")])


def _checksum(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FileWriter:
    """Collects documents into frames, and frames into the image of one file."""

    def __init__(self, frame_ids: int = FRAME_IDS):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.frame_ids = frame_ids
        self.reset()

    def reset(self) -> None:
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.held_ids = self.size = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held_ids + len(ids) > self.frame_ids:
            self._close_frame()
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        for at in range(0, len(ids), self.frame_ids):
            part = ids[at : at + self.frame_ids]
            self.held.append(part)
            self.held_ids += len(part)
            if self.held_ids >= self.frame_ids:
                self._close_frame()

    def _close_frame(self) -> None:
        raw = b"".join(np.ascontiguousarray(h, "<u4").tobytes() for h in self.held)
        frame = self.compress(raw)
        self.frames.append(frame)
        self.table.append((len(frame), len(raw) // 4, _checksum(raw)))
        self.size += len(frame)
        self.held, self.held_ids = [], 0

    def image(self, part: int, number: int) -> bytes:
        """The bytes of the file but for its end mark; the writer starts anew."""
        if self.held:
            self._close_frame()
        without = sum(d is None for d in self.doc_ids)
        known = np.array([d or 0 for d in self.doc_ids], "<i8")
        documents = self.compress(known.tobytes() + np.array(self.lengths, "<i8").tobytes())
        footer = Footer(part, number, len(known), without, len(self.table), len(documents), MAGIC)
        index = documents + np.array(self.table, _SEEK).tobytes() + FOOTER.pack(*footer)
        out = b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(index)), index])
        self.reset()
        return out


class TokenFile:
    """Random access to one file: reads its index, then only the frames that are asked for."""

    def __init__(self, source: bytes | BinaryIO):
        import zstandard

        self.decompress = zstandard.ZstdDecompressor().decompress
        self.source = io.BytesIO(source) if isinstance(source, bytes) else source
        size = self.source.seek(0, io.SEEK_END)
        tail = len(END_MARK) + FOOTER.size
        self.source.seek(max(0, size - tail))
        raw = self.source.read(tail)
        if len(raw) < tail or raw[-len(END_MARK) :] != END_MARK:
            raise ValueError("not a token file, or one cut short")
        self.footer = Footer(*FOOTER.unpack(raw[: FOOTER.size]))
        if self.footer.magic != MAGIC:
            raise ValueError("not a token file")
        seek_bytes = self.footer.frames * _SEEK.itemsize
        self.source.seek(size - tail - seek_bytes - self.footer.document_bytes)
        documents = self.decompress(self.source.read(self.footer.document_bytes))
        self.seek_table = np.frombuffer(self.source.read(seek_bytes), _SEEK)
        self.doc_ids, self.lengths = np.frombuffer(documents, "<i8").reshape(2, -1)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._frame_ends = np.cumsum(self.seek_table["ids"], dtype=np.int64)
        self._frame_at = np.cumsum(self.seek_table["bytes"], dtype=np.int64) - self.seek_table["bytes"]
        self.opened: list[int] = []  # frames decompressed, in order
        self._last: tuple[int, np.ndarray] | None = None

    def doc_id(self, i: int) -> int | None:
        """The id of the i-th document of the file; those without one come first."""
        return None if i < self.footer.without_id else int(self.doc_ids[i])

    def places(self, wanted: Iterable[int]) -> np.ndarray:
        """Where in the file documents with one of the ids ``wanted`` are."""
        known = np.arange(self.footer.documents) >= self.footer.without_id
        return np.flatnonzero(np.isin(self.doc_ids, np.fromiter(wanted, np.int64)) & known)

    def _frame(self, k: int) -> np.ndarray:
        if self._last and self._last[0] == k:
            return self._last[1]
        length, ids, checksum = (int(x) for x in self.seek_table[k])
        self.source.seek(int(self._frame_at[k]))
        raw = self.decompress(self.source.read(length), max_output_size=4 * ids)
        if len(raw) != 4 * ids or _checksum(raw) != checksum:
            raise ValueError(f"frame {k} does not match its checksum")
        self.opened.append(k)
        self._last = (k, np.frombuffer(raw, "<u4"))
        return self._last[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document."""
        first, end = int(self.starts[i]), int(self.starts[i] + self.lengths[i])
        parts = []
        k = int(np.searchsorted(self._frame_ends, first, "right"))
        while first < end:
            begin = int(self._frame_ends[k]) - int(self.seek_table["ids"][k])
            stop = min(end, int(self._frame_ends[k]))
            parts.append(self._frame(k)[first - begin : stop - begin])
            first, k = stop, k + 1
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, "<u4"), *parts])


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    frame_ids: int = FRAME_IDS,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write the ids of every whole text of ``docs`` (doc_id, text), each followed by ``end_id``.

    The texts are range-sorted by doc_id once and encoded where they arrive.
    A NULL or empty text is ``end_id`` alone.  Rows without a doc_id come
    first; rows that share one are ordered by a hash of the text, and equal
    rows spread over tasks however many they are.  An empty table makes a
    folder without token files.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    path_of = vocabulary or word_vocabulary_path()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    # The last key only spreads rows that are equal in all others.
    keys = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc(), F.col("spread").asc()]
    ordered = (
        texts.withColumns({"digest": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = word_ids(path_of), FileWriter(frame_ids)
        end = np.array([end_id], "<u4")
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            found = encoder.documents(data, offsets)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found):
                writer.add(doc, np.concatenate((ids, end)))
                if writer.size >= file_bytes:
                    yield _image(writer.image(part, number))
                    number += 1
        if writer.doc_ids:
            yield _image(writer.image(part, number))

    # A record is a file: text records are written byte for byte, the separator ends them.
    ordered.mapInArrow(run, "image binary").select(F.col("image").cast("string")).write.option(
        "maxRecordsPerFile", 1
    ).option("lineSep", END_MARK.decode("ascii")).text(path)


def _image(image: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"image": pa.array([image], pa.binary())})


def read_tokens(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """(part, number, doc_id, file_start, n_tokens, ids) per document of the files under ``path``.

    ``part`` and ``number`` order the files, ``file_start`` counts the ids
    before a document in its file, and ``ids`` are its bytes.  With ``wanted``
    only documents with one of these ids come back, and only the frames that
    hold them are decompressed.  A frame that does not match its checksum is
    an error.
    """
    small_batches(spark)
    asked = None if wanted is None else [int(w) for w in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_py()
                if not raw:
                    continue  # Spark's empty file for an empty table
                file = TokenFile(raw)
                places = range(file.footer.documents) if asked is None else file.places(asked).tolist()
                rows, size = [], 0
                for i in places:
                    ids = file.ids(i).tobytes()
                    rows.append((*file.footer[:2], file.doc_id(i), int(file.starts[i]), len(ids) // 4, ids))
                    size += len(ids)
                    if size > 1 << 23:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    )
    return (
        files.load(path)
        .select("content")
        .mapInArrow(run, "part bigint, number bigint, doc_id bigint, file_start bigint, n_tokens bigint, ids binary")
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["part", "number", "doc_id", "file_start", "n_tokens", "ids"]
    kinds = [*[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` of all documents (part, number, file_start, n_tokens, ...) with ``start``, the ids
    of all documents before each.

    The window sees one row per file.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("file_ids"))
    offsets = files.select("part", "number", F.coalesce(F.sum("file_ids").over(before), F.lit(0)).alias("file_offset"))
    placed = meet(rows, stage(offsets, "token-file-offsets"), ["part", "number"])
    return placed.withColumn("start", F.col("file_offset") + F.col("file_start")).drop("file_offset")


def written_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from files written under ``path``."""
    spark = docs.sparkSession
    folder = path or f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(docs, folder)
    rows = read_tokens(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(stage(rows, "token-rows")).select("doc_id", "start", "n_tokens", "ids_crc32")
