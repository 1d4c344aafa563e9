"""Token files: an exact round trip, and readers that open few frames."""

import glob
import io
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from chaffsieve.llm.token_files import END_MARK, FileWriter, TokenFile, read_tokens, with_starts, write_tokens, written_and_read
from chaffsieve.llm.tokens import WordIds, word_vocabulary_path


def encode(texts):
    made = Tokenizer.from_file(word_vocabulary_path())
    return [[*made.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_segments_give_the_ids_of_whole_texts():
    import random

    import pyarrow as pa

    from chaffsieve.llm.text64 import utf8

    rng = random.Random(3)
    parts = [
        *"aé É  \n\t.,!?1", "'s", "Don't", "word", "<|endoftext|>", "<|startoftext|>", "«", "日本", "é", "́", "İ",
        " ", " ", "…", "😀", "ß", "×", "\x00", "x'LL",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["", None]
    found = WordIds(word_vocabulary_path()).documents(*utf8(pa.array(texts)))
    assert [[*ids.tolist(), 1] for ids in found] == encode(texts)


def test_files_give_back_every_document(spark, documents, tmp_path):
    texts = [f"Document {i}: " + "some words, and more. " * (i % 50) for i in range(400)]
    df = documents([(1000 - i, t) for i, t in enumerate(texts)], partitions=7)
    path = str(tmp_path / "tokens")
    write_tokens(df, path, frame_ids=300, file_bytes=2000)
    rows = with_starts(read_tokens(spark, path)).collect()
    want = {1000 - i: ids for i, ids in enumerate(encode(texts))}
    start = 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == want[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(ids)
        start += len(ids)
    assert len(rows) == 400 and len(glob.glob(f"{path}/part-*")) > 8
    # Some documents only.
    some = read_tokens(spark, path, wanted=[700, 999, -5]).collect()
    assert sorted(r["doc_id"] for r in some) == [700, 999]
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]] for r in some)


def image(documents, frame_ids=100):
    writer = FileWriter(frame_ids)
    for doc, ids in documents:
        writer.add(doc, np.array(ids, "<u4"))
    return writer.image(3, 4) + END_MARK


def test_a_reader_opens_only_the_frames_it_needs():
    documents = [(None, [7] * 30)] + [(i, list(range(i))) for i in range(60)] + [(99, list(range(1000)))]
    raw = image(documents)
    source = io.BytesIO(raw)
    reads = []
    plain = source.read
    source.read = lambda n=-1: reads.append(n) or plain(n)
    file = TokenFile(source)
    assert file.footer[:4] == (3, 4, 62, 1) and file.doc_id(0) is None and file.doc_id(1) == 0
    reads.clear()
    assert file.ids(int(file.places([20])[0])).tolist() == list(range(20))
    assert len(file.opened) == 1 and sum(reads) < len(raw) // 4
    assert file.ids(61).tolist() == list(range(1000)) and len(file.opened) == 11
    assert [file.ids(i).tolist() for i in range(62)] == [ids for _, ids in documents]
    assert file.places([0, 5]).tolist() == [1, 6]  # not the one without an id


def test_any_zstandard_reader_sees_the_ids():
    import zstandard

    raw = image([(i, [i] * i) for i in range(50)])
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == [i for i in range(50) for _ in range(i)]


def test_damage_is_found():
    raw = bytearray(image([(i, list(range(i, i + 90))) for i in range(20)]))
    with pytest.raises(ValueError):
        TokenFile(bytes(raw[:-1]))
    with pytest.raises(ValueError):
        TokenFile(b"")
    file = TokenFile(bytes(raw))
    at = int(file._frame_at[5])
    table = bytearray(raw)
    index = bytes(raw).rindex(file.seek_table.tobytes())
    table[index + 5 * 12 + 8] ^= 1  # the checksum of frame 5
    broken = TokenFile(bytes(table))
    assert broken.ids(0).tolist() == list(range(90))
    with pytest.raises(ValueError):
        broken.ids(5)
    raw[at + 12] ^= 0xFF
    with pytest.raises(Exception):
        TokenFile(bytes(raw)).ids(5)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    found = [tuple(r) for r in written_and_read(odd_documents).collect()]
    want = sorted((i is not None, i or 0, len(ids), digest(ids)) for (i, _), ids in zip(rows, encode([t for _, t in rows])))
    assert sorted((i is not None, i or 0, n, crc) for i, _, n, crc in found) == want
    ordered = sorted(found, key=lambda r: r[1])
    assert [r[0] or -1 for r in ordered] == sorted(-1 if i is None else i for i, _ in rows)
    at = 0
    for _, start, n, _ in ordered:
        assert start == at
        at += n
    assert written_and_read(no_documents).collect() == []
