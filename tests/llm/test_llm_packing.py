"""Packing: exact ids, gapless sequences, the sum-of-squares rule, little padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from chaffsieve.llm import tokens
from chaffsieve.llm.packing import Levels, pack, sequences
from chaffsieve.llm.text64 import utf8

ODD = [
    "", "a", "a  b", "a b c", "x \n y", " lead", "trail ", "foo   bar baz", "a b c",
    "a  b c", "tab\t x y", "<|endoftext|> hi", "É è ü ñ", "a\x1c b c",
    "…  ok — so", "1 2  3 45 'll it's", "日本 語 test", "\U0001f642 \U0001f642 a",
    "  wide 　 space", "one two three " * 40,
]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return made


@pytest.mark.parametrize("size", [1 << 21, 40, 3])
def test_ids_are_those_of_the_whole_text(tokenizer, monkeypatch, size):
    monkeypatch.setattr(tokens, "SLICE", size)
    data, offsets = utf8(pa.array(ODD + ODD[::-1]))
    encoder = tokens.Ids(*tokens.vocabulary_paths())
    for _ in range(2):
        found = [x.tolist() for x in encoder.documents(data, offsets)]
        assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD + ODD[::-1]]


def test_ids_do_not_rest_on_hashes_alone(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "hash_words", lambda data, starts, ends, lower: (ends - starts).astype(np.uint64))
    data, offsets = utf8(pa.array(ODD))
    found = [x.tolist() for x in tokens.Ids(*tokens.vocabulary_paths()).documents(data, offsets)]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


def test_placement_minimises_the_sum_of_squares():
    rng, levels = np.random.default_rng(4), Levels(16)
    for size in rng.integers(1, 16, 400):
        def after(h, size=size):
            count = levels.count.copy()
            count[h] -= 1 if h else 0
            if h + size < 16:
                count[h + size] += 1
            return int((count[1:16] ** 2).sum())

        choices = [h for h in range(0, 17 - size) if h == 0 or levels.count[h]]
        best = levels.best(int(size))
        assert best in choices and after(best) == min(map(after, choices))
        levels.place((0, 0, np.zeros(size, np.uint32), int(size)))


def check(pieces, window):
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        by_document[p["doc_id"]].append(p)
    for rows in by_sequence.values():
        at = 0
        for p in sorted(rows, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] == len(p["ids"]) // 4 > 0
            at += p["length"]
        assert at == window or at & (at - 1) == 0 and at < window
    return by_document


def test_every_id_is_in_one_piece(documents, tokenizer):
    texts = {i: " ".join(f"w{i}x{j}" for j in range(i * 7 % 400)) for i in range(120)}
    found = pack(documents(list(texts.items())), window=64).collect()
    for i, pieces in check(found, 64).items():
        pieces.sort(key=lambda p: p["start"])
        want = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert b"".join(p["ids"] for p in pieces) == want.tobytes()
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
        assert {p["doc_tokens"] for p in pieces} == {len(want)}


def test_closing_early_loses_nothing():
    rng = np.random.default_rng(5)
    docs = [(i, np.arange(n, dtype=np.uint32)) for i, n in enumerate(rng.integers(1, 40, 300))]
    seen = Counter()
    for s in sequences(iter(docs), window=16, max_open=3):
        for doc, start, ids, total in s:
            assert ids.tolist() == list(range(start, start + len(ids)))
            seen[doc] += len(ids)
    assert seen == {i: len(x) for i, x in docs}


def test_odd_rows(odd_documents, no_documents):
    found = pack(odd_documents).collect()
    assert {p["doc_id"] for p in found} == {None, *range(1, 10)}
    check(found, 2048)
    empty = [p for p in found if p["doc_id"] in (1, 2)]
    assert [(p["length"], zlib.crc32(p["ids"])) for p in empty] == [(1, zlib.crc32(b"\1\0\0\0"))] * 2
    assert pack(no_documents).collect() == []


def test_cuts_ascend_once_each_and_segments_keep_their_ids():
    """A document that begins with a space is cut there once, empty documents are not cut."""
    from chaffsieve.llm import tokens

    texts = ["a b", " c d", "", "é f一 g", " ", "</s> h", "a b"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    cuts = tokens._cuts(data, offsets)
    assert (np.diff(cuts) > 0).all() and set(offsets[:-1][np.diff(offsets) > 0]) <= set(cuts.tolist())
    encoder = tokens.byte_ids(*tokens.vocabulary_paths())
    for text, ids in zip(texts, encoder.documents(data, offsets)):
        assert ids.tolist() == encoder.exact.encode(text, add_special_tokens=False).ids
