"""Token ids of whole texts by a BPE vocabulary, many documents at once.

The byte-level vocabulary's pattern never joins a letter, digit or sign to a
following space, so a text can be cut before every single space between two
visible characters, and each cut segment has its ids whatever surrounds it.
The vocabulary with word ends drops white space, so its words are segments.
Segments repeat often: they are found on the UTF-8 buffer by hash, compared
byte by byte, and only unseen ones are encoded.  Added tokens of a vocabulary
hold no space; where a text spells one out it gets that token's id, as the
vocabulary says.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np

from chaffsieve.llm.text64 import hash_words, word_bounds

VOCABULARY = "byte_bpe_50k"
WORD_VOCABULARY = "word_bpe_49k"
SLICE = 1 << 21  # bytes handled at once
CACHED = 300_000  # segments a worker remembers, some 60 MB
WORDS_CACHED = 600_000  # words are shorter

# The two libraries split Latin text alike; other scripts go to the slower one,
# whose ids are the definition.
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def vocabulary_paths(name: str = VOCABULARY) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def word_vocabulary_path(name: str = WORD_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")


@cache
def _encoders(definition: str, ranks: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(definition)
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )
    return exact, fast


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the segments: document starts, and spaces between two visible characters.

    Characters of two bytes from U+00C0 on and of three bytes from U+4000 on
    are visible; the blocks in between hold white space and are never cut at.
    """
    if not len(data):
        return np.empty(0, np.int64)
    space = np.flatnonzero(data == 32)
    space = space[(space > 0) & (space < len(data) - 1)]
    before, after = data[space - 1], data[space + 1]
    two, three = data[np.maximum(space - 2, 0)], data[np.maximum(space - 3, 0)]
    plain = lambda b: (b > 32) & (b < 127)
    tail = lambda b: (b >= 0x80) & (b < 0xC0)
    left = plain(before) | (
        tail(before) & (((two >= 0xC3) & (two < 0xE0)) | (tail(two) & (three >= 0xE4) & (three < 0xEE)))
    )
    right = plain(after) | ((after >= 0xC3) & (after < 0xE0)) | ((after >= 0xE4) & (after < 0xEE))
    starts = offsets[:-1][np.diff(offsets) > 0]
    # Two ascending runs: a stable sort merges them.
    cuts = np.sort(np.concatenate((space[left & right], starts)), kind="stable")
    return cuts[np.diff(cuts, prepend=-1) > 0]


class Ids:
    """Encode slices of documents; remembers segments from call to call."""

    cached = CACHED

    def __init__(self, definition: str, ranks: str):
        self.exact, self.fast = _encoders(definition, ranks)
        added = (t.content for t in self.exact.get_added_tokens_decoder().values())
        self.not_fast = re.compile("|".join([_BEYOND_LATIN.pattern, *map(re.escape, added)]))
        self.known: dict[bytes, bytes] = {}

    def segments(self, raws: list[bytes]) -> list[bytes]:
        """The ids of some segments, each as bytes."""
        not_fast, fast, exact, out = self.not_fast.search, self.fast.encode_ordinary, self.exact.encode, []
        for raw in raws:
            text = raw.decode("utf-8", "replace")
            ids = exact(text, add_special_tokens=False).ids if not_fast(text) else fast(text)
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where segments start and end."""
        starts = _cuts(data, offsets)
        return starts, np.append(starts[1:], len(data))

    def _slice(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments of ``data``, and where each segment's begin (one entry more)."""
        keys, where, inverse = np.unique(
            hash_words(data, starts, ends, lower=False), return_index=True, return_inverse=True
        )
        # Equal hashes must mean equal bytes: compare every segment with the first of its key.
        lengths = ends - starts
        first = starts[where][inverse]
        same = np.array_equal(lengths, lengths[where][inverse])
        if same:
            # The bytes of all segments, one after the other, here and at the first of each key.
            at = np.arange(lengths.sum())
            before = np.cumsum(lengths) - lengths
            here = data if len(at) == len(data) else data[at + np.repeat(starts - before, lengths)]
            same = np.array_equal(data[at + np.repeat(first - before, lengths)], here)
        if not same:
            where, inverse = np.arange(len(starts)), np.arange(len(starts))
        if len(self.known) > self.cached:
            self.known.clear()
        blob, known = data.tobytes(), self.known
        raws = [blob[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
        found = list(map(known.get, raws))
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unseen, self.segments([raws[i] for i in unseen])):
            found[i] = ids
            if len(raws[i]) <= 256:
                known[raws[i]] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        begins = np.cumsum(sizes) - sizes
        counts = sizes[inverse]
        at = np.concatenate(([0], np.cumsum(counts)))
        index = np.repeat(begins[inverse] - at[:-1], counts) + np.arange(at[-1])
        return flat[index], at

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each document, in order."""
        starts, ends = self.bounds(data, offsets)
        parts: list[np.ndarray] = []
        doc, at = 0, 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE, "right")) - 1)
            end = int(starts[stop]) if stop < len(starts) else len(data)
            first = starts[at]
            ids, begins = self._slice(data[first:end], starts[at:stop] - first, ends[at:stop] - first)
            here = starts[at:stop]
            while doc < len(offsets) - 1 and offsets[doc] < end:
                lo = begins[np.searchsorted(here, offsets[doc])] if offsets[doc] >= here[0] else 0
                hi = begins[np.searchsorted(here, offsets[doc + 1])]
                parts.append(ids[lo:hi])
                if offsets[doc + 1] > end:
                    break
                yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                parts, doc = [], doc + 1
            at = stop
        for _ in range(doc, len(offsets) - 1):
            yield np.concatenate(parts) if parts else np.empty(0, "<u4")
            parts = []


def _letter_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is a letter: ASCII or of Latin-1."""
    before, two = data[at - 1], data[np.maximum(at - 2, 0)]
    low = before | 32
    ascii_letter = (low >= 97) & (low <= 122) & (before < 128)
    return ascii_letter | ((two == 0xC3) & (before >= 0x80) & (before < 0xC0) & (before != 0x97) & (before != 0xB7))


class WordIds(Ids):
    """Ids by the vocabulary with word ends, which lower-cases and drops white space.

    No token reaches across ASCII white space, nor from a letter to one of
    .,;:!? that follows it, and no normalisation does, so segments end there.
    """

    cached = WORDS_CACHED

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(definition)
        self.known = {}

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, _ = word_bounds(data, offsets)
        mark = np.flatnonzero(_STOPS[data]) if len(data) else np.empty(0, np.int64)
        mark = mark[(mark > 0) & ~np.isin(mark, starts, assume_unique=True)]
        mark = mark[_letter_before(data, mark)]
        return np.sort(np.concatenate((starts, mark))), np.sort(np.concatenate((ends, mark)))

    def segments(self, raws: list[bytes]) -> list[bytes]:
        """All in one call: tokens belong to the segment in which they start."""
        if not raws:
            return []
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(lengths + 1) - lengths - 1
        found = self.exact.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        at = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        edges = np.append(np.searchsorted(at, starts), len(ids)).tolist()
        flat = ids.tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]


_STOPS = np.zeros(256, bool)
_STOPS[np.frombuffer(b".,;:!?", np.uint8)] = True


@cache
def byte_ids(definition: str, ranks: str) -> Ids:
    """One encoder per Python worker: what a task has seen helps the next."""
    return Ids(definition, ranks)


@cache
def word_ids(definition: str) -> WordIds:
    return WordIds(definition)
