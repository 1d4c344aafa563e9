"""Language of whole texts and of their parts.

Every word gets a score per language: naive Bayes over its byte trigrams and
the word itself.  Only languages that use the script of a word's letters are
candidates for it.  The best labelling of the word sequence is found by
Viterbi with a penalty for switching, so a text falls into spans of one
language each; a word without letters fits all.  A document's language is the
one with the most words, its score the share of words with letters in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import meet, remainder, small_batches, whole_text
from chaffsieve.llm.text64 import hash_words, utf8, word_bounds
from chaffsieve.sources.staging import stage

# Labelled documents a language is learned from, about; beyond it a part picked by hash.
SAMPLE = 2_000
GRAM_BITS, WORD_BITS = 16, 16
SWITCH = 8.0  # nats a change of language costs
BLOCK = 64  # words a step of the blocked Viterbi handles
PIECE = 1 << 19  # bytes of text scored at once
MIN_SCORE = 0.3  # of a document the filter keeps
SCRIPT_SHARE = 0.01  # of a language's words; a rarer script is foreign to it
UNKNOWN = "und"

# First code points of script blocks, and the script from there on
# (0 for none).
SCRIPT_STARTS = (
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0),
    (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1),
    (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
    (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0B80, 10), (0x0C00, 11), (0x0E00, 12), (0x0E80, 13),
    (0x1000, 14), (0x10A0, 15), (0x1100, 16), (0x1200, 17), (0x1380, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 18), (0x3100, 0), (0x3400, 19), (0x4DC0, 0), (0x4E00, 19), (0xA000, 0),
    (0xAC00, 16), (0xD7B0, 0), (0xF900, 19), (0xFB00, 0),
)
SCRIPTS = 20
SLOTS = (1 << GRAM_BITS) + (1 << WORD_BITS) + SCRIPTS


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of characters, code points) of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    follow = [data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
    two = (lead & 0x1F) << 6 | follow[0]
    three = (lead & 0x0F) << 12 | follow[0] << 6 | follow[1]
    four = (lead & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2]
    return at, np.select([lead < 0x80, lead < 0xE0, lead < 0xF0], [lead, two, three], four)


class Words:
    """The words of an Arrow string column: bounds, feature slots and scripts."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = data, offsets = utf8(column)
        self.starts, self.ends, self.first = starts, ends, first = word_bounds(data, offsets)
        lower = _LOWER[data]
        before, after = np.empty_like(lower), np.empty_like(lower)
        if len(data):
            before[1:], after[:-1] = lower[:-1], lower[1:]
        before[starts], after[ends - 1] = 32, 32
        self.lengths = ends - starts
        inside = np.repeat(starts - np.cumsum(self.lengths) + self.lengths, self.lengths)
        inside = inside + np.arange(len(inside))
        gram = before.astype(np.uint32) << 16 | lower.astype(np.uint32) << 8 | after
        self.grams = (gram[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
        self.words = hash_words(data, starts, ends) >> np.uint64(64 - WORD_BITS)
        bits = np.zeros(len(data), np.int64)
        if len(data):
            at, points = _code_points(data)
            block = np.searchsorted(_STARTS, points, "right") - 1
            bits[at] = np.where(_KINDS[block] > 0, 1 << _KINDS[block], 0)
        self.scripts = self._reduce(np.bitwise_or, bits[inside])

    def _reduce(self, how, values: np.ndarray) -> np.ndarray:
        """One value per word out of one per byte of the words."""
        if not len(self.starts):
            return np.zeros((0, *values.shape[1:]), values.dtype)
        return how.reduceat(values, np.cumsum(self.lengths) - self.lengths, axis=0)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STARTS = np.array([s for s, _ in SCRIPT_STARTS])
_KINDS = np.array([k for _, k in SCRIPT_STARTS])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    grams: np.ndarray  # [slot, language] log probabilities
    words: np.ndarray
    scripts: np.ndarray  # [language] bit mask

    def scores(self, words: Words) -> np.ndarray:
        """[word, language]: 0 for words without letters, -1000 beside a foreign script."""
        total = words._reduce(np.add, self.grams[words.grams]) + self.words[words.words]
        total -= total.max(axis=1, keepdims=True, initial=-np.inf)
        masks = words.scripts[:, None]
        fits = (masks & self.scripts[None, :]) != 0
        # Letters of a script that nobody uses tell nothing.
        neutral = (words.scripts == 0) | ~fits.any(axis=1)
        total[~fits] = -1000.0
        total[neutral] = 0.0
        return total


def learnable() -> Column:
    return F.col("lang").isNotNull() & (remainder("doc_id", 3) != 1)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled documents outside the held-out fold, about ``sample`` per language.

    Features are counted in tasks and summed by Spark; what reaches the driver
    is one number per language and slot at most.
    """
    small_batches(docs.sparkSession)
    labelled = docs.select("doc_id", "lang", "text").filter(learnable())
    sizes = stage(labelled.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id"), 4).cast("double") / float(1 << 60)
    share = drawn < F.lit(float(sample)) / F.col("rows")
    picked = meet(labelled, sizes, ["lang"]).filter(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(names.tolist()):
                w = Words(batch.column("text").filter(pa.array(names == lang)))
                held = counts.setdefault(lang, np.zeros(SLOTS, np.int64))
                held[: 1 << GRAM_BITS] += np.bincount(w.grams, minlength=1 << GRAM_BITS)
                held[1 << GRAM_BITS : -SCRIPTS] += np.bincount(
                    w.words.astype(np.int64), minlength=1 << WORD_BITS
                )
                for k in range(1, SCRIPTS):
                    held[k - SCRIPTS] += int(((w.scripts >> k) & 1).sum())
        for lang, held in counts.items():
            slots = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(slots), pa.string()),
                    "slot": pa.array(slots),
                    "n": pa.array(held[slots]),
                }
            )

    found = picked.select(F.col("lang").cast("string"), whole_text().alias("text")).mapInArrow(
        run, "lang string, slot bigint, n bigint"
    )
    found = found.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((SLOTS, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[found["slot"], found["lang"].map(place)] = found["n"]
    grams, words = counts[: 1 << GRAM_BITS], counts[1 << GRAM_BITS : -SCRIPTS]
    logs = lambda c: np.log((c + 0.1) / (c.sum(axis=0) + 0.1 * len(c))).astype(np.float32)
    scripts = counts[-SCRIPTS:]
    common = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    masks = (common * (1 << np.arange(SCRIPTS))[:, None]).sum(axis=0).astype(np.int64)
    return Model(languages, logs(grams), logs(words), masks)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best state of each word; ``first`` has the first word of each text (one entry more).

    value'(s) = score(s) + max(value(s), max(value) - switch).  Texts are cut
    into blocks of BLOCK words.  All blocks run in step, once from each state
    they may begin in, then once from the state values they do begin with, so
    the number of numpy calls grows with the longest text / BLOCK.
    """
    n, k = scores.shape
    if not n:
        return np.empty(0, np.int64)
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    block_first = np.concatenate(([0], np.cumsum(blocks)))
    text = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(n) - first[:-1][text]
    at = block_first[:-1][text] + within // BLOCK
    grid = np.zeros((BLOCK, block_first[-1], k))
    grid[within % BLOCK, at] = scores  # words past a text's end change nothing

    step = lambda v, e: e + np.maximum(v, v.max(axis=-1, keepdims=True) - switch)
    through = np.full((block_first[-1], k, k), -1e18)
    through[:, np.arange(k), np.arange(k)] = 0.0
    for t in range(BLOCK):
        through = step(through, grid[t][:, None, :])

    enter = np.zeros((block_first[-1], k))
    order = np.argsort(-blocks, kind="stable")
    many = blocks[order]
    for r in range(1, int(many[0])):
        here = block_first[:-1][order[: np.searchsorted(-many, -r, "left")]] + r
        enter[here] = (enter[here - 1][:, :, None] + through[here - 1]).max(axis=1)
        enter[here] -= enter[here].max(axis=1, keepdims=True)

    value, came = enter, np.empty((BLOCK, block_first[-1], k), np.int16)
    origin = np.tile(np.arange(k), (block_first[-1], 1))
    for t in range(BLOCK):
        top = value.argmax(axis=1)[:, None]
        stay = value >= np.take_along_axis(value, top, 1) - switch
        came[t] = np.where(stay, np.arange(k), top)
        origin = np.take_along_axis(origin, came[t].astype(np.int64), 1)
        value = step(value, grid[t])

    last = np.zeros(block_first[-1], np.int64)
    for r in range(int(many[0]) - 1, -1, -1):
        texts = order[: np.searchsorted(-many, -r, "left")]
        here = block_first[:-1][texts] + r
        ending = blocks[texts] == r + 1
        follow = np.minimum(here + 1, block_first[-1] - 1)
        last[here] = np.where(ending, value[here].argmax(axis=1), origin[follow, last[follow]])
    states = np.empty((BLOCK, block_first[-1]), np.int64)
    for t in range(BLOCK - 1, -1, -1):
        states[t] = last
        last = came[t][np.arange(block_first[-1]), last]
    return states[within % BLOCK, at]


def _no_letter(data: np.ndarray) -> bool:
    """Whether no character of a UTF-8 text is a letter, in any script."""
    return not any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


class _Part:
    """What is kept of a piece of a long text: where its words are, and how they came to their states."""

    def __init__(self, words: Words, scores: np.ndarray, value: np.ndarray, before: int, switch: float):
        position = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        self.starts, self.ends = position[words.starts] + before, position[words.ends] + before
        self.characters = int(position[-1])
        self.lettered = words.scripts != 0
        n, k = scores.shape
        blocks = -(-n // BLOCK)
        grid = np.zeros((BLOCK, blocks, k))
        grid[np.arange(n) % BLOCK, np.arange(n) // BLOCK] = scores
        step = lambda v, e: e + np.maximum(v, v.max(axis=-1, keepdims=True) - switch)
        through = np.full((blocks, k, k), -1e18)
        through[:, np.arange(k), np.arange(k)] = 0.0
        for t in range(BLOCK):
            through = step(through, grid[t][:, None, :])
        enter = np.empty((blocks, k))
        for r in range(blocks):
            enter[r] = value - value.max()
            value = (enter[r][:, None] + through[r]).max(axis=0)
        self.value = value
        # Small state numbers take a byte.
        self.came = np.empty((BLOCK, blocks, k), np.int8 if k < 128 else np.int16)
        self.origin = np.tile(np.arange(k), (blocks, 1))
        current = enter
        for t in range(BLOCK):
            top = current.argmax(axis=1)[:, None]
            stay = current >= np.take_along_axis(current, top, 1) - switch
            self.came[t] = np.where(stay, np.arange(k), top)
            self.origin = np.take_along_axis(self.origin, self.came[t].astype(np.int64), 1)
            current = step(current, grid[t])

    def states(self, last: int) -> tuple[np.ndarray, int]:
        """(state of each word, state before the first) if the last word ends in ``last``."""
        blocks = len(self.origin)
        at_end = np.empty(blocks, np.int64)
        for r in range(blocks - 1, -1, -1):
            at_end[r] = last
            last = int(self.origin[r, last])
        out = np.empty((BLOCK, blocks), np.int64)
        for t in range(BLOCK - 1, -1, -1):
            out[t] = at_end
            at_end = self.came[t][np.arange(blocks), at_end].astype(np.int64)
        return out.T.ravel()[: len(self.starts)], last


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end with a word; a word longer than a piece counts as several."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        blank = np.flatnonzero(_WHITE[data[end : end + PIECE]])
        if len(blank):
            end += int(blank[0])
        elif end + PIECE >= len(data):
            end = len(data)
        else:
            while data[end] & 0xC0 == 0x80:
                end += 1
        yield data[at:end]
        at = end


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _label_long(data: np.ndarray, model: Model, switch: float = SWITCH) -> tuple[str, float, list]:
    """``_label`` of one long text, piece by piece: only back pointers are kept of all its words."""
    parts, before = [], 0
    value = np.zeros(len(model.languages))
    for piece in _pieces(data):
        words = Words(pa.array([piece.tobytes()], pa.binary()).cast(pa.string()))
        if len(words.starts):
            parts.append(_Part(words, model.scores(words), value, before, switch))
            value = parts[-1].value
        before += int(((piece & 0xC0) != 0x80).sum())
    if not parts or _no_letter(data):
        return UNKNOWN, 0.0, []
    last, found = int(value.argmax()), []
    for part in reversed(parts):
        states, last = part.states(last)
        found.append(states)
    states = np.concatenate(found[::-1])
    lettered, starts, ends = (np.concatenate([getattr(p, c) for p in parts]) for c in ("lettered", "starts", "ends"))
    return _summary(states, lettered, starts, ends, model)


def _summary(
    states: np.ndarray, lettered: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: Model
) -> tuple[str, float, list]:
    """Language, score and spans of one text from the states of its words."""
    counts = np.bincount(states[lettered] if lettered.any() else states, minlength=len(model.languages))
    top = int(counts.argmax())
    turns = np.concatenate(([0], np.flatnonzero(np.diff(states)) + 1, [len(states)]))
    spans = [
        {"lang": model.languages[states[x]], "start": int(starts[x]), "end": int(ends[y - 1])}
        for x, y in zip(turns[:-1], turns[1:])
    ]
    return model.languages[top], float(counts[top] / counts.sum()), spans


def _label(words: Words, model: Model) -> list[tuple[str, float, list]]:
    """Language, score and spans (language, start, end in code points) of each text."""
    states = viterbi(model.scores(words), words.first) if model.languages else None
    lettered = words.scripts != 0
    position = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
    out = []
    ascii_letter = np.concatenate(([0], np.cumsum((_LOWER[words.data] >= 97) & (_LOWER[words.data] <= 122))))
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
        lo, hi = words.offsets[i], words.offsets[i + 1]
        none = ascii_letter[lo] == ascii_letter[hi] and _no_letter(words.data[lo:hi])
        if none or not model.languages:
            out.append((UNKNOWN, 0.0, []))
            continue
        starts, ends = position[words.starts[a:b]] - position[lo], position[words.ends[a:b]] - position[lo]
        out.append(_summary(states[a:b], lettered[a:b], starts, ends, model))
    return out


def label(column: pa.Array, model: Model) -> tuple[list, list, list]:
    """Languages, scores and spans of the texts of a column, some PIECE bytes at a time."""
    data, offsets = utf8(column)
    out, doc = [], 0
    while doc < len(column):
        stop = max(doc + 1, int(np.searchsorted(offsets, offsets[doc] + PIECE, "right")) - 1)
        if model.languages and offsets[stop] - offsets[doc] > PIECE:
            out.append(_label_long(data[offsets[doc] : offsets[stop]], model))
        else:
            out += _label(Words(column.slice(doc, stop - doc)), model)
        doc = stop
    return tuple(map(list, zip(*out))) if out else ([], [], [])


_SPANS = pa.list_(
    pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score, spans.

    ``spans`` lists (lang, start, end), in code points, from a first to a last
    word of one language.  A NULL text, or one without any letter, is ``und``
    with score 0 and no spans; so is every text if no language was learned.
    Ties go to the alphabetically first language.  Rows are judged one by one,
    so repeats agree; an empty table gives no rows; a text counts whole.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, shares, spans = label(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(shares, pa.float64()),
                    pa.array(spans, _SPANS),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(
        run,
        "doc_id bigint, lang_pred string, score double, "
        "spans array<struct<lang: string, start: bigint, end: bigint>>",
    )


def drop_unknown_languages(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without texts that have no letter or no leading language, all columns kept.

    Every row is judged by its own text, while that is at hand.  Where no
    language can be learned only texts without letters are told apart, and
    nothing goes.
    """
    model = fit(docs)
    if not model.languages:
        return docs
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def speaks(texts: pa.Array) -> pa.Array:
        names, scores, _ = label(texts, shared.value)
        return pa.array([n != UNKNOWN and s >= min_score for n, s in zip(names, scores)], pa.bool_())

    return docs.filter(speaks(whole_text()))
