"""Phrases whose words keep company, from counts of longest windows alone.

Every word begins one window of LONGEST words: itself and the words that lead
it, padded where its piece ends.  Only these windows are counted, first inside
a task; a ROLLUP over the window's columns then sums them to every shorter
phrase, since each occurrence of a phrase begins exactly one window.

A word is its language and its text.  The commonest KNOWN words, a dictionary
of bounded size that is the same for all tasks, have small numbers, which keeps
shuffled windows small; others are their 64-bit hash, and equal hashes count
as equal words.  Before the ROLLUP, words of a window that no frequent phrase
can reach are replaced by REST, a mark of its own, so that rare windows
collapse into the sums of their frequent beginnings.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.llm.tables import meet, small_batches, whole_text
from chaffsieve.llm.text64 import finalise, hash_words, utf8
from chaffsieve.operators.lookup import top_k_per_group
from chaffsieve.sources.staging import stage

LONGEST = 3
LEAST = 10  # occurrences of a candidate
INSIDE = 50  # percent of a candidate's occurrences inside a longer one that drop it
KEPT = 2000  # per language
NO_LANGUAGE = "und"

PAD, REST = 0, 1  # beyond the end of a piece; too rare to matter
KNOWN = 1 << 18  # words with small numbers, 2 MB
BLOCK = 1 << 20  # words counted at once: their codes take 21 bits
SLICE = 4 << 20  # bytes hashed at once
BATCH_ROWS = 2048

_BREAK = np.zeros(256, bool)
_BREAK[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_BLANK = _BREAK.copy()
_BLANK[[9, 32]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Starts and ends of the words, the number of each word's piece, and how many pieces begin.

    A piece ends at a break, and a document that begins at one of ``offsets`` begins a piece.
    """
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~edge[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~edge[1:])) + 1
    pieces = np.cumsum(_BREAK[data] | edge[:-1], dtype=np.int64)
    return starts, ends, pieces[starts], int(pieces[-1])


def _hash(word: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """The hash of a word of a language; the top bit is set, so that no number of the dictionary is one."""
    return finalise(word + lang * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1 << 63)


class Slice(NamedTuple):
    """Some consecutive words of a task: where they are, the row of their document, their piece and hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    document: np.ndarray
    pieces: np.ndarray
    words: np.ndarray


def _cut(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word is cut."""
    while at < len(data):
        blank = np.flatnonzero(_BLANK[data[at : at + 4096]])
        if len(blank):
            return at + int(blank[0])
        at += 4096
    return len(data)


def slices(batch: pa.RecordBatch, piece: int = 0) -> Iterator[Slice]:
    """The words of a batch (lang, text), a bounded number of bytes at a time; pieces count from ``piece``."""
    data, offsets = utf8(batch.column("text"))
    lang_data, lang_offsets = utf8(batch.column("lang"))
    langs = np.zeros(batch.num_rows, np.uint64)
    full = np.flatnonzero(np.diff(lang_offsets))
    langs[full] = hash_words(lang_data, lang_offsets[full], lang_offsets[full + 1], lower=False)
    at = 0
    while at < len(data):
        end = _cut(data, min(at + SLICE, len(data)))
        here = offsets[(offsets >= at) & (offsets <= end)] - at
        starts, ends, pieces, last = words_of(data[at:end], here)
        document = np.searchsorted(offsets, starts + at, "right") - 1
        words = _hash(hash_words(data[at:end], starts, ends), langs[document])
        yield Slice(data[at:end], starts, ends, document, pieces + piece, words)
        at, piece = end, piece + last


def vocabulary(docs: DataFrame) -> DataFrame:
    """Staged (hash, lang, word, n): every word of every language, A-Z lower-cased, and how often it occurs."""
    small_batches(docs.sparkSession, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").cast(pa.string())
            for found in slices(batch):
                keys, first, counts = np.unique(found.words, return_index=True, return_counts=True)
                raw = found.data.tobytes()
                spans = zip(found.starts[first].tolist(), found.ends[first].tolist())
                words = [raw[a:b].lower().decode("utf-8", "replace") for a, b in spans]
                columns = [
                    pa.array(keys.view(np.int64)),
                    langs.take(pa.array(found.document[first])),
                    pa.array(words, pa.string()),
                    pa.array(counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "lang", "word", "n"])

    found = _texts(docs).mapInArrow(run, "hash bigint, lang string, word string, n bigint")
    return stage(
        found.groupBy("hash").agg(F.first("lang").alias("lang"), F.first("word").alias("word"), F.sum("n").alias("n")),
        "words",
    )


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(lang.alias("lang"), whole_text().alias("text"))


def commonest(words: DataFrame, most: int = KNOWN) -> np.ndarray:
    """At most ``most`` hashes of ``words``, commonest first: those from a frequency on.

    Frequencies are told apart by eighths of a power of two, so that what
    comes to the driver first has at most some 500 rows.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.empty(0, np.uint64)
    # At most ``most`` rows.
    rows = words.filter(step >= least).select("hash", "n").toArrow()
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    return hashes[np.lexsort((hashes, -rows.column("n").to_numpy()))]


def _numbers(known: np.ndarray):
    """A function from hashes to numbers: PAD stays, known words count from REST + 1, others keep their hash."""
    order = np.argsort(known)
    ordered = known[order]

    def numbered(hashes: np.ndarray) -> np.ndarray:
        if not len(ordered):
            return hashes
        at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
        return np.where(ordered[at] == hashes, (order[at] + REST + 1).astype(np.uint64), hashes)

    return numbered


def count_windows(words: np.ndarray, pieces: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """([n, LONGEST] distinct padded windows, how often each occurs) of those that start at the first ``begin`` words."""
    distinct, code = np.unique(words, return_inverse=True)
    code = (code + 1).astype(np.int64)  # 0 pads
    packed = code[:begin]
    for lead in range(1, LONGEST):
        next_word = np.zeros(begin, np.int64)
        some = min(begin, len(code) - lead)
        if some > 0:
            same = pieces[lead : lead + some] == pieces[:some]
            next_word[:some] = np.where(same, code[lead : lead + some], 0)
        packed = packed << 21 | next_word
    packed, counts = np.unique(packed, return_counts=True)
    parts = [packed >> (21 * (LONGEST - 1 - k)) & ((1 << 21) - 1) for k in range(LONGEST)]
    values = np.concatenate((np.array([PAD], np.uint64), distinct))
    return np.column_stack([values[p] for p in parts]), counts


def windows(docs: DataFrame, known: np.ndarray, block: int = BLOCK) -> DataFrame:
    """(w1, w2, w3, n): the padded longest windows of each task, counted block by block.

    A block's last words wait for those that lead them.
    """
    small_batches(docs.sparkSession, BATCH_ROWS)
    names = [f"w{k + 1}" for k in range(LONGEST)]
    ahead = LONGEST - 1

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(words, pieces, how many of them begin a window)"""
        numbered, piece = _numbers(known), 0
        words, pieces = np.empty(0, np.uint64), np.empty(0, np.int64)
        held = [(words, pieces)]
        size = 0
        for batch in batches:
            for found in slices(batch, piece):
                held.append((numbered(found.words), found.pieces))
                size += len(found.words)
                if size < block // 2:
                    continue
                words, pieces = (np.concatenate(c) for c in zip(*held))
                at = 0
                while len(words) - at > ahead:
                    begin = min(block - ahead - 2, len(words) - at - ahead)
                    yield words[at : at + begin + ahead], pieces[at : at + begin + ahead], begin
                    at += begin
                held, size = [(words[at:], pieces[at:])], len(words) - at
            # The next batch begins a document, so its numbers need only differ.
            piece = int(held[-1][1][-1]) + 1 if len(held[-1][1]) else piece
        words, pieces = (np.concatenate(c) for c in zip(*held))
        for at in range(0, len(words), block - ahead - 2):
            begin = min(block - ahead - 2, len(words) - at)
            yield words[at : at + begin + ahead], pieces[at : at + begin + ahead], begin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, pieces, begin in blocks(batches):
            found, counts = count_windows(words, pieces, begin)
            for at in range(0, len(counts), 1 << 16):
                some = slice(at, at + (1 << 16))
                columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in found[some].T]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[some])], names=[*names, "n"])

    return _texts(docs).mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "n"]))


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = LEAST, known: int = KNOWN) -> DataFrame:
    """Staged (size, w1, w2, w3, n): every phrase of up to LONGEST words that occurs ``least`` times.

    Words are numbered as in ``word_numbers``; w2 and w3 of a shorter phrase are NULL.
    """
    found = windows(docs, commonest(words, known))
    # One shuffle by the first two words: a pair's windows, counted in tasks, meet in one place.
    counted = found.repartition("w1", "w2").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n"))
    pair = F.sum("n").over(Window.partitionBy("w1", "w2"))
    paired = (F.col("w2") != PAD) & (pair >= least)
    pruned = counted.select(
        "w1",
        F.when(paired, F.col("w2")).otherwise(REST).alias("w2"),
        F.when(paired & (F.col("w3") != PAD) & (F.col("n") >= least), F.col("w3")).otherwise(REST).alias("w3"),
        "n",
    )
    summed = pruned.rollup("w1", "w2", "w3").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # Levels 0, 1, 3 and 7: nothing, w3, w2 and w3, all summed away.
    size = F.when(F.col("level") == 0, 3).when(F.col("level") == 1, 2).when(F.col("level") == 3, 1)
    whole = (F.coalesce("w2", F.lit(PAD)) != REST) & (F.coalesce("w3", F.lit(PAD)) != REST)
    return stage(
        summed.filter((F.col("n") >= least) & (F.col("level") < 7) & whole).select(size.alias("size"), "w1", "w2", "w3", "n"),
        "phrases",
    )


def word_numbers(words: DataFrame, least: int = LEAST, known: int = KNOWN) -> DataFrame:
    """Staged (w, lang, word) of the words that occur ``least`` times, by number or hash."""
    common = commonest(words, known)
    spark = words.sparkSession
    numbers = spark.createDataFrame(
        pa.table({"hash": pa.array(common.view(np.int64)), "w": pa.array(np.arange(len(common)) + REST + 1)})
    )
    frequent = words.filter(F.col("n") >= least)
    # The dictionary has at most ``known`` rows of two numbers.
    found = frequent.join(F.broadcast(numbers), "hash", "left")
    return stage(found.select(F.coalesce("w", "hash").alias("w"), "lang", "word"), "word-numbers")


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a² / (l r)) in whole numbers of 38 digits: exact for counts below 10^15."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(a, 15) * wide(a, 15), wide(l, 18) * wide(r, 18))


def collocations(
    docs: DataFrame, least: int = LEAST, inside: int = INSIDE, kept: int = KEPT, known: int = KNOWN
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``kept`` best phrases of 2 to LONGEST words.

    A phrase occurs ``a`` times, the two parts of its lowest-scoring cut ``l``
    and ``r`` times, and its language has ``n`` words.  Ties go to the earlier
    cut, then to the larger ``a``, then to the phrase that comes first by
    bytes.  A phrase that lies to ``inside`` percent in a longer one is
    dropped.  A NULL lang is ``und``, a NULL text is empty; rows that repeat
    count each; an empty table gives no rows; other columns are ignored.
    """
    words = vocabulary(docs)
    phrases = phrase_counts(docs, words, least, known)
    single = stage(phrases.filter("size = 1").select(F.col("w1").alias("w"), F.col("n").alias("single")), "phrases-1")
    pairs = stage(phrases.filter("size = 2").select("w1", "w2", F.col("n").alias("a")), "phrases-2")
    triples = phrases.filter("size = 3").select("w1", "w2", "w3", F.col("n").alias("a"))

    def with_single(df: DataFrame, column: str, name: str) -> DataFrame:
        return meet(df, single.select(F.col("w").alias(column), F.col("single").alias(name)), [column])

    def with_pair(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
        side = pairs.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))
        return meet(df, side, [first, second])

    def cut(k: int, left: str, right: str) -> Column:
        return F.struct(
            _score(F.col("a"), F.col(left), F.col(right)).alias("score"),
            F.lit(k).alias("k"),
            F.col(left).alias("l"),
            F.col(right).alias("r"),
        )

    # How often the longer candidate around a pair occurs, at most.
    around = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    around = around.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    free = meet(pairs, stage(around, "phrases-around"), ["w1", "w2"], "left").filter(
        F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True))
    )
    two = with_single(with_single(free, "w1", "f1"), "w2", "f2").select(
        "w1", "w2", F.lit(None).cast("bigint").alias("w3"), "a", cut(1, "f1", "f2").alias("cut")
    )
    three = with_single(with_single(triples, "w1", "f1"), "w3", "f3")
    three = with_pair(with_pair(three, "w1", "w2", "f12"), "w2", "w3", "f23").select(
        "w1", "w2", "w3", "a", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")).alias("cut")
    )
    scored = two.unionByName(three).select("*", "cut.score", "cut.l", "cut.r").drop("cut")

    named = word_numbers(words, least, known)
    for k in range(1, LONGEST + 1):
        side = named.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}"), *(["lang"] if k == 1 else []))
        scored = meet(scored, side, [f"w{k}"], "left")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    spelled = scored.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", "l", "r", F.col("score").cast("bigint")
    )
    best = top_k_per_group(
        spelled, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], "phrase", kept, AuditConfig()
    )
    return meet(best, stage(totals, "words-per-language"), ["lang"]).select(
        "lang", F.col("position").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
