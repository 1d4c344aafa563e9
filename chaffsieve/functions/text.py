"""Text features as Column expressions.

The features run inside the scan stage and on streaming frames alike.  All but
two stay in the JVM: syllables and repeated n-grams are counted by numpy over
Arrow batches, since a pattern or a lambda per word costs some times as much.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from chaffsieve.config import CODE_MARKERS, TERMINAL_PUNCT

# The characters Unicode counts as white space plus U+001C..U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for patterns: Java's Unicode \s lacks only U+001C..U+001F.
SPACE = r"\s\x1c-\x1f"

# Leading phrases of each task class, tested in this order.
PROMPT_CLASSES = (
    (
        "Question",
        (
            "can you", "could you", "would you", "do you", "did you", "is it",
            "are there", "should i", "what", "why", "how", "when", "who",
        ),
    ),
    ("Creative Task", ("write", "create", "generate", "compose", "draft")),
    ("Explanation", ("explain", "describe", "define", "clarify", "elaborate")),
    ("Problem Solving", ("calculate", "solve", "compute", "find the value", "evaluate")),
    ("Advice", ("suggest", "recommend", "advise", "tips for", "ways to")),
    ("Listing Task", ("give", "list", "provide", "name", "mention", "outline")),
    ("Editing/Rewriting", ("rewrite", "rephrase", "improve", "edit", "correct", "fix")),
)
OTHER_CLASS = "Other"

# Lower bound of each readability level, highest first.
READABILITY_LEVELS = (
    (90, "very easy"),
    (60, "easy"),
    (30, "medium"),
    (10, "hard"),
    (0, "very hard"),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    An expression captured by a lambda is re-evaluated for every element; a
    lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def clean_text(value: Column) -> Column:
    """Missing -> empty, anything -> string, outer white space removed."""
    return strip(F.coalesce(value.cast("string"), F.lit("")))


def normalise(text: Column) -> Column:
    """Lower case, runs of anything but a-z become one space."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z]+", " "))


def matches(text: Column, pattern: str) -> Column:
    """Number of non-empty matches: one fewer than the pieces between them."""
    return F.size(F.split(text, f"(?U){pattern}")) - 1


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"(?U)[{SPACE}]+"), lambda t: t != "")


def word_count(text: Column) -> Column:
    return matches(text, f"[^{SPACE}]+")


def sentence_count(text: Column) -> Column:
    """Stretches between . ! ? that hold something visible, at least one."""
    return F.greatest(matches(text, f"[^.!?{SPACE}][^.!?]*"), F.lit(1))


def words_per_sentence(words: Column, sentences: Column) -> Column:
    return half_even(words / sentences, 2)


def half_even(value: Column, digits: int) -> Column:
    return F.rint(value * 10.0**digits) / 10.0**digits


def has_input(text: Column) -> Column:
    return (F.length(text) > 0).cast("int")


def looks_like_code(
    text: Column, markers: tuple[str, ...] = CODE_MARKERS, min_hits: int = 2
) -> Column:
    """At least ``min_hits`` different markers occur; case matters."""
    hits = sum((text.contains(m).cast("int") for m in markers), F.lit(0))
    return (hits >= min_hits).cast("int")


# What a byte of UTF-8 is in a word: nothing, a gap, a vowel, e, l, another consonant.
_GAP, _VOWEL, _E, _L, _CONSONANT = range(1, 6)
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a") : ord("z") + 1] = _CONSONANT
for _letters, _kind in (("aiouy", _VOWEL), ("e", _E), ("l", _L), (WHITESPACE, _GAP)):
    _KIND[[ord(c) for c in _letters if c.isascii()]] = _kind
_WIDE_GAPS = [c.encode() for c in WHITESPACE if not c.isascii()]
# Bytes looked at together, at least a row.
_SLICE_BYTES = 1 << 20


def _further_syllables(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per row, ending in a line break before ``ends``: syllables of its words beyond one each."""
    kind = _KIND[codes]
    for first in {gap[0] for gap in _WIDE_GAPS}:
        at = np.flatnonzero(codes == first)
        for gap in (g for g in _WIDE_GAPS if g[0] == first):
            # A character is followed by others or by the line break.
            kind[at[np.all([codes[at + i] == byte for i, byte in enumerate(gap)], axis=0)]] = _GAP
    where = np.flatnonzero(kind)
    kind = kind[where]
    letter = np.concatenate(([False], kind > _GAP))
    vowel = np.concatenate(([False], (kind == _VOWEL) | (kind == _E)))
    opens = vowel[1:] & ~vowel[:-1]
    groups = np.cumsum(opens)
    starts = np.flatnonzero(letter[1:] & ~letter[:-1])
    lasts = np.flatnonzero(letter[:-1] & ~letter[1:]) - 1
    found = groups[lasts] - groups[starts] + opens[starts]
    silent = (found > 1) & (kind[lasts] == _E) & (kind[lasts - 1] == _CONSONANT)
    further = np.concatenate(([0], np.cumsum(np.maximum(found - silent, 1) - 1)))
    return np.diff(further[np.searchsorted(where[lasts], ends)], prepend=0)


def _count_further_syllables(texts: pa.Array) -> pa.Array:
    wide = pa.large_binary()
    rows = pc.binary_join_element_wise(
        texts.cast(wide).fill_null(b""), pa.scalar(b"", wide), pa.scalar(b"\n", wide)
    )
    offsets = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
    codes = np.frombuffer(rows.buffers()[2], np.uint8)
    out = np.zeros(len(rows), np.int32)
    for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(offsets[1:] // _SLICE_BYTES)) + 1):
        if len(part):
            begin, ends = offsets[part[0]], offsets[part + 1]
            out[part] = _further_syllables(codes[begin : ends[-1]], ends - begin)
    return pa.array(out, mask=np.asarray(texts.is_null()))


def syllable_count(text: Column, words: Column) -> Column:
    """Syllables of all words, each word counting at least one.

    Per word (letters only, lower case): the number of vowel groups, less one
    for a final consonant + e other than "le" when there is another group.
    """
    return F.arrow_udf(_count_further_syllables, IntegerType())(F.lower(text)) + words


def flesch(text: Column, words: Column, sentences: Column) -> Column:
    """Flesch reading ease (1948), two digits, NULL for a text without words."""
    score = (
        F.lit(206.835)
        - F.lit(1.015) * (words / sentences)
        - F.lit(84.6) * (syllable_count(text, words) / words)
    )
    return F.when(words > 0, half_even(score, 2))


def readability_level(score: Column) -> Column:
    level = F.when(score.isNull(), "not scored")
    for bound, name in READABILITY_LEVELS:
        level = level.when(score >= bound, name)
    return level.otherwise("extremely complex")


def is_truncated(text: Column, terminal: tuple[str, ...] = TERMINAL_PUNCT) -> Column:
    """The last visible character is not closing punctuation."""
    tail = F.rtrim(text, F.lit(WHITESPACE))
    return ((tail != "") & ~F.right(tail, F.lit(1)).isin(*terminal)).cast("int")


def _repeats(text: str, n: int, min_count: int) -> bool:
    words = text.split()  # at WHITESPACE
    if len(words) < n * min_count:
        return False
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    grams = np.zeros(len(words) - n + 1, np.int64)
    for k in range(n):
        grams = grams * 1_000_003 + hashes[k : k + len(grams)]
    ordered = np.sort(grams)
    met = ordered[min_count - 1 :] == ordered[: len(ordered) - min_count + 1]
    if not met.any():
        return False
    at = np.flatnonzero(np.isin(grams, ordered[min_count - 1 :][met]))
    return max(Counter(tuple(words[i : i + n]) for i in at.tolist()).values()) >= min_count


def has_repeated_ngram(text: Column, n: int = 5, min_count: int = 3) -> Column:
    """Some n-gram of lower-cased words occurs ``min_count`` times or more.

    Equal grams have equal hashes, which lie side by side when sorted; the
    words themselves are compared only if enough hashes are equal.
    """

    def check(texts: pa.Array) -> pa.Array:
        found = [None if t is None else int(_repeats(t, n, min_count)) for t in texts.to_pylist()]
        return pa.array(found, pa.int32())

    return F.arrow_udf(check, IntegerType())(F.lower(text))


def categorize_prompt(text: Column) -> Column:
    """Task class by leading phrase; the first class that matches wins."""

    def pick(head: Column) -> Column:
        out = None
        for name, phrases in PROMPT_CLASSES:
            hit = head.rlike("^(" + "|".join(phrases) + ")")
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise(OTHER_CLASS)

    return let(F.ltrim(F.lower(text), F.lit(WHITESPACE)), pick)


def preview(text: Column, chars: int) -> Column:
    return F.left(text, F.lit(chars))
