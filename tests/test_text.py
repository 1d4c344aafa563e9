"""Column functions against hand-written rows and plain-Python definitions."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chaffsieve.functions import text as fx

def col():
    return F.col("t")


def run(spark, texts, column):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    out = df.select("i", column.alias("x")).collect()
    return [r["x"] for r in sorted(out, key=lambda r: r["i"])]


@pytest.mark.parametrize(
    "column, cases",
    [
        (lambda: fx.word_count(col()), {"": 0, "a  b\tc": 3, "a b": 2, "a\x1cb": 2, " a ": 1}),
        (lambda: fx.sentence_count(col()), {"": 1, "No stop": 1, "Hi... there!": 2, "3.14": 2, "! ?": 1}),
        (lambda: fx.normalise(col()), {" Hello, World! 42 ": "hello world", "Café": "caf", "42": ""}),
        (lambda: fx.looks_like_code(col()), {"a { b": 0, "{ ; {": 1, "select ;": 0, "SELECT x;": 1}),
        (lambda: fx.is_truncated(col()), {"Done.": 0, "Done": 1, "x}": 1, "   ": 0, "ok:  ": 0, "。": 1}),
        (
            lambda: fx.has_repeated_ngram(col()),
            {
                " ".join(["a"] * 7): 0,
                " ".join(["a"] * 15): 1,
                " ".join(f"w{i}" for i in range(40)): 0,
                "x a B c d e y a b c d e z w v A b c d e": 1,
                "x a b c d e y a b c d e z w v u t s r q": 0,
            },
        ),
        (
            lambda: fx.categorize_prompt(col()),
            {
                "Whatever": "Question",
                "Given x": "Listing Task",
                "  WRITE": "Creative Task",
                "Please write": "Other",
                "Find the value": "Problem Solving",
                "Fixture": "Editing/Rewriting",
                " Explain": "Explanation",
                "tips for x": "Advice",
                "": "Other",
            },
        ),
        (lambda: fx.clean_text(col()), {"  a b\x1f": "a b", None: "", "\n": ""}),
        (lambda: fx.has_input(col()), {"": 0, "x": 1}),
        (lambda: fx.preview(col(), 3), {"ab": "ab", "\U0001f600bcd": "\U0001f600bc"}),
    ],
)
def test_edge_rows(spark, column, cases):
    assert run(spark, list(cases), column()) == list(cases.values())


def test_readability_level(spark):
    scores = [None, 90.0, 89.99, 60.0, 30.0, 10.0, 0.0, -0.01]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(fx.readability_level(F.col("s"))).collect()]
    assert got == [
        "not scored", "very easy", "easy", "easy", "medium", "hard", "very hard",
        "extremely complex",
    ]


def syllables(text):
    total = 0
    for word in text.lower().split():
        letters = re.sub("[^a-z]", "", word)
        groups = re.findall("[aeiouy]+", letters)
        silent = len(groups) > 1 and re.search("[^aeiouyl]e$", letters)
        total += max(1, len(groups) - bool(silent))
    return total


def repeated(text, n=5, min_count=3):
    words = text.lower().split()
    grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return int(len(words) >= n * min_count and max(grams.values()) >= min_count)


MESSY = st.text(
    alphabet="abcdeElLeyYxz. !?\t\n'42  \x1déß　", max_size=60
)
LOOPY = st.lists(st.sampled_from(["a", "B", "b", "c"]), max_size=40).map(" ".join)
RELAXED = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@RELAXED
@given(texts=st.lists(MESSY, min_size=30, max_size=60))
def test_counts_match_plain_python(spark, texts):
    words = fx.word_count(col())
    both = F.struct(
        words.alias("w"),
        fx.sentence_count(col()).alias("s"),
        fx.normalise(col()).alias("n"),
        fx.syllable_count(col(), words).alias("y"),
        fx.tokens(col()).alias("t"),
    )
    for text, got in zip(texts, run(spark, texts, both)):
        parts = [p for p in re.split("[.!?]+", text) if p.strip()]
        assert got["w"] == len(text.split()), repr(text)
        assert got["t"] == text.split(), repr(text)
        assert got["s"] == max(len(parts), 1), repr(text)
        assert got["n"] == " ".join(re.findall("[a-z]+", text.lower())), repr(text)
        assert got["y"] == syllables(text), repr(text)


@RELAXED
@given(texts=st.lists(LOOPY, min_size=30, max_size=60))
def test_repeated_ngrams_match_plain_python(spark, texts):
    assert run(spark, texts, fx.has_repeated_ngram(col())) == [repeated(t) for t in texts]


def test_long_texts_stay_linear(spark):
    texts = ["e" * 200_000, "b" * 200_000, " " * 200_000 + "x", "be" * 100_000, "ab " * 60_000]
    words = fx.word_count(col())
    got = run(spark, texts, F.struct(words, fx.syllable_count(col(), words), fx.is_truncated(col())))
    assert [tuple(r) for r in got[:3]] == [(1, 1, 1), (1, 1, 1), (1, 1, 1)]
    assert got[4][0] == 60_000
    assert run(spark, [texts[4]], fx.has_repeated_ngram(col())) == [1]


def test_words_part_at_every_white_space(spark):
    # No gap, a letter of the same first byte, and every gap within and at the end of a text.
    gaps = ["", "é", "‐", "​", *fx.WHITESPACE]
    texts = [f"cafe{g}table{g}\nthe{g}ae{g}" for g in gaps] + ["x" * fx._SLICE_BYTES, "", "made", None]
    words = fx.word_count(col())
    got = run(spark, texts, F.struct(fx.syllable_count(col(), words).alias("y"), fx.has_repeated_ngram(col()).alias("r")))
    assert [r["y"] for r in got[:-1]] == [syllables(t) for t in texts[:-1]]
    assert tuple(got[-1]) == (None, None)


def test_features_of_words_leave_no_lambda_per_word(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    found = df.select(fx.has_repeated_ngram(col()), fx.syllable_count(col(), fx.word_count(col())))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
