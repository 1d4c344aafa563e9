"""Collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chaffsieve.llm import collocations as co

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, inside=50, kept=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for size in (1, 2, 3):
                    if i + size <= len(words):
                        counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = set()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = [
                c
                for q, c in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * c >= inside * a for c in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:kept], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "of", "été", "ÉTÉ", "x", "yy", "<s>", "日本", "a-b", " "]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "!", "\x0c?"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "de", "", None]), text))
    return out


def frame(documents, rows):
    return documents([(i, t, lang, "s") for i, (lang, t) in enumerate(rows)])


@pytest.mark.parametrize("known", [co.KNOWN, 3, 0])
def test_equals_counting_every_phrase(documents, known):
    rows = texts(1, 150)
    assert got(co.collocations(frame(documents, rows), known=known)) == brute(rows)


def test_kept_and_ties(documents):
    rows = [("en", " ".join(f"w{i} w{i}x" for i in range(40)) + ".")] * 12
    assert got(co.collocations(frame(documents, rows), kept=5)) == brute(rows, kept=5)


@pytest.mark.parametrize("block", [8, 50, 1 << 21])
def test_windows_cross_blocks_and_slices(documents, monkeypatch, block):
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abc") for _ in range(300)) + "\n" + "a b c " * 20) for _ in range(10)]
    df = frame(documents, rows).coalesce(1)
    words = co.vocabulary(df)
    counted = Counter()
    for r in co.windows(df, co.commonest(words), block).collect():
        counted[r["w1"], r["w2"], r["w3"]] += r["n"]
    name = {r["w"]: r["word"] for r in co.word_numbers(words, least=1).collect()}
    want = Counter()
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = piece.split()
            for i in range(len(ws)):
                want[tuple((ws[i : i + 3] + [None, None])[:3])] += 1
    assert Counter({tuple(name.get(w) for w in k): n for k, n in counted.items()}) == want


def test_slices_do_not_change_words(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    made = [t for _, t in texts(5, 200)] + ["", None, "x" * 50]
    rng.shuffle(made)
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en"] * len(made)), "text": pa.array(made, pa.string())})

    def all_words():
        found, piece, parts = [], 0, []
        for s in co.slices(batch):
            found.append(s.words)
            parts.append(s.pieces)
        words, pieces = np.concatenate(found), np.concatenate(parts)
        return words, np.diff(pieces) == 0

    whole = all_words()
    monkeypatch.setattr(co, "SLICE", 16)
    for a, b in zip(all_words(), whole):
        assert np.array_equal(a, b)


def test_score_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3_000_000_001, 5_000_000_003, 7_000_000_009
    row = spark.range(1).select(co._score(*(F.lit(x).cast("bigint") for x in (a, left, right))).alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["lang"], r["text"]) for r in odd_documents.select("lang", "text").collect()]
    assert got(co.collocations(odd_documents, least=2)) == brute(rows, least=2)
    assert co.collocations(no_documents).collect() == []
