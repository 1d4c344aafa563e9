"""Quality: held-out accuracy, and scores that depend on the text alone."""

import os
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from chaffsieve.llm import quality
from chaffsieve.llm.tables import table

BASE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")
def test_held_out_accuracy(spark):
    docs, labels = table(spark, BASE, "documents"), table(spark, BASE, "labels")
    model = quality.fit(docs, labels, sample=400)
    found = quality.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in found if crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(r["score"] >= 0.3) == bool(r["quality"]) for r in held]
    for label in (0, 1):
        of = [ok for ok, r in zip(right, held) if r["quality"] == label]
        assert len(of) > 50 and np.mean(of) >= 0.97
    again = quality.fit(docs.repartition(5), labels, sample=400)
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_scores_do_not_depend_on_neighbours(monkeypatch):
    texts = ["Hello world foo", "a a a a b", "x" * 3000, " lead and trail ", "", None, "é ü ñ " * 100]
    model = quality.Model(np.random.default_rng(1).normal(size=1 << quality.BUCKET_BITS), 0.1)
    whole = model.scores(pa.array(texts))
    for piece in (1 << 19, 100, 10):
        monkeypatch.setattr(quality, "PIECE", piece)
        together = model.scores(pa.array(texts))
        alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
        assert np.array_equal(together, alone) and np.allclose(together, whole)
    assert together[4] == together[5] == 1 / (1 + np.exp(-0.1))


def test_features_are_words_pairs_and_grams():
    found = np.concatenate([s for s, _ in quality.features(pa.array(["ab cd"]))])
    # Two words, one pair, and of ' ab ' and ' cd ' two 3-grams and one 4-gram each.
    assert len(found) == 2 + 1 + 2 * (2 + 1)
    same = [np.concatenate([s for s, _ in quality.features(pa.array([t]))]) for t in ("q q", "r r")]
    assert len(set(same[0].tolist()) & set(same[1].tolist())) == 1


def test_training_separates_two_kinds_of_documents():
    rng = np.random.default_rng(0)
    docs, labels = [], np.arange(60) % 2
    for label in labels:
        slots = np.unique(rng.integers(0, 50, 10) + 1000 * label).astype(np.int32)
        docs.append((slots, np.ones(len(slots), np.int32)))
    model = quality.train(docs, labels)
    margins = [model.weights[s].mean() + model.bias for s, _ in docs]
    assert all((m > 0) == bool(y) for m, y in zip(margins, labels))
    assert quality.train([], np.array([], np.int64)).bias == 0


def test_odd_rows(spark, odd_documents, no_documents):
    labels = [(5, 1, 0), (4, 0, 0), (4, 0, 1), (None, 1, 0), (6, None, 0), (99, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.fit(odd_documents, labels)
    found = quality.score(odd_documents, model).collect()
    assert len(found) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in found)
    untrained = quality.fit(no_documents, labels.limit(0))
    assert quality.score(no_documents, untrained).collect() == []
    scores = {r["score"] for r in quality.score(odd_documents, untrained).collect()}
    assert scores == {0.5}


MASK = (1 << 64) - 1


def finalised(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def plain_slots(text):
    """The slots of a text, feature by feature."""
    from chaffsieve.llm.text64 import byte_values, hash_words

    values = [int(v) for v in byte_values(True)]
    shift = 64 - quality.BUCKET_BITS

    def hashed(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(hash_words(data, np.array([0]), np.array([len(data)]))[0])

    def number(c):
        first, *rest = c.encode()
        h = values[first]
        factor = 0xC2B2AE3D27D4EB4F
        for b in rest:
            h = (h * factor + values[b]) & MASK
        return h

    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", text) if w]
    slots = [hashed(w) >> shift for w in words]
    for x, y in zip(map(hashed, words), map(hashed, words[1:])):
        h = 0x5851F42D4C957F2D if x == y else (x * 0x9FB21C651E98DF25 + y) & MASK
        slots.append(finalised(h) >> shift)
    for w in words:
        padded = [number(c) for c in f" {w} "]
        for n in quality.GRAMS:
            for i in range(len(padded) - n + 1):
                h = 0
                for v in padded[i : i + n]:
                    h = (h * 0xD1342543DE82EF95 + v) & MASK
                slots.append(finalised((h + n) & MASK) >> shift)
    return slots


def test_a_score_is_that_of_the_mean_vector(monkeypatch):
    texts = ["Hello WORLD hello", "été à la plage, déjà-vu", "日本語 と 中文", "x", "a a b a a", "", "one two " * 30 + "🙂🙂 end"]
    rng = np.random.default_rng(3)
    table = rng.normal(size=(1 << quality.BUCKET_BITS, quality.DIMS))
    layer, bias = rng.normal(size=(2, quality.DIMS)), rng.normal(size=2)
    for piece in (1 << 19, 50):
        monkeypatch.setattr(quality, "PIECE", piece)
        found = quality.fold(table, layer, bias).scores(pa.array(texts))
        for text, score in zip(texts, found):
            slots = plain_slots(text)
            hidden = table[slots].mean(axis=0) if slots else np.zeros(quality.DIMS)
            odds = np.exp(layer @ hidden + bias)
            assert score == pytest.approx(odds[1] / odds.sum(), abs=1e-5)


def test_one_id_with_very_many_texts_counts_a_bounded_number_of_times(spark, documents, monkeypatch):
    texts = [(5, f"text number {i} of one id") for i in range(300)] + [(i, f"other {i}") for i in range(20, 60)]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, i % 2) for _, i in enumerate([5, *range(20, 60)])], "doc_id bigint, quality int")
    seen = []
    plain = quality.train
    monkeypatch.setattr(quality, "train", lambda d, y, seed=7: seen.append(len(d)) or plain(d, y, seed))
    quality.fit(docs, labels, sample=20)
    assert 30 < seen[0] < 130
