"""Language: Viterbi against plain dynamic programming, held-out accuracy, mixed texts."""

import os
from zlib import crc32

import numpy as np
import pytest

from chaffsieve.llm import language
from chaffsieve.llm.tables import table

BASE = "/root/testdata/sf0.01"


def best_value(scores, switch):
    value = scores[0].copy()
    for row in scores[1:]:
        value = row + np.maximum(value, value.max() - switch)
    return value.max()


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 63, 64, 65, 130, 700, 0, 3]
    first = np.concatenate(([0], np.cumsum(sizes)))
    for states in (1, 2, 5):
        scores = rng.normal(0, 4, (first[-1], states))
        got = language.viterbi(scores, first, 5.0)
        for a, b in zip(first[:-1], first[1:]):
            if a < b:
                path = got[a:b]
                value = scores[np.arange(a, b), path].sum() - 5.0 * (np.diff(path) != 0).sum()
                assert abs(value - best_value(scores[a:b], 5.0)) < 1e-6


@pytest.fixture(scope="module")
def model(spark):
    if not os.path.isdir(BASE):
        pytest.skip("no test data")
    return language.fit(table(spark, BASE, "documents"))


def test_held_out_accuracy(spark, model):
    docs = table(spark, BASE, "documents")
    found = docs.select("doc_id", "lang").join(language.detect(docs, model), "doc_id").collect()
    held = [r for r in found if crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_spans_of_a_mixed_text(spark, model, documents):
    parts = {
        r["lang"]: r["text"]
        for r in table(spark, BASE, "documents").filter("n_chars BETWEEN 800 AND 3000").collect()
        if "$$$" not in r["text"]
    }
    text = f"{parts['en']} {parts['de']} {parts['fr']}"
    (row,) = language.detect(documents([(1, text)]), model).collect()
    long = [s for s in row["spans"] if s["end"] - s["start"] > 200]
    assert [s["lang"] for s in long] == ["en", "de", "fr"]
    assert abs(long[1]["start"] - len(parts["en"]) - 1) < 60
    assert all(a["end"] <= b["start"] for a, b in zip(row["spans"], row["spans"][1:]))
    assert 0.25 < row["score"] < 0.95


def test_script_narrows_the_candidates(documents):
    russian = "все люди рождаются свободными и равными в своём достоинстве"
    rows = [(i, f"the people are born free and equal number {i}", "en", "s") for i in range(40)]
    rows += [(100 + i, f"{russian} {i}", "ru", "s") for i in range(40)]
    model = language.fit(documents(rows))
    assert model.languages == ["en", "ru"] and len(set(model.scripts.tolist())) == 2
    got = {r["doc_id"]: r for r in language.detect(documents([(1, "Неизвестное слово"), (2, "wholly unseen"), (3, "12, 34. «»")]), model).collect()}
    assert (got[1]["lang_pred"], got[2]["lang_pred"], got[3]["lang_pred"]) == ("ru", "en", "und")


def test_odd_rows(model, odd_documents, no_documents):
    found = language.detect(odd_documents, model).collect()
    assert len(found) == odd_documents.count()
    for r in found:
        assert 0 <= r["score"] <= 1
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert {1, 2, 7, 8} <= und
    assert language.detect(no_documents, model).collect() == []


def test_nothing_to_learn_from(no_documents, odd_documents, documents):
    model = language.fit(no_documents)
    assert model.languages == []
    assert {r["lang_pred"] for r in language.detect(odd_documents, model).collect()} == {"und"}
    unlabelled = documents([(1, "some text", None, "s"), (2, "", None, "s")])
    assert language.drop_unknown_languages(unlabelled).count() == 2
    assert language.drop_unknown_languages(no_documents).collect() == []


def test_stage_drops_texts_without_letters(odd_documents):
    kept = language.drop_unknown_languages(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {1, 2, 7, 8} & set(ids)
    assert ids.count(5) == 2 and {4, 6, 9} <= set(ids)


def test_long_texts_are_labelled_piece_by_piece_as_if_whole(spark, model, monkeypatch):
    import pyarrow as pa

    texts = [r["text"] for r in table(spark, BASE, "documents").filter("n_chars < 6000").limit(60).collect()]
    texts = [f"{a} {b}" for a, b in zip(texts[::2], texts[1::2])] + ["", None, "12 ?!", "  two  words ", "日本 語 " * 50]
    whole = language.label(pa.array(texts, pa.string()), model)
    for piece in (40, 700, 5000):
        monkeypatch.setattr(language, "PIECE", piece)
        assert language.label(pa.array(texts, pa.string()), model) == whole
    monkeypatch.setattr(language, "PIECE", 64)
    (names, _, _) = language.label(pa.array(["é" * 1000 + " ends here"]), model)
    assert names[0] in model.languages


def test_rows_without_an_id_are_judged_by_their_own_text(documents):
    rows = [(None, "12 34 !!", "en", "s"), (None, "some words of a text", "en", "s"), (1, "more words here", "en", "s")]
    kept = language.drop_unknown_languages(documents(rows)).collect()
    assert sorted(r["text"] for r in kept) == ["more words here", "some words of a text"]


def test_memory_of_a_long_text_is_bounded_by_its_pieces():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(0)
    k = 40
    slots = (1 << language.GRAM_BITS, 1 << language.WORD_BITS)
    made = [rng.normal(size=(n, k)).astype(np.float32) for n in slots]
    model = language.Model([f"l{i:02}" for i in range(k)], *made, np.full(k, 2, np.int64))
    text = " ".join(f"word{i % 5000}" for i in range(700_000))  # 6 MB
    tracemalloc.start()
    language.label(pa.array([text]), model)
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
