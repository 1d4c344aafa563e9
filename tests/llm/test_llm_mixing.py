"""Mixing: targets by water filling, and what the stream holds."""

import re
from collections import Counter

from chaffsieve.llm.mixing import mix, mixed_stream

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, cap):
    """Reshare the excess of capped sources until none is above its cap."""
    target, fixed = {}, set()
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[s] for s in fixed)
        open_ = [s for s in sizes if s not in fixed]
        target = {s: cap * sizes[s] for s in fixed}
        target |= {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        above = {s for s in open_ if target[s] >= cap * sizes[s]}
        if not above:
            return target
        fixed |= above
        if fixed == set(sizes):
            return {s: cap * sizes[s] for s in sizes}


def corpus(documents):
    rows = []
    for s, (n, words) in {"a": (9, 3), "b": (40, 17), "c": (200, 5), None: (6, 11)}.items():
        first = len(rows)
        rows += [(first + i, " \n".join(["w"] * (words + i % 4)), "en", s) for i in range(n)]
    return documents(rows), rows


def test_targets_and_taken_words(documents):
    docs, rows = corpus(documents)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t))
    want = fill(sizes, {"a": 5, "b": 2, "c": 1, None: 5}, 3)
    taken, seen = Counter(), {}
    for r in mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect():
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        seen[r["doc_id"]] = r["taken"]
    assert len(seen) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = {r["doc_id"]: r["taken"] for r in mix(docs.repartition(7)).select("row.doc_id", "taken").collect()}
    assert again == seen


def test_stream_holds_what_the_mix_takes_and_keeps_its_shares_throughout(documents):
    docs, rows = corpus(documents)
    taken = {r["doc_id"]: r["taken"] for r in mix(docs).select("row.doc_id", "taken").collect()}
    stream = mixed_stream(docs)
    assert stream.columns == docs.columns
    rows = stream.collect()
    words = Counter()
    for r in rows:
        assert len(r["text"]) == r["n_chars"]
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert dict(words) == {i: t for i, t in taken.items() if t}
    # Half of the stream has about half of every larger source.
    half, so_far, part = sum(words.values()) / 2, 0, Counter()
    for r in rows:
        n = len(WORD.findall(r["text"]))
        so_far += n
        if so_far <= half:
            part[r["source"]] += n
    total = Counter()
    for r in rows:
        total[r["source"]] += len(WORD.findall(r["text"]))
    assert abs(part["b"] / total["b"] - 0.5) < 0.1 and abs(part["c"] / total["c"] - 0.5) < 0.1


def test_odd_rows(odd_documents, no_documents, documents):
    found = mix(odd_documents)
    rows = found.select("row.doc_id", "size", "taken").collect()
    assert len(rows) == odd_documents.count()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) > 0
    assert mixed_stream(odd_documents).columns == odd_documents.columns
    assert mixed_stream(odd_documents).filter("text IS NULL OR text = ''").count() == 0
    assert mix(no_documents).collect() == [] and mixed_stream(no_documents).collect() == []
    empty = documents([(1, "", "en", "a"), (2, None, "en", "b")])
    assert {(r["target"], r["taken"]) for r in mix(empty).collect()} == {(0.0, 0)}
