"""Exact dedup against grouping by text."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from chaffsieve.llm.exact_dedup import Fingerprint, drop_exact_copies, exact_groups


def brute(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    out = Counter()
    for t, ids in texts.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        kept = False
        for i in sorted(ids, key=lambda i: -1 if i is None else i):
            first = i == keep and not kept
            kept |= first
            out[i, keep, len(ids), first, sha256(t.encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_chunk_hashes_combine_to_the_hash_of_the_whole():
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = Fingerprint(chunk=8192).of_chunk(data)
    for chunk in (1, 7, 4096):
        assert Fingerprint(chunk=chunk).of(data) == whole
    maker = Fingerprint()
    parts = [maker.of_chunk(data[a:b]) for a, b in ((0, 10), (10, 3000), (3000, 5000))]
    left = maker.combine(maker.combine(parts[0], parts[1]), parts[2])
    right = maker.combine(parts[0], maker.combine(parts[1], parts[2]))
    assert left == right == whole


@pytest.mark.parametrize("primes", [(2147483647, 2147483629), (3, 2)])
def test_groups_are_those_of_equal_texts_even_if_fingerprints_collide(documents, primes):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(60)]
    rows = [(i, rng.choice([*texts, None])) for i in range(200)]
    assert got(exact_groups(documents(rows), primes=primes, chunk=2, block=3)) == brute(rows)


def test_difference_in_a_late_chunk_counts(documents):
    rows = [(1, "a" * 100 + "b"), (2, "a" * 100 + "c"), (3, "a" * 101), (4, "a" * 100 + "b")]
    assert got(exact_groups(documents(rows), primes=(2, 2), chunk=16)) == brute(rows)


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert got(exact_groups(odd_documents)) == brute(rows)
    assert exact_groups(no_documents).collect() == []


def test_same_id_with_different_texts(documents):
    rows = [(1, "a"), (1, "b"), (2, "a")]
    assert got(exact_groups(documents(rows))) == brute(rows)


def test_stage_keeps_one_row_per_text_and_all_columns(odd_documents, no_documents):
    kept = drop_exact_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    rows = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert len(rows) == len({t for _, t in rows})
    assert dict((t, i) for i, t in rows)["the same words twice over here"] == 6
    assert drop_exact_copies(no_documents).collect() == []


def test_very_many_rows_of_one_id_are_counted_out_in_runs(documents, monkeypatch):
    from chaffsieve.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "RUN", 7)
    rows = [(None, "same")] * 50 + [(1, "same"), (1, "other"), (2, "same")]
    assert got(exact_groups(documents(rows), block=3)) == brute(rows)
