"""Personal data: base spans against the plain patterns, labelers and EM."""

import random
import re
from hashlib import sha256

import numpy as np

from chaffsieve.llm import pii


def plain(text):
    """The patterns as they are written, tried at every start."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(1)
    for letters, most in (("ab0159. -@+()%_é", 40), ("0123 -", 60), ("12. ", 30), ("a@.b+", 25)):
        for _ in range(8000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
            assert pii.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    text = "1" * 200_000 + "a" * 300_000 + "@" + "5." * 100_000 + "+1" + " " * 200_000 + "(at)" * 20_000 + "dot"
    pii._found(text)


def test_em_finds_out_whom_to_trust():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.6
    good, fair = 0.95, 0.7
    said = []
    for right, chance in zip((truth,) * 3, (good, fair, fair)):
        agrees = rng.random(4000) < chance
        said.append(np.where(agrees == right, pii.YES, pii.NO))
    votes = np.column_stack([np.full(4000, pii.ABSTAIN), *said])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, table, likely = pii.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.6) < 0.1
    assert table[1, 1, pii.YES] > table[2, 1, pii.YES] > 0.5
    where = {tuple(p): x for p, x in zip(patterns, likely)}
    hit = np.array([where[tuple(v)] > 0.5 for v in votes]) == truth
    assert hit.mean() > 0.93


CARD, WRONG = "4111 1111 1111 1111", "4111 1111 1111 1112"


def corpus():
    rows = []
    for i in range(80):
        rows.append((10 * i, f"call us on +1 (415) 555-{1000 + i} or write to user{i}@mail{i}.example.com today"))
        rows.append((10 * i + 1, f"server address 10.2.{i}.{i + 1} answered, card {CARD} was paid"))
        rows.append((10 * i + 2, f"order {WRONG} came on day {i} in version 300.400.500.{i}"))
        rows.append((10 * i + 3, f"nothing to see on page {i}, 12 of 34 chairs were taken"))
    return rows


def test_spans_counts_and_digest(documents):
    extra = "phone (415) 555-2671 or mail jane (at) example (dot) com"
    rows = [*corpus(), (9000, extra)]
    found = {r["doc_id"]: r for r in pii.find(documents(rows)).collect()}
    for i, text in rows:
        base, row = plain(text), found[i]
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row["base_sha256"] == sha256(joined.encode()).hexdigest()
        counts = [row[f"n_{k}"] for k in pii.KINDS]
        assert counts == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    # A checksum that fails is no card, and pages without data stay clean.
    assert all(found[10 * i + 2]["spans"] == "" and found[10 * i + 3]["spans"] == "" for i in range(80))
    spans = {tuple(s.split(":")) for s in found[9000]["spans"].split(",")}
    at = extra.index("(415)")
    assert ("phone", str(at), str(at + 14)) in spans
    assert found[9000]["added"] == len(spans)


def test_odd_rows(odd_documents, no_documents):
    found = pii.find(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert {r["spans"] for r in found} == {""}
    assert {r["base_sha256"] for r in found} == {sha256(b"").hexdigest()}
    assert pii.find(no_documents).collect() == []
