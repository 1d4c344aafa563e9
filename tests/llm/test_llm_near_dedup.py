"""Near duplicates against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest

from chaffsieve.llm import near_dedup
from chaffsieve.llm.components import components
from chaffsieve.llm.near_dedup import Sketch, drop_near_copies, likely, near_groups, registers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def linked(a, b, percent):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


def smallest_reachable(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def brute(rows, plan):
    sets = {i: shingles(t, plan.words) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and linked(sets[a], sets[b], plan.percent)]
    root = smallest_reachable(ids, links)
    return {(i, len(sets[i]), root[i], root[i] == i) for i in ids}


def family(rng, size, length, edits):
    """Near copies of one text, copies of copies among them, so that links form chains."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    texts = [words]
    for _ in range(size - 1):
        copy = list(rng.choice(texts))
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(length)] = f"w{rng.randrange(10**6)}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("plan", [Sketch(3, 85), Sketch(5, 80)])
def test_components_are_those_of_all_pairs(documents, plan, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEFT_BLOCK", 4)
    monkeypatch.setattr(near_dedup, "RIGHT_BLOCK", 8)
    rng = random.Random(plan.words)
    texts = [t for n in range(12) for t in family(rng, 12, rng.choice([6, 40, 200]), 1 + n // 2)]
    texts += ["one", "one", "One", "two words", "Two  words", "", None, " \n"]
    texts += [t.upper() for t in texts[:20]] + texts[:10]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = near_groups(documents(rows), plan)
    assert {tuple(r) for r in found.collect()} == brute(rows, plan)


def test_odd_rows(odd_documents, no_documents):
    found = [tuple(r) for r in near_groups(odd_documents).collect()]
    rows = {(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()}
    want = brute([r for r in rows if r[0] is not None], Sketch())
    assert {f for f in found if f[0] is not None} == want
    assert [f for f in found if f[0] is None] == [(None, 0, None, True), (None, 3, None, True)] or sorted(
        f[1] for f in found if f[0] is None
    ) == [0, 3]
    assert len(found) == odd_documents.count()
    assert near_groups(no_documents).collect() == []
    kept = drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {r["doc_id"] for r in kept.collect()} == {None} | {i for i, _, _, k in want if k}


def test_sketches_merge_by_maximum():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64)) for _ in range(2))
    one, two, both = registers([a, b, np.union1d(a, b)], 64)
    assert (np.maximum(one, two) == both).all()
    assert (registers([np.empty(0, np.uint64)], 8) == 0).all()


def test_registers_agree_as_often_as_sets_overlap_and_the_likelihood_sees_it():
    rng = np.random.default_rng(2)
    for share, verdict in ((0.95, True), (0.85, True), (0.4, False), (0.1, False)):
        keep = []
        agreed = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 2000, dtype=np.uint64)
            common = round(2000 * share)
            rest = (2000 - common) // 2
            a, b = pool[: common + rest], np.concatenate([pool[:common], pool[common + rest :]])
            x, y = registers([np.unique(a), np.unique(b)], 120)
            equal, above = int((x == y).sum()), int((x > y).sum())
            agreed.append(equal / 120)
            n = np.array([float(len(a))]), np.array([float(len(b))])
            keep.append(
                bool(likely(np.array([equal]), np.array([above]), np.array([120 - equal - above]), *n, 0.85)[0])
            )
        assert abs(np.mean(agreed) - share) < 0.03
        assert all(keep) if verdict else not any(keep)


def test_bands_follow_from_the_threshold():
    for plan in (Sketch(3, 85), Sketch(5, 80), Sketch(5, 50), Sketch(1, 100)):
        chance = 1 - (plan.percent / 100) ** plan.rows
        assert chance**plan.bands <= near_dedup.MISS or plan.percent == 100
        assert plan.registers <= near_dedup.REGISTERS


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)]
    links += [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(links)
    nodes = {n for link in links for n in link}
    root = smallest_reachable(nodes, links)
    found = components(spark.createDataFrame([*links, (7, 7), (None, 3)], "a bigint, b bigint")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(n, r) for n, r in root.items() if n != r}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
