"""The prefix trie against tuples in plain Python."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from chaffsieve.llm.prefix_trie import end_digests, end_lists, last_turns, prefix_trie, rebuild, trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, group=5, heads=9):
    """conv_id -> rebuilt tuple of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows, **how):
    rebuilt = plain(rows, **how)
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    nodes = sorted(members, key=len)
    children = defaultdict(int)
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in nodes:
        size = len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members[n]) - 1) * size
    out = set()
    for n in nodes:
        ends = sorted(c for c in members[n] if rebuilt[c] == n)
        out.add(
            (
                min(members[n]),
                len(n),
                min(members[n[:-1]]) if n else None,
                len(members[n]),
                children[n],
                leaves[n],
                saved[n],
                sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, n, span=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.randint(-7, span)
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn * 3, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "long text"])))
    kept = {(r[0], r[1]): r for r in rows}  # one row per turn
    return list(kept.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_are_those_of_plain_tuples(spark, seed):
    rows = random_rows(seed, 60)
    assert got(trie(spark.createDataFrame(rows, TURNS).repartition(4))) == brute(rows)


def test_blocks_carry_their_prefixes(spark):
    rows = [(c, t, "user", f"t{t if t < 30 + c else c}") for c in (0, 1, 2, 10) for t in range(60)]
    members, turns = rebuild(spark.createDataFrame(rows, TURNS), group=1, heads=1)
    nodes, _ = prefix_trie(members, turns, block=7)
    want = {r[:7] for r in brute(rows, group=1, heads=1)}
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    assert got(nodes.select(*columns)) == want


def test_common_conversation_and_chunked_ends(spark):
    rows = [(c, t, "user", "the same") for c in range(0, 3000, 5) for t in range(2)]
    rows += [(c, 0, "user", f"own {c}") for c in range(3000, 3100, 5)]
    members, turns = rebuild(spark.createDataFrame(rows, TURNS))
    _, ends = prefix_trie(members, turns)
    chunks = end_lists(ends, chunk=17)
    assert chunks.count() > 600 // 17
    found = {r["ends_sha256"] for r in end_digests(chunks).collect()}
    assert found == {r[-1] for r in brute(rows)} - {sha256(b"").hexdigest()}


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (5, None, None, None),
        (5, None, None, None),
        (5, 2, "user", None),
        (5, 2, "assistant", ""),
        (6, 1, "user", "x" * 300_000),
        (7, 0, "", "userx"),
        (9, 0, "user", "x"),
        (-4, 0, "user", "x"),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'other' AS depth", "'k' AS key1", "1 AS at", "2 AS length")
    assert got(trie(df)) == brute(rows)
    assert trie(df.limit(0)).collect() == []
    assert trie(df.filter("conv_id IS NULL")).collect() == []


def test_turnless_conversations_end_at_the_root(spark):
    # Short conversations lose all their turns where nothing precedes them.
    rows = [(c, 0, "user", "x") for c in range(1, 400, 5)]
    want = brute(rows)
    assert any(r[1] == 0 and r[-1] != sha256(b"").hexdigest() for r in want)
    assert got(trie(spark.createDataFrame(rows, TURNS))) == want


def test_last_turns_point_at_the_table(spark):
    rows = random_rows(3, 30)
    members, turns = rebuild(spark.createDataFrame(rows, TURNS))
    nodes, _ = prefix_trie(members, turns)
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows):
        own[conv].append((role, text))
    rebuilt = plain(rows)
    for r in last_turns(nodes, turns).collect():
        if r["depth"]:
            assert own[r["from_conv"]][r["from_place"] - 1] == rebuilt[r["conv_id"]][r["depth"] - 1]
