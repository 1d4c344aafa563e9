"""Chat formatting: escapes, masks and round trips."""

import random
from collections import defaultdict
from hashlib import sha256

import numpy as np

from chaffsieve.llm import chat

PIECES = [*chat.CONTROL, "<", "s>", "/", "[", "INST]", "\\", "SYS>>", "|endoftext|>", "a", " ", "\n", "é", "\U0001f642", "ok"]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def noise(rng, most=12):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


def want(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in held.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        every = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        out[conv] = (len(turns), sha256(every.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_escapes_come_back_and_leave_no_control_string():
    rng = random.Random(1)
    for _ in range(30_000):
        text = noise(rng)
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROL)


def test_mask_is_that_of_every_token_tried_on_every_span():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cuts = np.unique(rng.integers(0, 60, 20))
        starts, ends = cuts[:-1], cuts[1:]
        edges = np.unique(rng.choice(cuts, 6))
        spans = edges[: len(edges) // 2 * 2].reshape(-1, 2)
        mask = chat.loss_mask(starts, ends, spans)
        assert mask.tolist() == [any(a < e and s < b for a, b in spans) for s, e in zip(starts, ends)]


def test_round_trip(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool<s>"]
    rows = [(c, t, rng.choice(roles), noise(rng, 40)) for c in range(60) for t in range(rng.randint(1, 7))]
    for block in (chat.BLOCK, 50, 1):
        made = chat.format_conversations(spark.createDataFrame(rows, TURNS), block_chars=block)
        assert got(chat.read_back(made)) == want(rows)


def test_masked_tokens_are_the_assistant_texts_alone(spark):
    rows = [(1, 0, "user", "Tell  me"), (1, 1, "assistant", "  yes \n"), (1, 2, "user", "x"), (1, 3, "assistant", "")]
    (row,) = chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert row["formatted"] == "<s>user[INST]Tell  me[/INST]<s>assistant[INST]  yes \n[/INST]<s>user[INST]x[/INST]<s>assistant[INST][/INST]"
    said = [(a, b) for a, b, m in zip(row["token_starts"], row["token_ends"], row["loss"]) if m]
    assert "".join(row["formatted"][a:b] for a, b in said) == "  yes \n"


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (1, None, "assistant", "first"), (1, 5, "assistant", None), (1, 5, "assistant", "same turn"),
        (2, 0, "user", "twice"), (2, 0, "user", "twice"), (3, 0, "assistant", "y" * 300_000), (3, 1, "assistant", "z " * 200_000), (-1, 0, "", ""),
    ]
    from pyspark.sql import functions as F

    turns = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(0) for c in ("block", "formatted", "loss")})
    assert got(chat.read_back(chat.format_conversations(turns))) == want(rows)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).collect() == []


DIGEST_SQL = """
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256
FROM conversations GROUP BY conv_id
"""


def test_digests_equal_sql_on_the_given_conversations(spark):
    import os

    import duckdb
    import pytest

    path = "/root/testdata/sf0.01/conversations.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
    want = {r[0]: tuple(r[1:]) for r in con.execute(DIGEST_SQL).fetchall()}
    assert got(chat.read_back(chat.format_conversations(spark.read.parquet(path)))) == want
