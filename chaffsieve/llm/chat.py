"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole and encoded once.  The tokenizer reports the
characters of every token, and the sorted spans of the assistant's texts are
laid over the sorted token spans by binary search.  A turn is

    <s>role[INST]text[/INST]

and the three marks are tokens of their own, so no token reaches across the
edge of a text.  A control string inside a text gets a backslash after its
first character, one that has backslashes there one more, so every text comes
back exactly.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import small_batches
from chaffsieve.llm.tokens import vocabulary_paths

BEGIN, TEXT, END = "<s>", "[INST]", "[/INST]"
# Strings that mean something to a template or a tokenizer.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
# Characters encoded at once: a longer conversation is cut between turns.
BLOCK = 1 << 17
ASSISTANT = "assistant"

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_TAILS})")
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]", re.S)

SCHEMA = (
    "conv_id bigint, block bigint, formatted string, token_ids array<int>, "
    "token_starts array<int>, token_ends array<int>, loss array<boolean>"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


@cache
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
    made = Tokenizer.from_file(path)
    made.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (BEGIN, TEXT, END)])
    return made


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the sorted, disjoint ``spans`` ([n, 2] code points)."""
    first = np.searchsorted(ends, spans[:, 0], "right")
    last = np.maximum(np.searchsorted(starts, spans[:, 1], "left"), first)
    turn = np.zeros(len(starts) + 1, np.int64)
    np.add.at(turn, first, 1)
    np.add.at(turn, last, -1)
    return np.cumsum(turn[:-1]) > 0


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The text of some turns, and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def format_conversations(
    conversations: DataFrame, vocabulary: str | None = None, block_chars: int = BLOCK
) -> DataFrame:
    """Rows (conv_id, block, formatted, token_ids, token_starts, token_ends, loss).

    Turns are ordered by turn, then role and text where turns repeat; a NULL
    turn comes first, a NULL role or text is empty, a NULL conv_id is a
    conversation of its own.  A conversation is one block unless it is longer
    than ``block_chars``; then blocks, cut between turns, follow each other
    within one partition, and no task holds more than a block and a turn.  An
    empty table gives no rows; other columns are ignored.
    """
    small_batches(conversations.sparkSession)
    path = vocabulary or vocabulary_paths()[0]
    order = ["conv_id", "turn", "role", "text"]
    turns = conversations.select(
        F.col("conv_id").cast("bigint"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path).encode

        def out(conv, block, held):
            text, spans = render(held)
            found = encode(text, add_special_tokens=False)
            offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
            mask = loss_mask(offsets[:, 0], offsets[:, 1], spans)
            return pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array([conv], pa.int64()),
                    "block": pa.array([block], pa.int64()),
                    "formatted": pa.array([text], pa.string()),
                    "token_ids": pa.array([found.ids], pa.list_(pa.int32())),
                    "token_starts": pa.array([offsets[:, 0]], pa.list_(pa.int32())),
                    "token_ends": pa.array([offsets[:, 1]], pa.list_(pa.int32())),
                    "loss": pa.array([mask], pa.list_(pa.bool_())),
                }
            )

        conv, block, held, size = None, 0, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for here, role, text in zip(*columns):
                if held and (here != conv or size + len(text) > block_chars):
                    yield out(conv, block, held)
                    block = block + 1 if here == conv else 0
                    held, size = [], 0
                elif here != conv:
                    block = 0
                conv = here
                held.append((role, text))
                size += len(text)
        if held:
            yield out(conv, block, held)

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(run, SCHEMA)
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its blocks say, in their order: see ``op6``.

    Turns are parsed out of the formatted text; the loss text is what lies
    under masked tokens, each run of them unescaped by itself.  Digests are
    fed block by block.
    """

    def loss_texts(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> Iterator[str]:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
        for a, b in zip(edges[::2], edges[1::2]):
            # Tokens of one character's bytes share its offsets: the run is their union.
            yield unescape(text[starts[a:b].min() : ends[a:b].max()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def out():
            conv, turns, all_turns, chars, loss, length = state
            return pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array([conv], pa.int64()),
                    "n_turns": pa.array([turns], pa.int64()),
                    "turns_sha256": pa.array([all_turns.hexdigest()]),
                    "loss_chars": pa.array([chars], pa.int64()),
                    "loss_sha256": pa.array([loss.hexdigest()]),
                    "formatted_chars": pa.array([length], pa.int64()),
                }
            )

        for batch in batches:
            for i in range(batch.num_rows):
                conv, block, text = (batch.column(c)[i].as_py() for c in ("conv_id", "block", "formatted"))
                starts, ends, mask = (
                    np.asarray(batch.column(c)[i].values) for c in ("token_starts", "token_ends", "loss")
                ) if len(batch.column("loss")[i]) else (np.empty(0, np.int32),) * 3
                if block == 0:
                    if state:
                        yield out()
                    state = [conv, 0, sha256(), 0, sha256(), 0]
                for role, body in _TURN.findall(text):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                for part in loss_texts(text, starts, ends, mask):
                    state[3] += len(part)
                    state[4].update(part.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
        if state:
            yield out()

    return formatted.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
