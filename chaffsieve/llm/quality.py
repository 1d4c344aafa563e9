"""Document quality from supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of words are
hashed to rows of one embedding table.  A document is the mean of its rows; a
softmax layer on it gives the class.  Table and layer are trained together by
stochastic gradient descent in numpy, one document a step.  Once trained, the
layer is folded into the table: a feature then has one number, and a score is
a mean of numbers, whatever the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import meet, remainder, small_batches, whole_text
from chaffsieve.llm.text64 import byte_values, finalise, hash_words, utf8, word_bounds
from chaffsieve.sources.staging import stage

# Labelled documents per class the classifier is trained on, about; beyond it a
# part picked by hash.
SAMPLE = 1_500
BUCKET_BITS = 17
DIMS = 8
GRAMS = (3, 4, 5)  # characters, word ends included
SAMPLE_BYTES = 256 << 20  # of feature counts of the sample, about
EPOCHS = 8
RATE = 2.0
SEED = 7
PIECE = 1 << 19  # bytes of text whose features are held at once


def _characters(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number that stands for each character, where it begins); all outside words is blank."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    values = byte_values(True)[np.where(inside, data, 32)]
    lengths = np.diff(np.append(begins, len(data)))
    out = values[begins]
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        out[longer] = out[longer] * np.uint64(0xC2B2AE3D27D4EB4F) + values[begins[longer] + k]
    return out, begins


def _feature_slots(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, lead: int = 0
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slot, position of the feature in the bytes) per kind of feature.

    The first ``lead`` words only make a pair with the next.
    """
    shift = np.uint64(64 - BUCKET_BITS)
    words = hash_words(data, starts, ends)
    # A word repeated at once is one pair, whichever word it is.
    pairs = words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:]
    pairs = np.where(words[:-1] == words[1:], np.uint64(0x5851F42D4C957F2D), pairs)
    near = owner[:-1] == owner[1:]
    kinds = [(words[lead:] >> shift, starts[lead:]), (finalise(pairs[near]) >> shift, starts[1:][near])]
    # Characters of the words with one space before and after each; grams never pass them.
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    inside = np.cumsum(mark[:-1]) > 0
    values, begins = _characters(data, inside)
    blank = np.concatenate(([0], np.cumsum(~inside[begins])))
    first = starts[lead] - 1 if lead < len(starts) else len(data)
    hashed = np.zeros(len(values), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if n > len(values):
            break
        hashed = hashed[: len(values) - n + 1] * np.uint64(0xD1342543DE82EF95) + values[n - 1 :]
        if n in GRAMS:
            # Blanks may only be the first and the last character.
            at = np.arange(len(hashed))
            whole = (blank[at + n - 1] == blank[at + 1]) & (begins[at] >= first)
            kinds.append((finalise(hashed[whole] + np.uint64(n)) >> shift, begins[at[whole]]))
    return kinds


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, document numbers) of a string column, some PIECE bytes at a time.

    A piece is whole documents, or a part of one long document that begins and
    ends with a word and takes the word before it along for their pair.  What
    a document gives does not depend on its neighbours.
    """
    text = column.cast(pa.large_string()).fill_null("")
    blank = pa.scalar("", pa.large_string())
    data, offsets = utf8(
        pc.binary_join_element_wise(blank, text, blank, pa.scalar(" ", pa.large_string()))
    )
    starts, ends, first = word_bounds(data, offsets)
    owner = np.repeat(np.arange(len(column)), np.diff(first))
    pieces, doc = [], 0
    while doc < len(column):
        stop = max(doc + 1, int(np.searchsorted(offsets, offsets[doc] + PIECE, "right")) - 1)
        a, last = int(first[doc]), int(first[stop])
        while a < last:
            b = last
            if offsets[stop] - offsets[doc] > PIECE:
                b = min(last, max(a + 1, int(np.searchsorted(ends, starts[a] + PIECE, "right"))))
            pieces.append((a, b, int(a > first[doc])))
            a = b
        doc = stop
    for a, b, lead in pieces:
        a -= lead
        lo, hi = starts[a] - 1, ends[b - 1] + 1
        for slots, where in _feature_slots(data[lo:hi], starts[a:b] - lo, ends[a:b] - lo, owner[a:b], lead):
            yield slots.astype(np.int64), np.searchsorted(offsets, where + lo, "right") - 1


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of label 1 against label 0, per slot
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for slots, docs in features(column):
            total += np.bincount(docs, self.weights[slots], len(column))
            count += np.bincount(docs, minlength=len(column))
        margin = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def learn(
    documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table, layer, bias) by SGD over (slots, counts) of each document; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMS, 1 / DIMS, (1 << BUCKET_BITS, DIMS))
    layer, bias = np.zeros((2, DIMS)), np.zeros(2)
    weigh = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    steps = EPOCHS * len(labels)
    for step, i in enumerate(
        np.concatenate([rng.permutation(len(labels)) for _ in range(EPOCHS)]) if steps else []
    ):
        slots, counts = documents[i]
        if not len(slots):
            continue
        share = counts / counts.sum()
        hidden = share @ table[slots]
        logits = layer @ hidden + bias
        error = np.exp(logits - logits.max())
        error /= error.sum()
        error[labels[i]] -= 1
        rate = RATE * weigh[labels[i]] * (1 - step / steps)
        gradient = error @ layer
        layer -= rate * np.outer(error, hidden)
        bias -= rate * 0.1 * error
        table[slots] -= rate * share[:, None] * gradient
    return table, layer, bias


def fold(table: np.ndarray, layer: np.ndarray, bias: np.ndarray) -> Model:
    """One number per slot: the mean of these is the margin that the mean vector gives."""
    return Model((table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED) -> Model:
    return fold(*learn(documents, labels, seed))


def _drawn(*columns: str):
    """A number in [0, 1) by hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 4).cast("double") / float(1 << 60)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on labelled documents outside the held-out fold, about ``sample`` per class.

    The sample is picked from ids and labels alone.  Its documents are turned
    into feature counts in tasks, and equal ones of one id count once.  At most
    about 4 * ``sample`` of them, of SAMPLE_BYTES, reach the driver.  An id
    labelled both ways counts as good.
    """
    small_batches(docs.sparkSession)
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(remainder("doc_id", 5) != 0)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max("quality").alias("quality")
    )
    known = stage(known, "quality-labels")
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("quality") == label, F.lit(sample / size)).otherwise(share)
    picked = known.filter(_drawn("id") < share)
    picked = stage(picked, "quality-sample")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                counts = np.zeros(1 << BUCKET_BITS, np.int64)
                for slots, _ in features(batch.column("text").slice(k, 1)):
                    counts += np.bincount(slots, minlength=1 << BUCKET_BITS)
                used = np.flatnonzero(counts).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(k, 1),
                        batch.column("quality").slice(k, 1),
                        pa.array([used.tobytes()], pa.binary()),
                        pa.array([counts[used].astype(np.int32).tobytes()], pa.binary()),
                    ],
                    names=["id", "quality", "slots", "counts"],
                )

    rows = meet(texts, picked, ["id"]).mapInArrow(
        run, "id bigint, quality int, slots binary, counts binary"
    )
    rows = stage(rows.dropDuplicates(["id", "slots", "counts"]), "quality-features")
    held = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("slots")).alias("bytes")).first()
    # An id may stand for many texts, so what was drawn by ids is cut once more.
    kept = min(1.0, 4 * sample / max(held["n"], 1), SAMPLE_BYTES / max(2 * (held["bytes"] or 0), 1))
    # The order of training is part of the result.
    rows = sorted(
        rows.filter(_drawn("id", "slots") < kept).collect(), key=lambda r: (r["id"], r["slots"], r["counts"])
    )
    documents = [
        (np.frombuffer(r["slots"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in rows
    ]
    return train(documents, np.array([r["quality"] for r in rows], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row: the probability of quality label 1.

    A text without words (empty, blank or NULL) gets what the bias alone says,
    one half without any training.  Rows are scored one by one, so repeats
    agree; an empty table gives no rows; other columns are never looked at.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, score double"
    )
