"""Exact duplicates by composable polynomial fingerprints.

Chunks of a text are hashed on their own, and the hash of a text is put
together from those of its chunks: H(ab) = H(a) * B**len(b) + H(b) modulo a
prime.  Chunks can thus be hashed in any order and in parallel, and a text of
any length needs memory for one chunk.  Two primes below 2**31 and the length
make the fingerprint.  Rows with equal fingerprints are compared chunk by
chunk with one row of their group, so a collision never merges two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.llm.tables import meet, small_batches, whole_text
from chaffsieve.llm.text64 import utf8
from chaffsieve.sources.staging import stage

RUN = 4096  # how many copies of a row one array counts out
CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1566083941)
# Rows compared with one copy of their group's chunk; more rows get further copies.
BLOCK = 512
# Stands for a NULL doc_id.
NO_ID = -(2**63)
MARK = ["h1", "h2", "n_bytes"]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**(n-1), ..., base, 1 modulo prime."""
    out = np.empty(n, np.uint64)
    value = 1
    for i in range(n - 1, -1, -1):
        out[i] = value
        value = value * base % prime
    return out


class Fingerprint:
    """Hash chunks and combine them: ``combine(hash(a), hash(b)) == hash(a + b)``."""

    def __init__(self, primes=PRIMES, bases=BASES, chunk: int = CHUNK):
        self.primes, self.bases, self.chunk = primes, bases, chunk
        self.powers = [_powers(b, p, chunk) for b, p in zip(bases, primes)]

    def of_chunk(self, data: np.ndarray) -> tuple[int, int, int]:
        """(h1, h2, bytes).  Bytes count from 1, a product is below 2**40, a sum below 2**56."""
        wide = data.astype(np.uint64) + np.uint64(1)
        n = len(wide)
        one, two = (
            int(np.dot(wide, powers[self.chunk - n :])) % prime
            for powers, prime in zip(self.powers, self.primes)
        )
        return one, two, n

    def combine(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
        shifted = [
            (x * pow(base, b[2], prime) + y) % prime
            for x, y, base, prime in zip(a, b, self.bases, self.primes)
        ]
        return shifted[0], shifted[1], a[2] + b[2]

    def of(self, data: np.ndarray) -> tuple[int, int, int]:
        whole = (0, 0, 0)
        for at in range(0, len(data), self.chunk):
            whole = self.combine(whole, self.of_chunk(data[at : at + self.chunk]))
        return whole


def _texts(docs: DataFrame) -> DataFrame:
    """(id, sha, text); the pair tells rows apart that share a doc_id but not a text."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        whole_text().alias("text"),
    )
    return rows.select("id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text")


def fingerprints(docs: DataFrame, primes=PRIMES) -> DataFrame:
    """(id, sha, h1, h2, n_bytes) of every row; no text leaves its scan task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprint(primes)
        for batch in batches:
            data, at = utf8(batch.column("text"))
            found = [maker.of(data[a:b]) for a, b in zip(at[:-1], at[1:])]
            marks = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("sha"), *map(pa.array, marks.T)],
                names=["id", "sha", *MARK],
            )

    return _texts(docs).mapInArrow(
        run, "id bigint, sha string, h1 bigint, h2 bigint, n_bytes bigint"
    )


def _chunks(texts: DataFrame, chunk: int) -> DataFrame:
    """(id, sha, chunk_no, body): texts as rows of at most ``chunk`` bytes; an empty one is one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            ids, shas = batch.column("id").to_pylist(), batch.column("sha").to_pylist()
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                cuts = list(range(a, b, chunk)) or [a]
                # A few chunks per batch: a huge text streams through.
                for k in range(0, len(cuts), 64):
                    some = cuts[k : k + 64]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "id": pa.array([ids[i]] * len(some), pa.int64()),
                            "sha": pa.array([shas[i]] * len(some), pa.string()),
                            "chunk_no": pa.array(range(k, k + len(some)), pa.int64()),
                            "body": pa.array(
                                [data[c : min(c + chunk, b)].tobytes() for c in some], pa.binary()
                            ),
                        }
                    )

    return texts.mapInArrow(run, "id bigint, sha string, chunk_no bigint, body binary")


def _counted_out(rows: DataFrame, n: str, name: str) -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``name``; by runs, so that no array is long."""
    zero, run = F.lit(0).cast("bigint"), F.lit(RUN).cast("bigint")
    runs = rows.withColumn("__run", F.explode(F.sequence(zero, F.floor((F.col(n) - 1) / RUN))))
    first = F.col("__run") * run
    last = F.least(first + run, F.col(n).cast("bigint")) - 1
    return runs.withColumn(name, F.explode(F.sequence(first, last))).drop("__run")


def _same_text(docs: DataFrame, pairs: DataFrame, chunk: int) -> DataFrame:
    """Of ``pairs`` (id, sha, lead_id, lead_sha, salt), those (id, sha) whose text is that of the lead.

    Each chunk of a member meets one chunk of its lead.  A lead is written
    once per salt, so a group of any size is spread over many tasks.
    """
    leads = stage(
        pairs.groupBy(F.col("lead_id").alias("id"), F.col("lead_sha").alias("sha")).agg(
            (F.max("salt") + 1).alias("salts")
        ),
        "leads",
    )
    texts = _texts(docs)
    members = _chunks(meet(texts, pairs.select("id", "sha"), ["id", "sha"], "left_semi"), chunk)
    members = meet(members, pairs, ["id", "sha"])
    bodies = _chunks(meet(texts, leads.select("id", "sha"), ["id", "sha"], "left_semi"), chunk)
    # Repeats of a lead are one and the same text.
    bodies = _counted_out(meet(bodies, leads, ["id", "sha"]), "salts", "salt").select(
        F.col("id").alias("lead_id"),
        F.col("sha").alias("lead_sha"),
        "chunk_no",
        "salt",
        F.col("body").alias("lead_body"),
    )
    met = members.join(bodies.hint("merge"), ["lead_id", "lead_sha", "salt", "chunk_no"], "left")
    same = F.coalesce(F.col("body") == F.col("lead_body"), F.lit(False))
    return met.groupBy("id", "sha").agg(F.min(same).alias("same"))


def exact_groups(
    docs: DataFrame, primes=PRIMES, chunk: int = CHUNK, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; NULL counts as empty.  Of equal
    texts the row with the largest doc_id stays; a NULL doc_id is smaller than
    any other.  Rows repeated under one doc_id are each counted and returned:
    with one text the first stays, with different texts each belongs to the
    group of its own.  An empty table gives no rows; other columns are ignored.

    Every pass of the loop settles the texts equal to the leads of their
    groups; what is left shares a fingerprint by chance and is grouped anew.
    With the default primes one pass is all that is ever seen.
    """
    rows = fingerprints(docs, primes).groupBy("id", "sha", *MARK).agg(F.count("*").alias("n"))
    todo = stage(rows, "fingerprints")
    settled: list[DataFrame] = []
    while True:
        sizes = todo.groupBy(*MARK).agg(
            F.max(F.struct("id", "sha")).alias("lead"), F.count("*").alias("members")
        )
        shared = stage(sizes.filter("members > 1"), "shared-fingerprints")
        grouped = meet(todo, shared, MARK, "left").select(
            "id",
            "sha",
            *MARK,
            "n",
            F.coalesce("lead.id", "id").alias("lead_id"),
            F.coalesce("lead.sha", "sha").alias("lead_sha"),
            F.pmod(F.xxhash64("id", "sha"), F.ceil(F.col("members") / block)).alias("salt"),
        )
        own = (F.col("id") == F.col("lead_id")) & (F.col("sha") == F.col("lead_sha"))
        pairs = stage(
            grouped.filter(~own).select("id", "sha", "lead_id", "lead_sha", "salt"), "to-compare"
        )
        if not pairs.count():
            settled.append(grouped)
            break
        compared = stage(_same_text(docs, pairs, chunk), "compared")
        grouped = meet(grouped, compared, ["id", "sha"], "left")
        fits = own | F.coalesce("same", F.lit(False))
        settled.append(grouped.filter(fits).drop("same"))
        if compared.filter("same").count() == compared.count():
            break
        todo = stage(grouped.filter(~fits).select("id", "sha", *MARK, "n"), "collisions")

    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    found = found.select("id", "sha", "n", "lead_id", "lead_sha")
    # Only groups of more than one row need their size looked up.
    groups = found.groupBy("lead_id", "lead_sha").agg(F.sum("n").alias("group_size"))
    groups = stage(groups.filter("group_size > 1"), "groups")
    own = (F.col("id") == F.col("lead_id")) & (F.col("sha") == F.col("lead_sha"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return (
        _counted_out(meet(found, groups, ["lead_id", "lead_sha"], "left"), "n", "repeat")
        .withColumn("own", own)
        .select(
            known("id").alias("doc_id"),
            known("lead_id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            (F.col("own") & (F.col("repeat") == 0)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Rows are told apart by (doc_id, digest), and only those that go are looked
    up, so texts do not move while copies are few.  Where the table repeats a
    row, one of the repeats stays; only such rows are sorted.
    """
    rows = exact_groups(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count("*").alias("copies")
    )
    odd = stage(
        rows.filter("NOT kept OR copies > 1").select(
            F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"),
            F.col("text_sha256").alias("__sha"),
            F.col("kept").alias("__kept"),
        ),
        "copies",
    )
    keys = ["__id", "__sha"]
    columns = [F.col(c) for c in docs.columns]
    marked = docs.select(
        "*",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("__id"),
        F.sha2(whole_text().cast("binary"), 256).alias("__sha"),
    )
    single = meet(marked, odd, keys, "left_anti").select(*columns)
    repeated = odd.filter("__kept")
    if not repeated.take(1):
        return single
    first = Window.partitionBy(*keys).orderBy(F.monotonically_increasing_id())
    some = meet(marked, repeated, keys).withColumn("__nth", F.row_number().over(first))
    return single.unionByName(some.filter("__nth = 1").select(*columns))
