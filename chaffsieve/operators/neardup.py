"""Near duplicates: nearest other row by cosine within a group, exactly.

How all pairs of a group are compared without looking at their terms:

1. Rows with equal vectors collapse to one representative, so any number of
   copies costs one row from here on.
2. A vector is folded: its terms are dealt to some hundred places by rank, and
   a place holds the length of the vector's part there.  By Cauchy and Schwarz
   the product of two folded vectors is at least their cosine, so a pair whose
   product stays below the threshold is settled; a matrix product settles a
   few million pairs at a time.  The commonest terms have places of their own.
3. The pairs left are compared term by term, in the same task and in double
   precision.  Where they are many, those with the largest products come first,
   and a pair that can no longer be the best of either row is skipped.

A group is dealt to blocks, and each pair of blocks is a unit of work that holds
one block and streams the other.  Pairs come in rounds, so that a block is
shuffled to a few units at a time, and its counts travel compressed.  Only the
best partner per row and unit leaves a task.  Nothing is sampled, capped or
approximated.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions.rules import group_key
from chaffsieve.operators.lookup import keyed_lookup
from chaffsieve.operators.tfidf import vectors
from chaffsieve.sources.staging import settle, small_batches, stage

# Slack for products of folded vectors, which are floats.
_SLACK = 1e-4
_SIMILARITY_DIGITS = 9

# A group is cut into about this many blocks, as far as their sizes allow.
_BLOCKS = 8
# A block has at most this many times ``posting_block`` rows, and this many bytes.
_LARGEST = 8
_BLOCK_BYTES = 64 << 20
_TERM_BYTES = 12
# Rows that travel and are multiplied together.
_CHUNK_ROWS = 2048
_CHUNK_BYTES = 4 << 20
# Places of a folded vector.
_LEAST_PLACES, _MOST_PLACES = 128, 1024
# Terms compared at a time.
_CELLS = 1 << 21
# Tasks a comparison is dealt to at most, beyond the session's partitions.
_TASKS = 2000

# Distances of blocks that are compared in a round: a block then goes to at most twice as many units.
_DISTANCES = 2

_KEY = {"grp": "string", "block": "int", "blocks": "int", "places": "int"}
# Rows and terms of a chunk, its number within the block, and its columns; the first chunk of a block has the idfs.
_COUNTS = ("part", "rows", "terms", "words")
_ROW = {"ids": "<i8", "copies": "<i8", "sizes": "<i4", "norms": "<f8"}
_TERM = {"ranks": "<i4", "counts": "<i4"}
_HELD = {**dict.fromkeys(_ROW, "rows"), **dict.fromkeys(_TERM, "terms"), "idfs": "words"}
_TYPES = {**_ROW, **_TERM, "idfs": "<f8"}
_PACKED = ", ".join(f"{c} {t}" for c, t in {**_KEY, **dict.fromkeys(_COUNTS, "int"), **dict.fromkeys(_HELD, "binary")}.items())
_PACKED_SCHEMA = pa.schema(
    [("grp", pa.string()), *[(c, pa.int32()) for c in ("block", "blocks", "places", *_COUNTS)]]
    + [(c, pa.binary()) for c in _HELD]
)
_CODEC = "zstd"
_BEST = "row_id bigint, copies bigint, other bigint, similarity double"


def _squeeze(values: np.ndarray, kind: str) -> bytes:
    """The numbers, first bytes first, which are the ones that differ; then compressed."""
    held = np.ascontiguousarray(values, kind)
    return pa.compress(held.view(np.uint8).reshape(len(held), held.itemsize).T.tobytes(), codec=_CODEC, asbytes=True)


def _unsqueeze(held: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(held, decompressed_size=n * width, codec=_CODEC, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).reshape(n)


def _steps(ranks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ascending ranks of each row as steps from the one before."""
    steps = np.diff(ranks, prepend=0)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[starts] = ranks[starts]
    return steps


def _from_steps(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps, dtype=np.int64)
    before = np.concatenate(([0], total))[np.cumsum(sizes) - sizes]
    return (total - np.repeat(before, sizes)).astype(np.int32)


class Chunk:
    """Some rows of a block: sparse vectors, folded ones, and the best partner met so far."""

    def __init__(self, r: dict, idfs: np.ndarray):
        places = r["places"]
        held = {c: _unsqueeze(r[c], r[n], _TYPES[c]) for c, n in _HELD.items() if c != "idfs"}
        self.ids, self.copies = held["ids"], held["copies"]
        self.sizes = held["sizes"].astype(np.int64)
        self.ranks = _from_steps(held["ranks"], self.sizes)
        self.weights = held["counts"] * idfs[self.ranks - 1] / np.repeat(held["norms"], self.sizes)
        self.ends = np.cumsum(self.sizes)
        n = len(self.ids)
        at = np.repeat(np.arange(n) * places, self.sizes) + self.ranks % places
        self.folded = np.sqrt(np.bincount(at, self.weights**2, n * places)).reshape(n, places).astype(np.float32)
        self.best = np.full(n, -1.0)
        self.other = np.zeros(n, np.int64)

    def terms(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where the terms of ``rows`` lie, where each row begins among them)."""
        sizes = self.sizes[rows]
        starts = np.cumsum(sizes) - sizes
        return np.repeat(self.ends[rows] - sizes - starts, sizes) + np.arange(sizes.sum()), starts

    def keep(self, rows: np.ndarray, similarity: np.ndarray, others: np.ndarray) -> None:
        """Take what is more similar, or as similar and earlier."""
        order = np.lexsort((others, -similarity, rows))
        rows, similarity, others = rows[order], similarity[order], others[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        rows, similarity, others = rows[first], similarity[first], others[first]
        better = (similarity > self.best[rows]) | ((similarity == self.best[rows]) & (others < self.other[rows]))
        self.best[rows[better]] = similarity[better]
        self.other[rows[better]] = others[better]

    def found(self) -> pa.RecordBatch:
        met = self.best >= 0
        columns = [self.ids[met], self.copies[met], self.other[met], self.best[met]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row_id", "copies", "other", "similarity"])


def _cosines(a: Chunk, b: Chunk, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Rounded products of rows ``i`` of ``a``, ascending, with rows ``j`` of ``b``."""
    out = np.empty(len(i))
    spread = np.zeros(int(max(a.ranks.max(), b.ranks.max())) + 1)
    firsts = np.flatnonzero(np.diff(i, prepend=-1))
    for first, last in zip(firsts, [*firsts[1:], len(i)]):
        own = slice(a.ends[i[first]] - a.sizes[i[first]], a.ends[i[first]])
        spread[a.ranks[own]] = a.weights[own]
        # In runs of about _CELLS terms.
        run = np.cumsum(b.sizes[j[first:last]]) // _CELLS
        for at in np.split(np.arange(first, last), np.flatnonzero(np.diff(run)) + 1):
            where, starts = b.terms(j[at])
            out[at] = np.add.reduceat(spread[b.ranks[where]] * b.weights[where], starts)
        spread[a.ranks[own]] = 0
    return np.round(out, _SIMILARITY_DIGITS)


# Room for the products of two chunks, used again by the next two.
_room = np.empty(0, np.float32)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[rows of ``a``, rows of ``b``], valid until the next call: fresh pages for each would cost half as much again."""
    global _room
    if len(_room) < len(a) * len(b):
        _room = np.empty(len(a) * len(b), np.float32)
    return np.matmul(a, b.T, out=_room[: len(a) * len(b)].reshape(len(a), len(b)))


def _compare(a: Chunk, b: Chunk, threshold: float, any_earlier: bool) -> None:
    """Let the rows of two chunks, or the pairs of one, know of each other."""
    bound = _products(a.folded, b.folded)
    if a is b:
        bound[np.tril_indices(len(a.ids))] = 0

    def settle(i: np.ndarray, j: np.ndarray) -> None:
        for at in range(0, len(i), _CELLS):
            m, n = i[at : at + _CELLS], j[at : at + _CELLS]
            similarity = _cosines(a, b, m, n)
            near = similarity >= threshold
            m, n, similarity = m[near], n[near], similarity[near]
            for own, rows, far, others in ((a, m, b, n), (b, n, a, m)):
                use = far.ids[others] < own.ids[rows] if any_earlier else slice(None)
                own.keep(rows[use], similarity[use], far.ids[others[use]])

    least = np.float32(max(threshold - _SLACK, _SLACK))
    # In the flat array: nonzero() of two dimensions takes about as long as the products.
    i, j = np.divmod(np.flatnonzero(bound >= least), len(b.ids))
    if len(i) > 4 * (len(a.ids) + len(b.ids)):
        # The likeliest partner of each row first; what falls behind it is not looked at.
        top_a, top_b = bound.argmax(axis=1), bound.argmax(axis=0)
        if any_earlier:
            before = b.ids < a.ids[:, None]
            top_a, top_b = (bound * before).argmax(axis=1), (bound * ~before).argmax(axis=0)
        m = np.concatenate((np.arange(len(a.ids)), top_b))
        n = np.concatenate((top_a, np.arange(len(b.ids))))
        likely = bound[m, n] >= least
        m, n = m[likely], n[likely]
        order = np.argsort(m, kind="stable")
        settle(m[order], n[order])
        left = bound[i, j] + _SLACK
        for_a, for_b = left >= a.best[i], left >= b.best[j]
        if any_earlier:
            earlier = b.ids[j] < a.ids[i]
            for_a, for_b = for_a & earlier, for_b & ~earlier
        i, j = i[for_a | for_b], j[for_a | for_b]
    settle(i, j)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that lie together by group and block, as chunks; the row without an id has the block's idfs."""
    key, rows, size, part, idfs = None, [], 0, 0, np.empty(0)

    def chunk() -> pa.RecordBatch:
        ids, copies, norms, ranks, counts = zip(*rows)
        sizes = np.array([len(r) for r in ranks])
        held = {
            "ids": np.array(ids),
            "copies": np.array(copies),
            "sizes": sizes,
            "norms": np.array(norms),
            "ranks": _steps(np.concatenate(ranks), sizes),
            "counts": np.concatenate(counts),
            "idfs": idfs,
        }
        row = dict(zip(_KEY, key)) | {"part": part, "rows": len(ids), "terms": int(sizes.sum()), "words": len(idfs)}
        row |= {c: _squeeze(x, _TYPES[c]) for c, x in held.items()}
        return pa.RecordBatch.from_pylist([row], schema=_PACKED_SCHEMA)

    def lists(column: pa.Array) -> list[np.ndarray]:
        """An array per row, empty where there is none."""
        ends = np.cumsum(np.asarray(pa.compute.list_value_length(column).fill_null(0)))
        return np.split(np.asarray(column.flatten()), ends[:-1])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_KEY, "rep", "copies", "norm")]
        parts = [lists(batch.column(c)) for c in ("ranks", "counts", "idfs")]
        for *here, rep, copies, norm, ranks, counts, words in zip(*columns, *parts):
            if rows and (here != key or len(rows) >= _CHUNK_ROWS or size >= _CHUNK_BYTES):
                yield chunk()
                rows, size, part, idfs = [], 0, part + 1, np.empty(0)
            if here != key:
                key, part = here, 0
            if rep is None:
                idfs = words
            else:
                rows.append((rep, copies, norm, ranks, counts))
                size += _TERM_BYTES * len(ranks)
    if rows:
        yield chunk()


def _blocks(vecs: DataFrame, distinct: DataFrame, words: DataFrame, cfg: AuditConfig) -> tuple[DataFrame, DataFrame]:
    """(staged chunks of each group's blocks, groups): one row per distinct vector goes in."""
    n, terms = F.count("*"), F.sum("terms")
    rows = F.greatest(F.lit(cfg.posting_block), F.least(n / _BLOCKS, F.lit(_LARGEST * cfg.posting_block)))
    blocks = F.ceil(F.greatest(n / rows, terms * _TERM_BYTES / _BLOCK_BYTES)).cast("int")
    places = F.pow(2.0, F.ceil(F.log2(2 * terms / n)))
    places = F.greatest(F.least(places, F.lit(_MOST_PLACES)), F.lit(_LEAST_PLACES))
    groups = stage(
        distinct.groupBy("group_key").agg(
            n.alias("rows"),
            blocks.alias("blocks"),
            # No more than there are terms: then each has a place of its own.
            F.least(places, F.max("last")).cast("int").alias("places"),
        ),
        "groups",
    )
    reps = vecs.drop("group_key", "vector_key").join(
        distinct.select("group_key", F.col("rep").alias("row_id"), "copies"), "row_id"
    )
    dealt = keyed_lookup(reps, groups, ["group_key"], "rows", cfg).select(
        F.col("group_key").cast("string").alias("grp"),
        F.pmod(F.xxhash64("row_id"), F.col("blocks")).cast("int").alias("block"),
        "blocks",
        "places",
        F.col("row_id").cast("bigint").alias("rep"),
        "copies",
        "norm",
        "ranks",
        "counts",
    )
    # A row per group and block with the idfs in the order of the ranks, which are 1, 2, ...
    idfs = words.groupBy("group_key").agg(F.sort_array(F.collect_list(F.struct("term_rank", "idf"))).alias("idfs"))
    each = idfs.join(groups, "group_key").select(
        F.col("group_key").cast("string").alias("grp"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "blocks",
        "places",
        F.col("idfs.idf").alias("idfs"),
    )
    near = (
        dealt.unionByName(each, allowMissingColumns=True)
        .repartition("grp", "block")
        .sortWithinPartitions("grp", "block", F.col("rep").asc_nulls_first())
    )
    return stage(near.mapInArrow(_pack, _PACKED), "row-blocks"), groups


def _rounds(most: int) -> list[tuple[int, int]]:
    """Distances of blocks, from and to, that are compared together; blocks lie in a ring of ``most`` at most."""
    farthest = most // 2
    return [(d, min(d + _DISTANCES - 1, farthest)) for d in range(0, farthest + 1, _DISTANCES)]


def _units(chunks: DataFrame, nearest: int, farthest: int) -> DataFrame:
    """Each chunk once per pair of blocks that it is in, for blocks so far apart in the ring of their group."""
    apart = F.sequence(F.lit(nearest), F.least(F.lit(farthest), F.floor(F.col("blocks") / 2).cast("int")))
    others = F.flatten(
        F.transform(
            apart,
            lambda d: F.array(F.pmod(F.col("block") + d, F.col("blocks")), F.pmod(F.col("block") - d, F.col("blocks"))),
        )
    )
    pairs = F.transform(
        F.array_distinct(others), lambda b: F.struct(F.least("block", b).alias("low"), F.greatest("block", b).alias("high"))
    )
    near = chunks.filter(F.floor(F.col("blocks") / 2) >= nearest)
    return near.select("*", F.inline(pairs)).drop("blocks")


def best_partners(
    vecs: DataFrame, distinct: DataFrame, words: DataFrame, threshold: float, rule: str, cfg: AuditConfig
) -> DataFrame:
    """(row_id, copies, other, similarity): per row the best partner in each block, if similar enough."""
    spark = vecs.sparkSession
    small_batches(spark)
    chunks, groups = _blocks(vecs, distinct, words, cfg)
    any_earlier = rule == "any_earlier"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, idfs = None, [], np.empty(0)
        for batch in batches:
            for r in batch.to_pylist():
                here = (r["grp"], r["low"], r["high"])
                if here != unit:
                    yield from (c.found() for c in held)
                    unit, held = here, []
                if r["part"] == 0:
                    idfs = _unsqueeze(r["idfs"], r["words"], _TYPES["idfs"])
                chunk = Chunk(r, idfs)
                alone, lower = r["low"] == r["high"], r["block"] == r["low"]
                if alone or not lower:
                    for before in held:
                        _compare(before, chunk, threshold, any_earlier)
                if alone:
                    _compare(chunk, chunk, threshold, any_earlier)
                if lower:
                    held.append(chunk)
                else:
                    yield chunk.found()
        yield from (c.found() for c in held)

    # At most as many distances as half the blocks of the largest group.
    rounds = _rounds(groups.agg(F.max("blocks")).first()[0] or 1)
    found = None
    for nearest, farthest in rounds:
        # Of each group, the pairs of blocks beyond one per group, for which there are the session's partitions.
        last = F.least(F.lit(farthest), F.floor(F.col("blocks") / 2))
        pairs = F.when(last >= nearest, F.col("blocks") * (last - nearest + 1) - 1).otherwise(0)
        more = int(groups.agg(F.sum(pairs)).first()[0] or 0)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) + min(more, _TASKS)
        # Within a unit of two blocks the chunks of the lower one come first; they meet only the other's.
        met = (
            _units(chunks, nearest, farthest)
            .repartition(tasks, "grp", "low", "high")
            .sortWithinPartitions("grp", "low", "high", "block", "part")
            .mapInArrow(run, _BEST)
        )
        if len(rounds) > 1:
            met = stage(met, "round")
        found = met if found is None else found.unionByName(met)
    return found


# Above any row id; similarities count in units of their last digit.
_ID_SPAN = Decimal(10) ** 19


def _ranked() -> Column:
    """(similarity, smaller ``other`` first) as one number, which a hash aggregate can keep."""
    units = F.round(F.col("similarity") * 10**_SIMILARITY_DIGITS).cast("decimal(11,0)")
    span = F.lit(_ID_SPAN).cast("decimal(20,0)")
    return units * span + (span - F.col("other").cast("decimal(20,0)"))


def _unranked(best: Column) -> tuple[Column, Column]:
    """(other, similarity) of ``_ranked``; what is left of a unit is the id's complement."""
    span = F.lit(_ID_SPAN).cast("decimal(20,0)")
    rest = best % span
    other = F.when(rest == 0, span - span).otherwise(span - rest).cast("bigint")
    units = ((best - rest) / span).cast("double") - F.when(rest == 0, 1).otherwise(0)
    return other, units / 10**_SIMILARITY_DIGITS


def representatives(vecs: DataFrame) -> DataFrame:
    """One row per distinct vector: the earliest row that has it, how many do, its terms and the last of them."""
    narrow = vecs.select(
        "group_key", "vector_key", "row_id", F.size("ranks").alias("terms"), F.element_at("ranks", -1).alias("last")
    )
    distinct = narrow.groupBy("group_key", "vector_key").agg(
        F.min("row_id").alias("rep"), F.count("*").alias("copies"), F.max("terms").alias("terms"), F.max("last").alias("last")
    )
    return stage(distinct, "representatives")


def near_duplicates(
    df: DataFrame,
    cfg: AuditConfig,
    threshold: float | None = None,
    rule: str = "nearest",
    group: str | None = None,
) -> DataFrame:
    """(row_id, duplicate_of, similarity) of the flagged rows.

    ``nearest``: a row is flagged when its nearest other row in the group
    (ties: smallest row_id) is similar enough and earlier.  ``any_earlier``:
    when any earlier row is; it then points at the most similar one.
    ``df`` needs row_id, instruction_clean and the group column.
    """
    if rule not in ("nearest", "any_earlier"):
        raise ValueError(f"unknown rule {rule!r}")
    threshold = cfg.duplicate_threshold if threshold is None else threshold
    group = group or group_key(df)
    return settle(df.sparkSession, "near-duplicates", lambda: _found(df, cfg, threshold, rule, group))


def _found(df: DataFrame, cfg: AuditConfig, threshold: float, rule: str, group: str) -> DataFrame:
    vecs, words = vectors(df, group, cfg)
    distinct = representatives(vecs)

    met = best_partners(vecs, distinct, words, threshold, rule, cfg)
    best = met.groupBy("row_id", "copies").agg(F.max(_ranked()).alias("best"))
    partner, similarity = _unranked(F.col("best"))
    best = stage(
        best.select("row_id", "copies", partner.alias("duplicate_of"), similarity.alias("similarity")),
        "best-partners",
    ).filter(F.col("duplicate_of") < F.col("row_id"))

    # The first row of a repeated vector: its nearest row is a later copy, unless
    # an earlier row is as near as a copy.
    first = best if rule == "any_earlier" else best.filter("copies = 1 OR similarity >= 1.0")

    # The other copies point at the first, or at what is as near and earlier still.
    as_near = best.filter("similarity >= 1.0").select(
        F.col("row_id").alias("rep"), F.col("duplicate_of").alias("sooner")
    )
    repeated = stage(
        distinct.drop("terms", "last").filter(F.col("copies") > 1).join(as_near, "rep", "left"), "repeated-vectors"
    )
    rest = keyed_lookup(
        vecs.select("group_key", "vector_key", "row_id"),
        repeated,
        ["group_key", "vector_key"],
        "copies",
        cfg,
    ).filter(F.col("row_id") != F.col("rep"))
    return first.drop("copies").unionByName(
        rest.select(
            "row_id",
            F.coalesce("sooner", "rep").alias("duplicate_of"),
            F.lit(1.0).alias("similarity"),
        )
    )


def flag_near_duplicates(df: DataFrame, cfg: AuditConfig, **options) -> DataFrame:
    """Attach is_near_duplicate and duplicate_of."""
    found = near_duplicates(df, cfg, **options).select("row_id", "duplicate_of")
    return df.join(found, "row_id", "left").withColumn(
        "is_near_duplicate", F.col("duplicate_of").isNotNull().cast("int")
    )
