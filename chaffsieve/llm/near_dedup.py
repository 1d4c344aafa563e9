"""Near duplicates by SetSketch registers.

A document is the set of its word shingles.  Register i of its sketch is
floor(1 - log_b(min)) over exponentially distributed hashes of the set, cut to
16 bits: minima on an exponential scale, so the sketch of a union is the
register-wise maximum, and two sets agree in a register with a probability of
about their Jaccard similarity.

1. Documents with the same set are one class; only classes go on.
2. Bands of registers are bucket keys.  Two sets at the threshold share no
   bucket with a chance below MISS.
3. In each bucket every member is paired with one centre, the member seen in
   the fullest buckets.  Pairs are estimated from all registers jointly, by
   likelihood with the known set sizes; if the threshold is out of question
   the pair goes, else it is confirmed on the full sets.
4. Confirmed links give components.  Where a bucket still holds several,
   members are compared by their registers inside tasks, in blocks, and
   components that may be linked make a family; only a spanning forest of
   likely pairs leaves a task.
5. Within a family the full sets of different components are compared inside
   tasks, again in blocks, and a spanning forest of true links leaves them.

So no link between different sets that share a bucket is lost unless it joins
what is joined already, and what is written grows with documents, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.components import components
from chaffsieve.llm.tables import meet, small_batches, whole_text
from chaffsieve.llm.text64 import finalise, hash_words, shingles, utf8, word_bounds
from chaffsieve.sources.staging import stage

MISS = 1e-6
REGISTERS = 128  # at most
BASE = 1.001  # of the exponential scale
RATE = 20.0
LIMIT = 2**16 - 2
# A pair goes if the threshold is less likely than the best similarity by e**-12, near 5 sigma.
DOUBT = 12.0
# Members of a bucket or family compared at once within a task.
LEFT_BLOCK, RIGHT_BLOCK = 512, 2048


@dataclass(frozen=True)
class Sketch:
    """Shingle size, threshold in percent, and bands that follow from it."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        fits = [r for r in range(1, 17) if r * self._bands(r) <= REGISTERS]
        return max(fits, default=1)

    def _bands(self, rows: int) -> int:
        hit = (self.percent / 100) ** rows
        return 1 if hit >= 1 else ceil(log(MISS) / log(1 - hit))

    @property
    def bands(self) -> int:
        return self._bands(self.rows)

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """The m registers of each set, 16 bits each; an empty set has zeros."""
    rng = np.random.default_rng(1729)
    odd = rng.integers(0, 2**63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 2**63, m, dtype=np.uint64)
    out = np.full((m, len(sets)), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    whole = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner_start = np.cumsum(sizes) - sizes
    filled = np.flatnonzero(sizes)
    first = owner_start[filled]
    step = 1 << 15
    for at in range(0, len(whole), step):
        part = whole[at : at + step]
        lo = int(np.searchsorted(first, at, "right")) - 1
        hi = int(np.searchsorted(first, at + len(part)))
        owners = filled[lo:hi]
        cuts = np.maximum(first[lo:hi] - at, 0)
        for i in range(m):
            least = np.minimum.reduceat((part ^ flip[i]) * odd[i], cuts)
            out[i, owners] = np.minimum(out[i, owners], least)
    uniform = (out.astype(np.float64) + 0.5) / 2.0**64
    with np.errstate(divide="ignore"):
        scale = 1 - np.log(-np.log1p(-np.minimum(uniform, 1 - 2**-53)) / RATE) / log(BASE)
    values = np.clip(np.floor(scale), 0, LIMIT + 1).astype(np.uint16)
    values[:, sizes == 0] = 0
    return np.ascontiguousarray(values.T)


def likely(
    equal: np.ndarray, above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float
) -> np.ndarray:
    """May the similarity reach the threshold, given register comparisons and set sizes?

    With u and v the shares of the sizes, a register of a is above that of b
    with probability p(u - v * j), below with p(v - u * j), where
    p(x) = -log_b(1 - x * (b - 1) / b).  The largest likelihood from the
    threshold on is compared with the largest of all, on a grid.
    """
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    counts = [c[:, None] for c in (above, below, equal)]
    # The last column is the threshold itself.
    grid = np.append(np.linspace(0, 1, 33) * top, np.minimum(threshold, top), axis=1)
    p = lambda x: np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / log(BASE), 1e-12)
    more, less = p(u - v * grid), p(v - u * grid)
    chances = more, less, np.maximum(1 - more - less, 1e-12)
    value = sum(c * np.log(x) for c, x in zip(counts, chances))
    # Set sizes alone can rule the threshold out; that test is exact.
    possible = top[:, 0] >= threshold - 1e-9
    reached = np.where(grid >= grid[:, -1:], value, -np.inf).max(axis=1)
    return possible & (reached >= value.max(axis=1) - DOUBT)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    data, offsets = utf8(batch.column("text"))
    starts, ends, first = word_bounds(data, offsets)
    words = hash_words(data, starts, ends)
    for a, b in zip(first[:-1], first[1:]):
        yield shingles(words[a:b], size)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("id"), whole_text().alias("text"))


def sketches(docs: DataFrame, plan: Sketch) -> DataFrame:
    """(id, n, d1, d2, regs, keys): set size, digest of the set, registers, bucket keys."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(271828)
        weights = rng.integers(1, 2**63, (plan.bands, plan.rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            sets = list(_sets(batch, plan.words))
            regs = registers(sets, plan.registers)
            digest = [
                (s.sum(dtype=np.uint64), finalise(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64))
                for s in sets
            ]
            digest = np.array(digest, np.uint64).reshape(-1, 2).view(np.int64)
            parts = regs.reshape(len(sets), plan.bands, plan.rows).astype(np.uint64)
            keys = finalise((parts * weights).sum(axis=2, dtype=np.uint64) + weights[:, 0])
            flat = pa.array(keys.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.ListArray.from_arrays(
                        np.arange(0, len(flat) + 1, plan.bands, dtype=np.int32), flat
                    ),
                ],
                names=["id", "n", "d1", "d2", "regs", "keys"],
            )

    return _texts(docs).mapInArrow(
        run, "id bigint, n bigint, d1 bigint, d2 bigint, regs binary, keys array<bigint>"
    )


def _registers_of(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(len(column), -1)


def _estimate(pairs: DataFrame, known: DataFrame, plan: Sketch) -> DataFrame:
    """The (a, b) of ``pairs`` whose registers leave the threshold possible."""
    threshold = plan.percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = _registers_of(batch.column("regs_a")), _registers_of(batch.column("regs_b"))
            equal, above = (left == right).sum(axis=1), (left > right).sum(axis=1)
            keep = likely(
                equal,
                above,
                left.shape[1] - equal - above,
                batch.column("n_a").to_numpy().astype(float),
                batch.column("n_b").to_numpy().astype(float),
                threshold,
            )
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda x: known.select(
        F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}")
    )
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def _full_sets(docs: DataFrame, ids: DataFrame, plan: Sketch) -> DataFrame:
    """(id, members), staged: the shingles of the documents among the staged ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in _sets(batch, plan.words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "members"]
            )

    found = meet(_texts(docs), ids, ["id"], "left_semi")
    return stage(found.mapInArrow(run, "id bigint, members array<bigint>"), "full-sets")


def _confirm(docs: DataFrame, pairs: DataFrame, plan: Sketch) -> DataFrame:
    """The (a, b) of staged ``pairs`` whose full sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    found = _full_sets(docs, stage(ids, "ids-to-confirm"), plan)
    one = found.select(F.col("id").alias("a"), F.col("members").alias("set_a"))
    two = found.select(F.col("id").alias("b"), F.col("members").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).alias("both")
    sizes = pairs.join(one, "a").join(two, "b").select(
        "a", "b", both, (F.size("set_a") + F.size("set_b")).alias("total")
    )
    reached = F.col("both").cast("bigint") * 100 >= (F.col("total") - F.col("both")) * plan.percent
    return sizes.filter(reached).select("a", "b").distinct()


class _Forest:
    """Disjoint sets of component numbers within one task."""

    def __init__(self, parts: np.ndarray):
        names, self.of = np.unique(parts, return_inverse=True)
        self.root = np.arange(len(names))

    def sets(self) -> np.ndarray:
        """The set of each member."""
        return self.root[self.of]

    def merge(self, a: int, b: int) -> bool:
        """Join the sets of the members a and b; False if they are one already."""
        x, y = self.root[self.of[a]], self.root[self.of[b]]
        if x != y:
            self.root[self.root == y] = x
        return x != y


def _dealt(members: DataFrame, group: str, payload: DataFrame) -> DataFrame:
    """Members (group, id, component, main) with their payload, in units (group, block, other).

    In a unit LEFT_BLOCK members outside the main component of their group
    meet RIGHT_BLOCK members of any.  A group in one component has no unit.
    Rows come sorted by unit.
    """
    outside = F.col("component") != F.col("main")
    sizes = members.groupBy(group).agg(
        F.count(F.when(outside, 1)).alias("n_out"), F.count("*").alias("n_all")
    )
    sizes = stage(sizes.filter("n_out > 0"), "mixed-groups")
    lefts, rights = F.ceil(F.col("n_out") / LEFT_BLOCK), F.ceil(F.col("n_all") / RIGHT_BLOCK)
    rows = meet(members, sizes, [group]).select(
        F.col(group).alias("group"),
        "id",
        "component",
        outside.alias("outside"),
        lefts.alias("lefts"),
        rights.alias("rights"),
        F.pmod(F.xxhash64("id"), lefts).alias("at_left"),
        F.pmod(F.xxhash64("id", group), rights).alias("at_right"),
    )
    zero = F.lit(0).cast("bigint")
    as_left = rows.filter("outside").select(
        "group", "id", "component", F.lit(True).alias("is_left"),
        F.col("at_left").alias("block"), F.explode(F.sequence(zero, F.col("rights") - 1)).alias("other"),
    )
    as_right = rows.select(
        "group", "id", "component", F.lit(False).alias("is_left"),
        F.explode(F.sequence(zero, F.col("lefts") - 1)).alias("block"), F.col("at_right").alias("other"),
    )
    unit = ["group", "block", "other"]
    spark = members.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A given number of partitions: units are work, which their bytes don't show.
    return as_left.union(as_right).join(payload, "id").repartition(tasks, *unit).sortWithinPartitions(*unit)


def _per_unit(dealt: DataFrame, payload: list[str], compare) -> DataFrame:
    """Pairs (a, b) that ``compare`` finds in each unit of ``dealt``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []

        def out():
            left, right = [r for r in rows if r[2]], [r for r in rows if not r[2]]
            pairs = compare(left, right) if left and right else []
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            unit = zip(*(batch.column(c).to_pylist() for c in ("group", "block", "other")))
            plain = [batch.column(c).to_pylist() for c in ("id", "component", "is_left")]
            kept = [_values(batch.column(c)) for c in payload]
            for here, row in zip(unit, zip(*plain, *kept)):
                if here != last:
                    yield from out()
                    last, rows = here, []
                rows.append(row)
        yield from out()

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _values(column: pa.Array) -> list:
    """Lists as numpy arrays of their own, anything else as Python values."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])]


def _likely_bridges(members: DataFrame, known: DataFrame, plan: Sketch) -> DataFrame:
    """Pairs that tie components of a bucket together as far as registers make a link likely.

    Pairs of one set are skipped and a likely pair joins its sets, so a unit
    gives fewer pairs than it has components.
    """
    threshold = plan.percent / 100
    # Far fewer equal registers than this are never likely; it spares the arithmetic.
    least = int(plan.registers * threshold / 2)

    def compare(left: list[tuple], right: list[tuple]) -> list[tuple[int, int]]:
        rows = right + left
        regs = np.frombuffer(b"".join(r[4] for r in right), np.uint16).reshape(len(right), -1)
        sizes = np.array([r[3] for r in right], float)
        forest = _Forest(np.array([r[1] for r in rows], np.int64))
        found = []
        for i, (doc, _, _, size, raw) in enumerate(left, len(right)):
            sets = forest.sets()
            other = np.flatnonzero(sets[: len(right)] != sets[i])
            mine = np.frombuffer(raw, np.uint16)
            equal = (regs[other] == mine).sum(axis=1)
            other, equal = other[equal >= least], equal[equal >= least]
            if not len(other):
                continue
            above = (regs[other] < mine).sum(axis=1)
            keep = likely(
                equal, above, len(mine) - equal - above, np.full(len(other), float(size)), sizes[other], threshold
            )
            for j in other[keep].tolist():
                if forest.merge(i, j):
                    found.append((doc, rows[j][0]))
        return found

    return _per_unit(_dealt(members, "key", known), ["n", "regs"], compare).distinct()


def _links_between(docs: DataFrame, members: DataFrame, plan: Sketch) -> DataFrame:
    """Links between components of a family, confirmed on the full sets within the task.

    One look through an index of the unit's shingles counts what a member
    shares with all others.  Links within a set already joined are not needed.
    """
    ids = stage(members.select("id").distinct(), "family-ids")
    sets = _full_sets(docs, ids, plan)

    def compare(left: list[tuple], right: list[tuple]) -> list[tuple[int, int]]:
        rows = right + left
        sizes = np.array([len(r[3]) for r in right], np.int64)
        owner = np.repeat(np.arange(len(right)), sizes)
        every = np.concatenate([r[3] for r in right])
        order = np.argsort(every, kind="stable")
        names, first = np.unique(every[order], return_index=True)
        first, owner = np.append(first, len(every)), owner[order]
        forest = _Forest(np.array([r[1] for r in rows], np.int64))
        found = []
        for i, (doc, _, _, mine) in enumerate(left, len(right)):
            at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
            at = at[names[at] == mine]
            begin, count = first[at], first[at + 1] - first[at]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            both = np.bincount(owner[np.repeat(begin, count) + step], minlength=len(right))
            link = both * 100 >= (len(mine) + sizes - both) * plan.percent
            for j in np.flatnonzero(link).tolist():
                if forest.merge(i, j):
                    found.append((doc, rows[j][0]))
        return found

    return _per_unit(_dealt(members, "family", sets), ["members"], compare).distinct()


def _named(rows: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of their ``node``: itself if ``roots`` don't have it."""
    found = meet(rows, roots.select(F.col("node").alias(node), F.col("component").alias("__root")), [node], "left")
    return found.withColumn(name, F.coalesce("__root", node)).drop("__root")


def near_groups(docs: DataFrame, plan: Sketch = Sketch()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ASCII letters are lower-cased and words are runs of anything but ASCII
    white space.  Documents are linked if 100 * intersection >= percent *
    union of their shingle sets; component_id is the smallest doc_id
    reachable over links.  A text with fewer words than a shingle is one
    shingle, one without words (or NULL) has none, links with nothing and is
    kept.  A NULL doc_id takes no part in links: component_id NULL, kept.
    Rows repeated under one doc_id are one document with the links of all of
    them.  An empty table gives no rows; other columns are ignored.

    Shingles are compared by 64-bit hashes, whole sets by size and a 128-bit
    digest.
    """
    marks = stage(sketches(docs, plan), "sketches")
    linkable = marks.filter("n > 0 AND id IS NOT NULL")
    # Copies: one representative per set.
    classes = linkable.groupBy("d1", "d2", "n").agg(
        F.min("id").alias("rep"), F.count("*").alias("rows")
    )
    classes = stage(classes.filter("rows > 1").drop("rows"), "classes")
    reps = meet(linkable, classes, ["d1", "d2", "n"], "left")
    reps = stage(reps.filter("rep IS NULL OR rep = id").select("id", "n", "regs", "keys"), "representatives")
    known = reps.drop("keys")

    # Buckets of two members or more; the centre is the member in the fullest buckets.
    placed = reps.select("id", F.explode("keys").alias("key"))
    shared = stage(placed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    members = stage(meet(placed, shared, ["key"]), "bucket-members")
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = members.join(stage(weight, "weights"), "id")
    rank = F.struct("weight", (-F.col("id")).alias("back"))
    centres = weighed.groupBy("key").agg(F.max(rank).alias("top"))
    centres = stage(centres.select("key", (-F.col("top.back")).alias("centre")), "centres")
    starred = stage(meet(members, centres, ["key"]).select("key", "id", "centre"), "stars")

    spokes = starred.filter("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    tested = stage(_estimate(stage(spokes.distinct(), "spokes"), known, plan), "likely")
    links = stage(_confirm(docs, tested, plan), "confirmed")
    joined = stage(components(links), "first-components")

    # Components that share a bucket and may be linked make a family.
    apart = stage(_named(_named(starred, joined, "id", "component"), joined, "centre", "main"), "apart")
    bridges = stage(_likely_bridges(apart, known, plan), "bridges")
    if bridges.take(1):
        over = stage(components(links.union(bridges)), "families")
        # Whoever a bridge touches, and all of its component, may hold the link.
        touched = bridges.select(F.col("a").alias("id")).union(bridges.select("b"))
        touched = _named(touched.distinct(), over, "id", "family").select("family").distinct()
        family = _named(_named(known.select("id").distinct(), joined, "id", "component"), over, "id", "family")
        family = meet(family, stage(touched, "open-families"), ["family"], "left_semi")
        family = stage(family, "family-members")
        largest = family.groupBy("family", "component").agg(F.count("*").alias("size"))
        main = F.max(F.struct("size", "component")).alias("top")
        largest = stage(largest.groupBy("family").agg(main).select("family", F.col("top.component").alias("main")), "mains")
        more = _links_between(docs, meet(family, largest, ["family"]), plan)
        joined = stage(components(links.union(stage(more, "links-between"))), "components")

    rep = F.coalesce("rep", "id")
    answer = meet(marks.select("id", "n", "d1", "d2"), classes, ["d1", "d2", "n"], "left")
    # Only linkable rows belong to a class; digests of empty sets are all alike.
    answer = answer.withColumn("node", F.when(F.col("n") > 0, rep).otherwise(F.col("id")))
    answer = meet(answer, joined, ["node"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node"))
    return answer.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, plan: Sketch = Sketch()) -> DataFrame:
    """``docs`` with one document of each group of near copies, all columns kept.

    Every row of a kept document stays, so documents without an id do too.
    """
    dropped = near_groups(docs, plan).filter("NOT kept").select(F.col("doc_id").alias("__dropped"))
    dropped = stage(dropped.distinct(), "near-copies")
    return meet(docs.withColumn("__dropped", F.col("doc_id").cast("bigint")), dropped, ["__dropped"], "left_anti").drop(
        "__dropped"
    )
