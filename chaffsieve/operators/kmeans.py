"""K-Means for many starts at once: every pass over the points advances all of them.

Points are dense rows kept in *balls*: some neighbouring points with their
mean, their radius around it and their sum.  By the triangle inequality a centre
can only be nearest to a point of a ball if it is at most two radii farther
from the ball's mean than the nearest centre is.  Where that leaves one centre
of a model, the whole ball goes to it: its sum, size and cost are added without
looking at a point.  Where it leaves several, distances are taken to those
alone, for all models in one matrix product.

A pass sends back one row per model and task, summed by Spark per model; the
driver holds the centres, which k and the dimensions bound.  Passes keep no
state beyond the centres, so a lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.sources.staging import small_batches, stage

BALL_BYTES = 1 << 20  # of points in a ball, at most
BALL_ROWS = 512
BALLS_AT_ONCE = 64
# Rows that meet the centres together: their products stay in a core's cache.
_ROWS_AT_ONCE = 1024
TASK_BYTES = 64 << 20
SMALL_TASK_BYTES = 1 << 20
# Readers of blocks and balls hold this much at a time.
GROUP_BYTES = 8 << 20
# Numbers held at a time while points meet centres, some 32 MB.
_CELLS = 1 << 22
_SLACK = 1e-9

_BLOCKS = "n int, dims int, ids binary, data binary"
_BALLS = f"{_BLOCKS}, mean binary, total binary, radius double, squares double"


@dataclass
class Model:
    """Centres, and what the last pass found of them: sizes, member sums and cost belong to these centres."""

    k: int
    centers: np.ndarray
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    cost: float = float("inf")
    steps: int = 0

    @property
    def filled(self) -> int:
        return int((self.sizes > 0).sum())

    @property
    def between(self) -> float:
        """Squared length of the members' means, summed over the rows."""
        full = self.sizes > 0
        return float(((self.sums[full] ** 2).sum(axis=1) / self.sizes[full]).sum())


# ---- points as dense rows ----------------------------------------------------


def dense_rows(column: pa.StructArray) -> np.ndarray:
    """[n, d] of an unwrapped vector column, sparse or dense."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.empty((0, 0))
    kinds, sizes, indices, values = (column.field(i) for i in range(4))
    lengths = np.asarray(pa.compute.list_value_length(values), np.int64)
    flat = np.asarray(values.flatten(), np.float64)
    sparse = np.asarray(kinds, np.int64) == 0
    if not sparse.any():
        return flat.reshape(n, -1)
    dims = int(np.max(np.where(sparse, np.asarray(sizes.fill_null(0), np.int64), lengths)))
    out = np.zeros((n, dims))
    row = np.repeat(np.arange(n), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    of_sparse = np.repeat(sparse, lengths)
    at[of_sparse] = np.asarray(indices.filter(pa.array(sparse)).flatten(), np.int64)
    out[row, at] = flat
    return out


def dense_slices(column: pa.StructArray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(where it begins, its dense rows) of slices of about ``most`` bytes."""
    if not len(column):
        return
    longest = pa.compute.max(pa.compute.list_value_length(column.field(3))).as_py() or 1
    dims = max(longest, pa.compute.max(column.field(1)).as_py() or 1)
    step = max(1, most // (8 * dims))
    for at in range(0, len(column), step):
        yield at, dense_rows(column.slice(at, step))


def products(column: pa.StructArray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([n, k] inner products with the centres, squared lengths) of an unwrapped vector column.

    Sparse vectors stay sparse: only the centres' coordinates they have are read.
    """
    n = len(column)
    kinds, _, indices, values = (column.field(i) for i in range(4))
    if not (np.asarray(kinds, np.int64) == 0).all():
        rows = [x for _, x in dense_slices(column, 1 << 25)]
        x = np.concatenate([np.pad(r, ((0, 0), (0, centers.shape[1] - r.shape[1]))) for r in rows])
        return x @ centers.T, (x * x).sum(axis=1)
    lengths = np.asarray(pa.compute.list_value_length(values), np.int64)
    flat = np.asarray(values.flatten(), np.float64)
    at = np.asarray(indices.flatten(), np.int64)
    ends = np.cumsum(lengths)
    out, columns = np.zeros((n, len(centers))), np.ascontiguousarray(centers.T)
    row = np.repeat(np.arange(n), lengths)
    full = np.flatnonzero(lengths)
    step = max(1, _CELLS // len(centers))
    # Rows in runs of about ``step`` coordinates.
    first = 0
    while first < len(full):
        begin = int(ends[full[first]] - lengths[full[first]])
        last = max(first + 1, int(np.searchsorted(ends[full], begin + step, "right")))
        stop = int(ends[full[last - 1]])
        starts = (ends - lengths)[full[first:last]] - begin
        out[full[first:last]] = np.add.reduceat(columns[at[begin:stop]] * flat[begin:stop, None], starts, axis=0)
        first = last
    return out, np.bincount(row, flat * flat, n)


def fold(points: DataFrame, dims: int, copies: int = 4) -> DataFrame:
    """Wide sparse vectors as dense ones of ``dims`` coordinates and unit length.

    Each coordinate goes to ``copies`` fixed places with fixed signs, which
    keeps angles nearly as they are.  The result has single precision.
    """
    place = np.random.default_rng(97)
    a, b = place.integers(1, 2**62, (2, copies), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("features")
            step = max(1, (1 << 25) // (8 * dims))
            for at in range(0, len(column), step):
                part = column.slice(at, step)
                lengths = np.asarray(pa.compute.list_value_length(part.field(3)), np.int64)
                flat = np.asarray(part.field(3).flatten(), np.float64)
                index = np.asarray(part.field(2).flatten(), np.uint64)
                row = np.repeat(np.arange(len(part)), lengths)
                x = np.zeros(len(part) * dims)
                for c in range(copies):
                    mixed = (index + np.uint64(1)) * (a[c] | np.uint64(1)) + b[c]
                    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    to = ((mixed >> np.uint64(33)) % np.uint64(dims)).astype(np.int64)
                    sign = np.where((mixed >> np.uint64(32)) & np.uint64(1), 1.0, -1.0)
                    x += np.bincount(row * dims + to, sign * flat, len(x))
                x = x.reshape(len(part), dims)
                length = np.sqrt((x * x).sum(axis=1, keepdims=True))
                x /= np.where(length > 0, length, 1)
                x = x.astype(np.float32).astype(np.float64)  # so that blocks hold them in half the bytes
                offsets = pa.array(np.arange(len(part) + 1) * dims, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id").slice(at, step), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))],
                    names=["row_id", "features"],
                )

    rows = points.select(F.col("row_id").cast("bigint"), F.unwrap_udt("features").alias("features"))
    wide = rows.mapInArrow(run, "row_id bigint, features array<double>")
    return wide.select("row_id", array_to_vector("features").alias("features"))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in single precision where that holds them exactly."""
    with np.errstate(over="ignore"):
        half = x.astype(np.float32)
    return half if np.array_equal(half, x) else x


def _block(n: int, dims: int, ids: np.ndarray, data: np.ndarray) -> dict:
    return {"n": n, "dims": dims, "ids": np.ascontiguousarray(ids, "<i8").tobytes(), "data": np.ascontiguousarray(data).tobytes()}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_BLOCK_SCHEMA = pa.schema([("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])
_BALL_SCHEMA = pa.schema(
    [*_BLOCK_SCHEMA, ("mean", pa.binary()), ("total", pa.binary()), ("radius", pa.float64()), ("squares", pa.float64())]
)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, points) of each block of a batch, in the precision they are kept in."""
    for n, dims, ids, data in zip(*(batch.column(c) for c in ("n", "dims", "ids", "data"))):
        shape, held = (n.as_py(), dims.as_py()), data.as_buffer()
        kind = np.float32 if held.size == 4 * shape[0] * shape[1] else np.float64
        yield np.frombuffer(ids.as_buffer(), "<i8"), np.frombuffer(held, kind).reshape(shape)


def _exact_rows_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same in double precision."""
    return ((ids, x.astype(np.float64, copy=False)) for ids, x in _rows_of(batch))


def blocks(points: DataFrame) -> DataFrame:
    """Staged blocks of the points (row_id, features), as they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("row_id"), np.int64)
            for at, x in dense_slices(batch.column("features"), BALL_BYTES):
                yield _batch([_block(len(x), x.shape[1], ids[at : at + len(x)], _narrow(x))], _BLOCK_SCHEMA)

    rows = points.select(F.col("row_id").cast("bigint"), F.unwrap_udt("features").alias("features"))
    small_batches(points.sparkSession)
    return stage(rows.mapInArrow(run, _BLOCKS), "point-blocks", GROUP_BYTES)


@dataclass
class Balls:
    """The staged balls, and how many partitions they were written in."""

    rows: DataFrame
    parts: int


def _ball(ids: np.ndarray, x: np.ndarray) -> dict:
    total = x.sum(axis=0, dtype=np.float64)
    mean = total / len(x)
    gaps = x - mean
    return _block(len(x), x.shape[1], ids, x) | {
        "mean": mean.tobytes(),
        "total": total.tobytes(),
        "radius": float(np.sqrt((gaps * gaps).sum(axis=1).max())),
        "squares": float(np.square(x, dtype=np.float64).sum()),
    }


def balls(packed: DataFrame, pivots: np.ndarray, ball_rows: int = BALL_ROWS) -> Balls:
    """Staged balls: points sorted by their nearest pivot and their distance to it.

    Equal points lie together; however many there are, they spread over tasks.
    """
    squares = (pivots * pivots).sum(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, kept in _rows_of(batch):
                x = kept.astype(np.float64, copy=False)
                gaps = squares - 2 * (x @ pivots.T)
                near = gaps.argmin(axis=1)
                gap = gaps[np.arange(len(x)), near] + (x * x).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(near.astype(np.int32)),
                        pa.array(gap),
                        pa.array(ids),
                        pa.array(np.full(len(x), x.shape[1], np.int32)),
                        pa.array([row.tobytes() for row in kept], pa.binary()),
                    ],
                    names=["pivot", "gap", "row_id", "dims", "data"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, ids, held = None, [], []

        def made() -> pa.RecordBatch:
            kind = np.float32 if len(held[0]) == 4 * pivot[1] else np.float64
            return _batch([_ball(np.array(ids), np.frombuffer(b"".join(held), kind).reshape(len(held), -1))], _BALL_SCHEMA)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("pivot", "dims", "row_id", "data")]
            for *here, row_id, data in zip(*columns):
                full = held and (len(held) >= ball_rows or len(held) * len(held[0]) >= BALL_BYTES)
                if full or (held and (here != pivot or len(data) != len(held[0]))):
                    yield made()
                    ids, held = [], []
                pivot = here
                ids.append(row_id)
                held.append(data)
        if held:
            yield made()

    size = packed.agg(F.sum(F.octet_length("data")).alias("bytes")).first()["bytes"] or 0
    spark = packed.sparkSession
    parts = max(-(-size // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // SMALL_TASK_BYTES)), 1)
    order = ["pivot", "gap", "row_id"]
    placed = packed.mapInArrow(place, "pivot int, gap double, row_id bigint, dims int, data binary")
    made = placed.repartitionByRange(int(parts), *order).sortWithinPartitions(*order).mapInArrow(pack, _BALLS)
    return Balls(stage(made, "balls", GROUP_BYTES), int(parts))


# ---- seeds ---------------------------------------------------------------------


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per id, the same in every run."""
    h = ids.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) / 2.0**64


def _gaps(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, never negative."""
    gaps = (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * (x @ centers.T)
    return np.maximum(gaps, 0)


def candidates(packed: DataFrame, per_round: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, weights) of the points that seeds are drawn from, by k-means||.

    Each round takes at most about ``per_round`` points, likelier the farther
    they are from all taken so far, so a few hundred come to the driver
    whatever the table holds.  A weight is the number of points nearest to a
    vector.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest = None
        for batch in batches:
            for ids, x in _exact_rows_of(batch):
                drawn = _uniform(ids, seed)
                i = int(drawn.argmin())
                here = (float(drawn[i]), x[i].tobytes())
                lowest = here if lowest is None else min(lowest, here)
        if lowest:
            yield pa.RecordBatch.from_pydict({"draw": pa.array([lowest[0]]), "data": pa.array([lowest[1]], pa.binary())})

    def gaps_to(x: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gaps = _gaps(x, taken)
        near = gaps.min(axis=1)
        near[near < _SLACK * (1 + (x * x).sum(axis=1))] = 0  # rounding of an equal point
        return near, gaps.argmin(axis=1)

    def round_(taken: np.ndarray, cost: float, salt: int) -> tuple[np.ndarray, float]:
        """(points taken with odds by ``cost``, the cost of ``taken``)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, found = 0.0, []
            for batch in batches:
                for ids, x in _exact_rows_of(batch):
                    near, _ = gaps_to(x, taken)
                    total += float(near.sum())
                    if cost > 0:
                        found += [row.tobytes() for row in x[_uniform(ids, salt) * cost < per_round * near]]
            yield pa.RecordBatch.from_pydict(
                {"cost": pa.array([total] + [0.0] * len(found)), "data": pa.array([None, *found], pa.binary())}
            )

        # A number per task and about ``per_round`` points.
        rows = packed.mapInArrow(run, "cost double, data binary").collect()
        return np.array([np.frombuffer(r["data"]) for r in rows if r["data"]]), sum(r["cost"] for r in rows)

    def weigh(taken: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = np.zeros(len(taken), np.int64)
            for batch in batches:
                for _, x in _exact_rows_of(batch):
                    weights += np.bincount(gaps_to(x, taken)[1], minlength=len(taken))
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(taken))), "n": pa.array(weights)})

        rows = packed.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
        out = np.zeros(len(taken))
        for r in rows:
            out[r["at"]] = r["n"]
        return out

    lowest = packed.mapInArrow(first, "draw double, data binary").orderBy("draw", "data").first()
    if lowest is None:
        return np.empty((0, 0)), np.zeros(0)
    taken = np.frombuffer(lowest["data"])[None, :]
    _, cost = round_(taken, 0.0, seed)
    for i in range(rounds):
        if cost <= 0:
            break
        more, cost = round_(taken, cost, seed + i + 1)
        if len(more):
            taken = np.unique(np.concatenate((taken, more)), axis=0)
    weights = weigh(taken)
    return taken[weights > 0], weights[weights > 0]


def seeds(vectors: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` different vectors, or all if there are fewer, by weighted k-means++."""
    rng = np.random.default_rng(seed)
    if len(vectors) <= k:
        return vectors.copy()
    chosen = [int(rng.choice(len(vectors), p=weights / weights.sum()))]
    near = _gaps(vectors, vectors[chosen])[:, 0]
    while len(chosen) < k:
        near[chosen] = 0
        odds = weights * near
        if odds.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(vectors), p=odds / odds.sum())))
        near = np.minimum(near, _gaps(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


# ---- passes --------------------------------------------------------------------


class _Sums:
    """Sizes, sums and costs of models with padded centres, filled ball by ball."""

    def __init__(self, models: list[np.ndarray]):
        self.wide = max(len(c) for c in models)
        self.dims = models[0].shape[1]
        self.centers = np.zeros((len(models), self.wide, self.dims))
        self.real = np.zeros((len(models), self.wide), bool)
        for m, c in enumerate(models):
            self.centers[m, : len(c)] = c
            self.real[m, : len(c)] = True
        self.squares = np.where(self.real, (self.centers**2).sum(axis=2), np.inf)
        self.longest = float(self.squares[self.real].max())
        self.sizes = np.zeros((len(models), self.wide))
        self.sums = np.zeros((len(models), self.wide, self.dims))
        self.total = 0.0  # squared lengths of all points
        self.looked_at = 0  # (point, centre) pairs whose distance was taken
        self.products: dict[tuple, tuple] = {}

    @property
    def costs(self) -> np.ndarray:
        """Summed squared distances, which follow from what the centres' members sum to."""
        squares = np.where(self.real, self.squares, 0)
        along = np.einsum("mkd,mkd->m", self.centers, self.sums)
        return np.maximum(self.total + (self.sizes * squares).sum(axis=1) - 2 * along, 0)

    def reach(self, means: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """[balls, models, centres] that may be nearest to a point of a ball."""
        flat = self.centers.reshape(-1, self.dims)
        squares = (means * means).sum(axis=1)[:, None] + (flat * flat).sum(axis=1) - 2 * (means @ flat.T)
        gaps = np.sqrt(np.maximum(squares, 0)).reshape(len(means), *self.real.shape)
        gaps[:, ~self.real] = np.inf
        nearest = gaps.min(axis=2, keepdims=True)
        return gaps <= nearest + 2 * radii[:, None, None] + _SLACK * (1 + nearest)

    def add(self, points: list[np.ndarray], means: np.ndarray, totals: np.ndarray, radii: np.ndarray, squares: np.ndarray) -> None:
        """Some balls at once."""
        reach = self.reach(means, radii)
        one = reach.sum(axis=2) == 1
        counts = np.array([len(x) for x in points], np.float64)
        self.total += float(squares.sum())
        # Whole balls: [balls, models * centres] with a 1 where a ball goes to the one centre left.
        if one.any():
            whole = (reach & one[:, :, None]).reshape(len(points), -1).astype(np.float64)
            self.sizes += (counts @ whole).reshape(self.sizes.shape)
            self.sums += (whole.T @ totals).reshape(self.sums.shape)
        # The others point by point: balls of much the same reach together, the rest each for itself.
        left = (reach & ~one[:, :, None]).sum(axis=(1, 2))
        plain = left * 2 > reach.shape[1] * reach.shape[2]
        together: dict[str, list[int]] = {}
        for b in np.flatnonzero(left > 0):
            if not plain[b]:
                self._points([points[b]], reach[b : b + 1], one[b : b + 1])
                continue
            some = together.setdefault(points[b].dtype.str, [])
            if some and sum(len(points[i]) for i in some) + len(points[b]) > _ROWS_AT_ONCE:
                self._points([points[i] for i in some], reach[some], one[some])
                some.clear()
            some.append(b)
        for some in together.values():
            if some:
                self._points([points[i] for i in some], reach[some], one[some])

    def _met(self, m: np.ndarray, some: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """(-2 times the centres ``some`` of the models ``m``, their squared lengths) as ``kind``."""
        key = (m.tobytes(), some.tobytes(), kind.str)
        if key not in self.products:
            self.products.clear()
            centers = self.centers[m].reshape(-1, self.dims)[some]
            self.products[key] = ((-2 * centers).astype(kind), self.squares[m].ravel()[some].astype(kind)[:, None])
        return self.products[key]

    def _points(self, points: list[np.ndarray], reach: np.ndarray, one: np.ndarray) -> None:
        x = points[0] if len(points) == 1 else np.concatenate(points)
        ball = np.repeat(np.arange(len(points)), [len(p) for p in points])
        m = np.flatnonzero(~one.all(axis=0))  # models with something to look at
        some = np.flatnonzero(reach[:, m].any(axis=0).ravel())
        centers, squares = self._met(m, some, x.dtype)
        begins = np.searchsorted(some, np.arange(len(m) + 1) * self.wide)
        gone = one[:, m]  # balls that have gone as a whole
        step = max(1, min(_ROWS_AT_ONCE, _CELLS // len(some)))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            self.looked_at += len(part) * len(some)
            near = centers @ part.T
            near += squares
            slack = self._slack(part)
            mark = np.empty(near.shape, bool)
            for j, (first, last) in enumerate(zip(begins, begins[1:])):
                here = near[first:last]
                np.less_equal(here, here.min(axis=0) + slack, out=mark[first:last])
                if np.count_nonzero(mark[first:last]) > len(part):
                    self._settle(part, m[j], some[first:last] % self.wide, mark[first:last])
                if gone[:, j].any():
                    mark[first:last, gone[ball[at : at + step], j]] = False
            sizes, sums = self.sizes.reshape(-1), self.sums.reshape(-1, self.dims)
            to = m[some // self.wide] * self.wide + some % self.wide
            sizes[to] += np.count_nonzero(mark, axis=1)
            sums[to] += mark.astype(x.dtype) @ part

    def _slack(self, part: np.ndarray) -> np.ndarray:
        """How far apart rounding may set two equal distances of these points; nothing in double precision."""
        if part.dtype == np.float64:
            return np.float64(0)
        unit = 4 * (self.dims + 4) * 2.0**-24
        length = float(np.square(part).sum(axis=1).max())
        return np.float32(unit * (np.sqrt(length * self.longest) + self.longest))

    def _settle(self, part: np.ndarray, m: int, of: np.ndarray, mark: np.ndarray) -> None:
        """One centre for points that several centres of a model are as near to: in double precision, then the first."""
        doubt = np.flatnonzero(np.count_nonzero(mark, axis=0) > 1)
        x = part[doubt].astype(np.float64, copy=False)
        nearest = (self.squares[m, of] - 2 * (x @ self.centers[m, of].T)).argmin(axis=1)
        mark[:, doubt] = False
        mark[nearest, doubt] = True


_PASS = "model int, cost double, sizes binary, sums binary, looked_at bigint"


# Rows per model that a pass may send to the driver without summing them first.
_UNSUMMED = 4


def pass_rows(held: Balls, models: list[np.ndarray]) -> DataFrame:
    """What one scan of the balls finds: a row per model, or up to _UNSUMMED where there are few tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(models)
        for batch in batches:
            stats = [np.array([np.frombuffer(v.as_buffer()) for v in batch.column(c)]) for c in ("mean", "total")]
            stats += [np.asarray(batch.column(c)) for c in ("radius", "squares")]
            points = [x for _, x in _rows_of(batch)]
            for at in range(0, len(points), BALLS_AT_ONCE):
                some = slice(at, at + BALLS_AT_ONCE)
                sums.add(points[some], *[v[some] for v in stats])
        costs = sums.costs
        for m in range(len(models)):
            yield _found(m, costs[m], sums.sizes[m], sums.sums[m], sums.looked_at if m == 0 else 0)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                sizes, sums = np.frombuffer(r["sizes"]), np.frombuffer(r["sums"])
                if r["model"] not in totals:
                    totals[r["model"]] = [0.0, np.zeros_like(sizes), np.zeros_like(sums), 0]
                total = totals[r["model"]]
                total[0] += r["cost"]
                total[1] += sizes
                total[2] += sums
                total[3] += r["looked_at"]
        for m, total in totals.items():
            yield _found(m, *total)

    found = held.rows.mapInArrow(run, _PASS)
    return found.repartition("model").mapInArrow(add_up, _PASS) if held.parts > _UNSUMMED else found


def one_pass(held: Balls, models: list[np.ndarray]) -> tuple[list[Model], int]:
    """(what one scan of the balls finds for every set of centres, how many distances it took)."""
    found = pass_rows(held, models).collect()
    out = [Model(len(c), c, np.zeros(len(c), np.int64), np.zeros_like(c), 0.0) for c in models]
    for r in sorted(found, key=lambda r: r["cost"]):
        k, d = models[r["model"]].shape
        model = out[r["model"]]
        model.cost += r["cost"]
        model.sizes = model.sizes + np.rint(np.frombuffer(r["sizes"])[:k]).astype(np.int64)
        model.sums = model.sums + np.frombuffer(r["sums"]).reshape(-1, d)[:k]
    return out, sum(r["looked_at"] for r in found)


def _found(m: int, cost: float, sizes: np.ndarray, sums: np.ndarray, looked_at: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "model": pa.array([m], pa.int32()),
            "cost": pa.array([float(cost)]),
            "sizes": pa.array([np.ascontiguousarray(sizes).tobytes()], pa.binary()),
            "sums": pa.array([np.ascontiguousarray(sums).tobytes()], pa.binary()),
            "looked_at": pa.array([int(looked_at)], pa.int64()),
        }
    )


def moved(model: Model) -> np.ndarray:
    """The members' means; the centre of no member stays."""
    full = model.sizes > 0
    out = model.centers.copy()
    out[full] = model.sums[full] / model.sizes[full][:, None]
    return out


def advance(held: Balls, starts: list[np.ndarray], most: int, tolerance: float = 1e-4) -> list[Model]:
    """Lloyd's steps from all ``starts`` until no centre of a model moves more than ``tolerance``.

    One scan per step serves all models that still move.
    """
    done: list[Model | None] = [None] * len(starts)
    centers = dict(enumerate(starts))
    for step in range(1, most + 1):
        turn = sorted(centers)
        for i, model in zip(turn, one_pass(held, [centers[i] for i in turn])[0]):
            model.steps = step
            after = moved(model)
            done[i] = model
            if np.sqrt(((after - model.centers) ** 2).sum(axis=1)).max() <= tolerance:
                del centers[i]
            else:
                centers[i] = after
        if not centers:
            break
    return done


def silhouettes(held: Balls, models: list[Model]) -> list[float | None]:
    """Mean cosine silhouette of every model, from one scan; None with fewer than two clusters.

    The points have unit length.  A point's mean distance to a cluster follows
    from the cluster's vector sum; one alone in its cluster scores 0.
    """
    fit = [m for m in models if m.filled > 1]
    if not fit:
        return [None] * len(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows = np.zeros(len(fit)), 0
        for batch in batches:
            points = [x for _, x in _rows_of(batch)]
            for first in range(0, len(points), BALLS_AT_ONCE):
                x = np.concatenate(points[first : first + BALLS_AT_ONCE]).astype(np.float64, copy=False)
                rows += len(x)
                for j, model in enumerate(fit):
                    squares = (model.centers**2).sum(axis=1)
                    own = (squares - 2 * (x @ model.centers.T)).argmin(axis=1)
                    apart = model.sizes - x @ model.sums.T  # summed distances to each cluster
                    at = np.arange(len(x))
                    n = model.sizes[own]
                    a = apart[at, own] / np.maximum(n - 1, 1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        mean = np.where(model.sizes > 0, apart / model.sizes, np.inf)
                    mean[at, own] = np.inf
                    b = mean.min(axis=1)
                    high = np.maximum(a, b)
                    score = np.where((n > 1) & (high > 0), (b - a) / np.where(high > 0, high, 1), 0.0)
                    totals[j] += score.sum()
        yield pa.RecordBatch.from_pydict(
            {"at": pa.array(np.arange(len(fit)), pa.int64()), "score": pa.array(totals), "n": pa.array([rows] * len(fit), pa.int64())}
        )

    found = held.rows.mapInArrow(run, "at bigint, score double, n bigint").groupBy("at").agg(F.sum("score"), F.sum("n")).collect()
    scores = {at: score / n for at, score, n in found}
    order = iter(range(len(fit)))
    return [scores[next(order)] if m.filled > 1 else None for m in models]


def fit_many(points: DataFrame, jobs: Iterable[tuple[int, int]], cfg: AuditConfig) -> tuple[list[Model], list[float | None]]:
    """(models, silhouettes) for every (k, restart) of ``jobs``; only the cheapest of a k is scored.

    A model has fewer than k centres where there are fewer different points;
    without points there are no models.
    """
    jobs = list(jobs)
    # Read again from its files in every pass: cached, a partition is one value of the heap.
    packed = blocks(points)
    vectors, weights = candidates(packed, cfg.seed_factor * max(k for k, _ in jobs), cfg.seed_rounds, cfg.seed)
    if not len(vectors):
        return [], []
    held = balls(packed, vectors)
    starts = [seeds(vectors, weights, k, cfg.seed * 1000 + k * 100 + r) for k, r in jobs]
    models = advance(held, starts, cfg.kmeans_max_iter, cfg.kmeans_tolerance)
    best: dict[int, int] = {}
    for i, (k, _) in enumerate(jobs):
        if k not in best or models[i].cost < models[best[k]].cost:
            best[k] = i
    cheapest = sorted(best.values())
    scores: list[float | None] = [None] * len(models)
    for i, score in zip(cheapest, silhouettes(held, [models[i] for i in cheapest])):
        scores[i] = score
    return models, scores
