"""Positions, ranks, tiles and quantiles without one-task windows.

Two devices cover all of them.  ``dense_positions`` numbers rows by a range
partitioning plus per-partition offsets.  ``value_ladder`` counts rows per
distinct value first and ranks the values, so what gets sorted grows with the
number of distinct values and not with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.sources.staging import stage

# monotonically_increasing_id() keeps the partition in the bits above these.
_POSITION_BITS = 33


def dense_positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 1..N by ``order``, which must be unique.

    The range partitioning and the position inside each partition are frozen
    by staging the frame; the offsets are one number per partition.
    """
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id()),
        f"positions-{name}",
    )
    part = F.shiftright("__at", _POSITION_BITS)
    within = F.col("__at") - F.shiftleft(F.shiftright("__at", _POSITION_BITS), _POSITION_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("__part"))
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    # One row per partition of the staged table, so the broadcast stays small.
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + within + 1)
        .drop("__at", "__part", "__offset")
    )


def nth_row(df: DataFrame, order: list[str], n: int):
    """The n-th row (from 1) of ``df`` by ``order``, which must be unique; None beyond the end.

    The rows are range-partitioned, so no task ever holds n of them.
    """
    return dense_positions(df.select(*order), order, "__nth").filter(F.col("__nth") == n).first()


def value_ladder(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """(groups, values, n, n_before, n_total): how many rows lie below each value."""
    counts = df.groupBy(*groups, *values).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*groups)
    below = whole.orderBy(*values).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "*",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("n_before"),
        F.sum("n").over(whole).alias("n_total"),
    )


def value_at(value: str, position: Column) -> Column:
    """Aggregate over a ladder: the value at a 0-based sorted position."""
    here = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
    return F.max(F.when(here, F.col(value)))


def tile_of(position: Column, total: Column, tiles: int) -> Column:
    """NTILE number of a 0-based position: the first ``total % tiles`` tiles hold one more."""
    base = F.call_function("div", total, F.lit(tiles))
    extra = total % tiles
    wide = extra * (base + 1)
    return F.when(
        position < wide, F.call_function("div", position, base + 1) + 1
    ).otherwise(extra + F.call_function("div", position - wide, F.greatest(base, F.lit(1))) + 1)


def assign_ntile(df: DataFrame, value: str, row_id: str, tiles: int, name: str) -> DataFrame:
    """NTILE(tiles) OVER (ORDER BY value, row_id) for every row.

    All rows of most values share a tile, which a comparison with that tile's
    range settles in place.  The values that straddle a tile boundary, fewer
    than ``tiles`` of them, have their rows numbered by ``dense_positions``.
    """
    ladder = value_ladder(df, [], [value])
    total = F.col("n_total")
    ladder = ladder.withColumns(
        {
            "first_tile": tile_of(F.col("n_before"), total, tiles),
            "last_tile": tile_of(F.col("n_before") + F.col("n") - 1, total, tiles),
        }
    )
    settled = F.col("first_tile") == F.col("last_tile")
    # At most `tiles` ranges and `tiles - 1` straddling values come back.
    plan = (
        ladder.groupBy(
            F.when(settled, F.col("first_tile")).alias("tile"),
            F.when(~settled, F.col(value)).alias("straddler"),
        )
        .agg(
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
            F.min("n_before").alias("n_before"),
            F.sum("n").alias("n"),
            F.max("n_total").alias("n_total"),
        )
        .collect()
    )
    ranges = [r for r in plan if r["tile"] is not None]
    straddlers = sorted((r for r in plan if r["tile"] is None), key=lambda r: r["lo"])
    tile = F.coalesce(
        *[
            F.when(F.col(value).between(r["lo"], r["hi"]), F.lit(r["tile"]))
            for r in ranges
        ],
        F.lit(None).cast("bigint"),
    )
    split = [r["lo"] for r in straddlers]
    if not split:
        return df.withColumn(name, tile)
    in_place = df.filter(~F.col(value).isin(split)).withColumn(name, tile)

    numbered = dense_positions(df.filter(F.col(value).isin(split)), [value, row_id], "__pos")
    position, passed = F.lit(None).cast("bigint"), 0
    for r in straddlers:
        shift = r["n_before"] - passed - 1
        position = F.when(F.col(value) == r["lo"], F.col("__pos") + shift).otherwise(position)
        passed += r["n"]
    total_rows = F.lit(straddlers[0]["n_total"])
    return in_place.unionByName(
        numbered.withColumn(name, tile_of(position, total_rows, tiles)).drop("__pos")
    )


def sketched_quantiles(
    df: DataFrame, group: str, value: str, shares: list[float], accuracy: int = 1000
) -> DataFrame:
    """(group, share, n, low, high): where a mergeable sketch puts each quantile, two error bounds wide.

    The sketch's rank is off by at most n / ``accuracy``, so the value of rank
    ceil(share * n) lies in [low, high].
    """
    off = 2.0 / accuracy
    asked = [x for s in shares for x in (max(s - off, 0.0), min(s + off, 1.0))]
    sketch = df.groupBy(group).agg(
        F.count(value).alias("n"), F.percentile_approx(value, asked, accuracy).alias("found")
    )
    each = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("share"),
                    F.get("found", F.lit(2 * i)).alias("low"),
                    F.get("found", F.lit(2 * i + 1)).alias("high"),
                )
                for i, s in enumerate(shares)
            ]
        )
    )
    return sketch.filter("n > 0").select(group, "n", each)


def quantiles_by_sketch(
    df: DataFrame, group: str, value: str, shares: list[float], accuracy: int = 1000
) -> DataFrame:
    """(group, share, n, value): exactly the value of rank ceil(share * n), at least 1, of each group.

    A sketch brackets each quantile; one more scan counts the rows below a
    bracket and, per value, those inside it.  What is sorted are the values of
    the brackets, some 4 / ``accuracy`` of a group's rows at most.  NULL
    values are left out; a group of them alone has no row.
    """
    # A row per group and share.
    brackets = stage(sketched_quantiles(df, group, value, shares, accuracy), "brackets")
    rows = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("__g"), F.col(value).alias("__v"))
    met = rows.join(F.broadcast(brackets), F.col("__g").eqNullSafe(F.col(group)))
    inside = F.col("__v") >= F.col("low")
    counts = (
        met.filter(F.col("__v") <= F.col("high"))
        .groupBy(group, "share", "n", F.when(inside, F.col("__v")).alias("at"))
        .agg(F.count("*").alias("rows"))
    )
    # NULL stands for all that lies below the bracket and sorts first.
    upto = Window.partitionBy(group, "share").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.greatest(F.ceil(F.round(F.col("share") * F.col("n"), 6)), F.lit(1))
    return (
        counts.withColumn("upto", F.sum("rows").over(upto))
        .filter(F.col("at").isNotNull() & (F.col("upto") >= rank))
        .groupBy(group, "share", "n")
        .agg(F.min("at").alias(value))
    )
