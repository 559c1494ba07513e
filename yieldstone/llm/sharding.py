"""Shards along a Hilbert curve over several metadata columns.

Each column is quantised into cells of about equal row counts, strings by whole values, the cells' place on the curve orders the rows, and the
order is cut into runs of equal length. Rows near each other in all columns share a shard and the row groups in it,
so minima and maxima of files prune filters on any of the columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: 2 ** (bits * columns) entries at most in the table of the curve, a constant of the plan.
MAX_CELLS = 1 << 16
ROWS_PER_TASK = 250_000


def hilbert_index(cell: Sequence[int], bits: int) -> int:
    """Place of a cell on the Hilbert curve with 2 ** bits cells to a side (Skilling 2004, axes to transpose)."""
    x, n = list(cell), len(cell)
    side = 1 << (bits - 1)
    q = side
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = 0, side
    while q > 1:
        if x[n - 1] & q:
            flip ^= q - 1
        q >>= 1
    x = [v ^ flip for v in x]
    return sum(((x[i] >> b) & 1) << (b * n + n - 1 - i) for b in range(bits) for i in range(n))


def string_cuts(df: DataFrame, column: str, cells: int) -> list[str]:
    """At most ``cells - 1`` values of a string column, whole, that cut its rows into cells of about equal counts.

    Different values are counted first, put in order over all tasks, and their counts summed up inside each task and over
    the tasks before it, so neither a frequent value nor many different ones are any single task's work.
    """
    scratch = Scratch(df.sparkSession, "cuts")
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    values = scratch.keep(values, "values")
    different = values.count()
    parts = min(max(1, different), max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-different // ROWS_PER_TASK)))
    placed = values.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id())
    placed = scratch.keep(placed, "placed")
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, starts = 0, []
    for part in range(parts):
        starts.append(before)
        before += sizes.get(part, 0)
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    upto = placed.withColumn("upto", inside + F.get(F.lit(starts), F.col("part")))
    # a cut is the value at the first row of its cell
    targets = [before * k // cells for k in range(1, cells)]
    hit = reduce(lambda any_, t: any_ | ((F.col("upto") - F.col("n") <= t) & (F.lit(t) < F.col("upto"))), targets, F.lit(False))
    cuts = [r["value"] for r in upto.where(hit).select("value").collect()]  # cells - 1 at most
    scratch.drop()
    return sorted(cuts, key=lambda v: v.encode())


def quantised(value: Column, cuts: Sequence[float | str]) -> Column:
    """How many cuts the value reaches; a null lies below all. Strings are compared whole."""
    return reduce(lambda total, cut: total + F.coalesce((value >= cut).cast("int"), F.lit(0)), cuts, F.lit(0))


def curve_position(df: DataFrame, dimensions: Sequence[str], bits: int = 4) -> DataFrame:
    """``df`` with ``curve``, the Hilbert index of the row's cell.

    One pass finds the cuts of all columns of numbers; a column of strings takes one of its own, cut by whole values.
    """
    cells = 1 << bits
    if cells ** len(dimensions) > MAX_CELLS:
        raise ValueError(f"{len(dimensions)} columns of {bits} bits need more than {MAX_CELLS} cells")
    shares = [k / cells for k in range(1, cells)]
    kinds = dict(df.dtypes)
    numbers = [c for c in dimensions if kinds[c] != "string"]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in numbers]).first() if numbers else {}
    place = F.lit(0)
    for column in dimensions:
        if column in numbers:
            place = place * cells + quantised(F.col(column).cast("double"), sorted(set(found[column] or [])))
        else:
            place = place * cells + quantised(F.col(column), string_cuts(df, column, cells))
    side = [[(k >> (bits * (len(dimensions) - 1 - i))) & (cells - 1) for i in range(len(dimensions))] for k in range(cells ** len(dimensions))]
    curve = F.lit([hilbert_index(cell, bits) for cell in side])
    return df.withColumn("curve", F.get(curve, place))


def ranked(df: DataFrame, order: Sequence[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``df`` with ``rank``, 0 for the first row in the order, and the number of rows.

    Rows are range-partitioned and sorted once and stored; a row's rank is its place in its partition plus the rows of
    the partitions before, of which there is one count each. Range bounds come from a sample and cut hot values
    by the later columns of the order, so no task gets more than its share.
    """
    total = df.count()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_TASK))
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed = scratch.keep(placed, "ranked")
    part = F.shiftright("__at", 33)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for p in range(max(counts, default=-1) + 1):
        starts.append(before)
        before += counts.get(p, 0)
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    start = F.get(F.lit(starts), part.cast("int")) if starts else F.lit(0)
    return placed.withColumn("rank", start.cast("long") + inside).drop("__at"), total


def shard_rows(df: DataFrame, dimensions: Sequence[str], ties: Sequence[str], shards: int = 8, bits: int = 4) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``: equal runs of the curve's order, slots gapless from 0 in each.

    Counts of shards differ by one at most. Nulls take the lowest cell of their column, rows in one cell follow
    ``ties``, fully equal rows each get their own slot, an empty table gives an empty result. ``df`` should hold
    narrow rows (ids and metadata), as it is moved and stored once. Columns named like the results are replaced.
    """
    scratch = Scratch(df.sparkSession, "shards")
    rows, total = ranked(curve_position(df, dimensions, bits), ["curve", *ties], scratch)
    shard = F.expr(f"cast(rank * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {max(total, 1)} + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank")


def shard_ranges(sharded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column in each shard: what a reader prunes by."""
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *bounds)


def write_shards(sharded: DataFrame, path: str, shards: int = 8) -> None:
    """One folder a shard; rows inside stay in curve order, so that row groups prune as well."""
    (
        sharded.repartitionByRange(shards, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    )
