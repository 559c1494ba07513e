"""Row numbers, ranks and tiles inside groups of any size.

A window partitioned by date alone puts a whole day into one task, and a day has as many rows as
there are tickers. Here a group is cut into slices of consecutive order instead: rows are numbered
inside a slice, and the sizes of the slices before it are added.

The cuts come from a hash sample of the sort keys, one in ``2**SAMPLE_BITS``. The sample is a pure
function of the data, so a recomputed task cuts in the same places; small groups have no cut and
cost one window. At most ``MAX_CUTS`` keys are kept, chosen by hash as well, which bounds what is
broadcast. Cuts only steer how work is split; every row is numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_BITS = 20
MAX_CUTS = 200_000


def _sliced(df: DataFrame, group: str, key: list[str], sample_bits: int, max_cuts: int) -> DataFrame:
    """Add ``_slice``: how many cuts of the group are at or below the row's key."""
    spot = F.xxhash64(F.lit("cut"), group, *key)
    cuts = (
        df.select(group, *key)
        .withColumn("_spot", spot)
        .filter(F.col("_spot").bitwiseAND(F.lit((1 << sample_bits) - 1)) == 0)
        .orderBy("_spot", group, *key)
        .limit(max_cuts)
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(F.struct(*key))).alias("_cuts"))
    )
    here = F.struct(*key)
    # Binary search: the powers of two below the number of cuts, largest first, each taken if the cut there is not above.
    powers = F.reverse(F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size("_cuts").cast("long"))) - 1), lambda i: F.call_function("shiftleft", F.lit(1), i)))
    below = F.aggregate(
        powers,
        F.lit(0),
        lambda at, step: F.when((at + step <= F.size("_cuts")) & (F.get("_cuts", at + step - 1) <= here), at + step).otherwise(at),
    )
    return (
        df.join(F.broadcast(cuts), group, "left")
        .withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(below))
        .drop("_cuts")
    )


def running_total(
    df: DataFrame,
    group: str,
    key: list[str],
    weight: Column,
    total: str,
    group_total: str | None = None,
    sample_bits: int = SAMPLE_BITS,
    max_cuts: int = MAX_CUTS,
) -> DataFrame:
    """Add ``total``: the sum of ``weight`` over the group's rows up to and including this one.

    Rows are taken in ascending order of ``key``, which must be unique in its group; ``group`` is a
    column without NULLs, such as a partition date. With ``group_total`` the sum over the whole
    group is added as well.
    """
    sliced = _sliced(df.withColumn("_w", weight.cast("bigint")), group, key, sample_bits, max_cuts)
    in_order = Window.partitionBy(group).orderBy("_slice")
    sizes = (
        sliced.groupBy(group, "_slice")
        .agg(F.sum("_w").alias("_size"))
        .select(
            F.col(group).alias("_group"),
            F.col("_slice").alias("_s"),
            F.coalesce(F.sum("_size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_size").over(Window.partitionBy(group)).alias("_all"),
        )
    )
    inside = Window.partitionBy(group, "_slice").orderBy(*key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Equality on exactly the window's keys, so that the join and the window share one shuffle.
    placed = sliced.join(sizes, (F.col(group) == F.col("_group")) & (F.col("_slice") == F.col("_s")), "inner").withColumn(
        total, F.sum("_w").over(inside) + F.col("_before")
    )
    if group_total:
        placed = placed.withColumn(group_total, F.col("_all"))
    return placed.drop("_w", "_slice", "_group", "_s", "_before", "_all")


def row_number_in(df: DataFrame, group: str, key: list[str], name: str, group_size: str | None = None, **cut) -> DataFrame:
    """Add the row number inside the group, by a key that is unique there."""
    return running_total(df, group, key, F.lit(1), name, group_size, **cut)


def rank_in(df: DataFrame, group: str, value: str, name: str, **cut) -> DataFrame:
    """Add the rank by ``value`` ascending; equal values share the lowest number.

    Equal values are first merged into one row with a count, so a value held by a large share of a
    group is no hot key in the ranking; attaching the ranks is a plain join, whose skewed keys AQE
    splits.
    """
    runs = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(runs, group, [value], F.col("_n"), "_upto", **cut).select(
        F.col(group).alias("_group"),
        F.col(value).alias("_value"),
        (F.col("_upto") - F.col("_n") + 1).alias(name),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(ranked, same, "inner").drop("_group", "_value")


def tile_of(row_number: Column, group_size: Column, tiles: int) -> Column:
    """The NTILE number: the first ``group_size % tiles`` tiles hold one row more than the others."""
    small = F.floor(group_size / tiles)
    larger = group_size % tiles
    boundary = larger * (small + 1)
    tile = F.when(row_number <= boundary, F.ceil(row_number / (small + 1))).otherwise(
        larger + F.ceil((row_number - boundary) / F.greatest(small, F.lit(1)))
    )
    return tile.cast("bigint")
