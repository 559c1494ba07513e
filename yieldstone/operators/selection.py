"""Values at given ranks by selection: a few counts over fixed numbers of cells, without sorting."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that a pass counts.
CELLS = 4096
_MOST = sys.float_info.max


def _cell(value: Column, low: float, high: float, cells: int) -> Column:
    """A number from 0 to ``cells - 1`` that never falls as the value rises; both ends have cells of their own."""

    def bounded(v: Column) -> Column:
        return F.least(F.greatest(v, F.lit(-_MOST)), F.lit(_MOST)) / 2

    base, top = max(-_MOST, low) / 2, min(_MOST, high) / 2
    share = (bounded(value) - base) / (top - base) if top > base else F.lit(0.5)
    inner = F.least(F.greatest(F.floor(share * (cells - 2)), F.lit(0)), F.lit(cells - 3)) + 1
    return F.when(value == low, 0).when(value == high, cells - 1).otherwise(inner).cast("int")


def values_at(df: DataFrame, column: str, ranks: list[int], cells: int = CELLS) -> list[float]:
    """The values of a column of doubles at ranks counted from 0 in ascending order; nulls and NaN aren't counted.

    Each pass counts the values of every cell between two bounds, with least and greatest value of each, and goes on in
    the cell that a rank falls into, until that cell has a single value. Tasks send a row a cell at most, and every pass
    narrows the bounds to values that occur, so equal values in any number do no harm.
    """
    known = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found: dict[int, float] = {}
    spans: list[tuple[float, float, int, list[int]]] = []
    low, high = known.agg(F.min("v"), F.max("v")).first()
    if low is not None:
        spans.append((low, high, 0, sorted(set(ranks))))
    while spans:
        low, high, before, wanted = spans.pop()
        if low == high:
            found |= dict.fromkeys(wanted, low)
            continue
        inside = known.where(F.col("v").between(F.lit(low), F.lit(high)))
        counts = inside.groupBy(_cell(F.col("v"), low, high, cells).alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for cell in sorted(counts.collect()):  # ``cells`` rows at most
            here = [r for r in wanted if before <= r < before + cell["n"]]
            if here:
                spans.append((cell["lo"], cell["hi"], before, here))
            before += cell["n"]
    return [found[r] for r in ranks]


def selected_median(df: DataFrame, column: str, name: str, cells: int = CELLS) -> DataFrame:
    """One row: the exact median of a column, nulls left out; null for none."""
    n = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).count()
    median = None
    if n:
        low, high = values_at(df, column, [(n - 1) // 2, n // 2], cells)
        median = low + (high - low) * 0.5 if low < high else low
    return df.limit(0).agg(F.lit(median).cast("double").alias(name))
