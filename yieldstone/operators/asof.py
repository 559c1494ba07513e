"""As-of join: to each row the newest record of its key at or before its time.

Both sides are put into one order and the last record is carried along, so no pair is formed and a key's work is linear. A key
is cut into slices of time that are shuffled apart, so a key with a large share of all rows is many tasks; what a slice
inherits from the ones before it comes from a table of one row per key and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a slice.
SLICE_DAYS = 366


def _slice(at: Column, days: int) -> Column:
    return F.floor(F.unix_date(at.cast("date")) / days).cast("int")


def newest_records(records: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """One row per key and time: of records at one time the greatest by ``values``, nulls least."""
    told = records.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    return told.groupBy(key, at).agg(F.max(F.struct(*values)).alias("_record"))


def as_of(rows: DataFrame, records: DataFrame, key: str, row_at: str, record_at: str, values: list[str], slice_days: int = SLICE_DAYS) -> DataFrame:
    """``rows`` with ``values`` of the newest record of the same key whose time is at or before the row's, else null.

    A record's null values are taken as they are. Rows without key or time get nulls; columns of ``rows`` named
    like the values are replaced. Times of both sides are compared as timestamps, a date being its midnight.
    """
    kept = [c for c in rows.columns if c not in values]
    known = newest_records(records, key, record_at, values).select(
        F.col(key).alias("_key"), F.col(record_at).cast("timestamp").alias("_at"), _slice(F.col(record_at), slice_days).alias("_slice"), "_record"
    )
    left = rows.select(
        F.col(key).alias("_key"), F.col(row_at).cast("timestamp").alias("_at"), _slice(F.col(row_at), slice_days).alias("_slice"),
        F.lit(2).alias("_kind"), F.struct(*kept).alias("_row"),
    )

    # What each slice of a key inherits: the last record of the nearest slice before it that has one.
    last = known.groupBy("_key", "_slice").agg(F.max_by("_record", "_at").alias("_record"))
    needed = left.select("_key", "_slice").distinct().join(last, ["_key", "_slice"], "full")
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = needed.withColumn("_record", F.last("_record", ignorenulls=True).over(earlier)).where(F.col("_record").isNotNull())

    entries = known.withColumn("_kind", F.lit(1)).unionByName(
        carried.withColumns({"_at": F.lit(None).cast("timestamp"), "_kind": F.lit(0)})  # a null time sorts first
    )
    so_far = Window.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = left.withColumn("_record", F.lit(None).cast(dict(known.dtypes)["_record"])).unionByName(
        entries.withColumn("_row", F.lit(None).cast(dict(left.dtypes)["_row"]))
    )
    found = both.withColumn("_record", F.last("_record", ignorenulls=True).over(so_far)).where(F.col("_kind") == 2)
    timed = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    return found.select(*[F.col("_row")[c].alias(c) for c in kept], *[F.when(timed, F.col("_record")[v]).alias(v) for v in values])
