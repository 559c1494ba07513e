"""Stored tables: partitioned Parquet, ZSTD level 5, and the write semantics of each layer.

Every write is one Spark job over a whole set of dates. Rows are rebalanced by the partition column: Spark
gives each task its share of bytes at run time, several days to one task or one day to several. Inside a
file rows are sorted by ticker, so that row-group statistics skip on it. NaN is made NULL when a table is
written, so that reads are plain scans and filters on measures reach them.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from ..functions.scalars import day, nan_to_null
from ..schemas import (
    APPLIED,
    CHANGES,
    DIVIDEND,
    LANDED_PRICE,
    MARKS,
    MEMBERSHIP,
    METRICS,
    PRICE,
    PRICE_STATE,
    PRICE_VIEW,
    PROFILE,
    QUARANTINE,
    SPELLS,
    project,
)
from ..session import drop_path, few_listing_tasks, settle_path, swap_path
from .partitions import partition_values

CHANGE_KEY = ["effective_date", "action", "ticker"]
EVENT_KEY = ["ex_date", "ticker", "amount"]


def _opened(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    with few_listing_tasks(spark):
        return spark.read.schema(schema).parquet(path)


def scan_table(spark: SparkSession, path: str, schema: StructType, missing: str = "error") -> DataFrame:
    """Read a stored table; ``missing='empty'`` turns an absent path (and nothing else) into no rows.

    The scan stays lazy, so date filters prune partitions and unused columns are never read.
    """
    try:
        df = _opened(spark, path, schema)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        settle_path(spark, path)
        try:
            df = _opened(spark, path, schema)
        except AnalysisException as still:
            if missing == "empty" and still.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], schema)
            raise
    return df.select(*schema.names)  # partition columns are read last


def _without_nan(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: nan_to_null(F.col(name)) for name in doubles})


def rows_for_date(df: DataFrame, d: date | str | Column) -> DataFrame:
    return df.filter(F.col("date") == day(d))


def dividends_in_window(events: DataFrame, d: date | str | Column, lookback_days: int = 365) -> DataFrame:
    """Events with ``d - lookback <= ex_date <= d``; the collection date plays no part."""
    return events.filter(F.col("ex_date").between(F.date_sub(day(d), lookback_days), day(d)))


def exists_for_date(df: DataFrame, d: date | str | Column) -> DataFrame:
    """One row, one BOOLEAN ``present``; False when the table has no ``date`` column."""
    if "date" not in df.columns:
        return df.limit(0).agg(F.lit(False).alias("present"))
    return rows_for_date(df, d).limit(1).agg((F.count(F.lit(1)) > 0).alias("present"))


def dates_present(df: DataFrame, dates: DataFrame) -> DataFrame:
    """The same test for a whole column of dates: ``(date, present)``."""
    stored = df.select("date").distinct().withColumn("_hit", F.lit(True))
    return dates.join(stored, "date", "left").select("date", F.col("_hit").isNotNull().alias("present"))


def distinct_dates(df: DataFrame) -> DataFrame:
    return df.select("date").distinct()


def without_stored(incoming: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not stored yet. NULLs in a key are treated as values, as a set would."""
    on = None
    left, right = incoming.alias("i"), stored.select(*key).distinct().alias("s")
    for name in key:
        same = F.col(f"i.{name}").eqNullSafe(F.col(f"s.{name}"))
        on = same if on is None else on & same
    return left.join(right, on, "left_anti")


def _write(df: DataFrame, path: str, mode: str, partition: str | list[str] | None, sort: list[str], replace: str = "dynamic") -> None:
    """``replace='dynamic'`` overwrites only the partitions that occur in the rows. No rows, no write."""
    df = _without_nan(df)
    if replace == "static" and mode == "overwrite" and df.isEmpty():
        return  # it would empty the table
    parts = [partition] if isinstance(partition, str) else partition or []
    if parts:
        df = df.hint("rebalance", *[F.col(name) for name in parts]).sortWithinPartitions(*parts, *sort)
    writer = (
        df.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "5")
        .option("partitionOverwriteMode", replace)
    )
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def _replace(spark: SparkSession, df: DataFrame, path: str, partition: str | None, sort: list[str]) -> None:
    """Write the whole table beside the stored one and swap them; no rows is a no-op."""
    fresh = f"{path}__fresh_{uuid.uuid4().hex}"  # on the same file system, where a rename is no copy
    _write(df, fresh, "overwrite", partition, sort)
    settle_path(spark, path)
    if _opened(spark, fresh, df.schema).isEmpty():
        drop_path(spark, fresh)
        return
    swap_path(spark, fresh, path)


def _append_new(spark: SparkSession, rows: DataFrame, path: str, schema: StructType, key: list[str]) -> None:
    """Append rows whose key is not stored, looking only at stored rows that can hold one of the keys.

    The first column of a key is a date; its least and greatest value in the rows bound the scan.
    """
    span = rows.agg(F.min(key[0]), F.max(key[0])).first()
    if span[0] is None:
        return
    stored = scan_table(spark, path, schema, missing="empty").filter(F.col(key[0]).between(F.lit(span[0]), F.lit(span[1])))
    partition = "date"
    if "year" in schema.names:  # the year follows from the key
        partition = "year"
        stored = stored.filter(F.col("year").between(span[0].year, span[1].year))
    _write(without_stored(rows, stored, key), path, "append", partition, ["ticker"])


def write_price_if_absent(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Append the dates that are not stored; dates already there are left alone. What is stored is told by its folders."""
    rows, stored = project(incoming, PRICE), partition_values(spark, path, "date")
    if None in stored:
        rows = rows.where(F.col("date").isNotNull())
    listed = [F.lit(d).cast("date") for d in stored if d is not None]
    if listed:
        rows = rows.where(F.col("date").isNull() | ~F.col("date").isin(listed))
    _write(rows, path, "append", "date", ["ticker"])


def write_price_overwrite(incoming: DataFrame, path: str) -> None:
    """Replace exactly the dates that occur in ``incoming``."""
    _write(project(incoming, PRICE), path, "overwrite", "date", ["ticker"])


def append_dividends(spark: SparkSession, incoming: DataFrame, path: str, dedupe: bool = True) -> None:
    """Append events; with ``dedupe`` only what is not stored yet.

    Events are the same if ex_date, ticker and amount agree. Of each the store then holds as many copies as it had
    or as the batch brings, whichever is more; added copies carry the earliest collection date of the batch.
    An event of another amount on a known day is a new one.
    """
    rows = project(incoming, DIVIDEND)
    if not dedupe:
        _write(rows, path, "append", "date", ["ticker"])
        return
    span = rows.agg(F.min("ex_date"), F.max("ex_date")).first()
    if span[0] is None:
        return
    brought = rows.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("date", "ingest_at")).alias("_first"))
    stored = scan_table(spark, path, DIVIDEND, missing="empty").filter(F.col("ex_date").between(F.lit(span[0]), F.lit(span[1])))
    had = stored.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("_had")).alias("s")
    same = None
    for name in EVENT_KEY:
        agrees = F.col(f"b.{name}").eqNullSafe(F.col(f"s.{name}"))
        same = agrees if same is None else same & agrees
    more = F.col("_n") - F.coalesce("_had", F.lit(0))
    added = brought.alias("b").join(had, same, "left").filter(more > 0)
    copies = added.select("b.ex_date", "b.ticker", "b.amount", "_first.*", F.explode(F.sequence(F.lit(1).cast("long"), more)))
    _write(project(copies, DIVIDEND), path, "append", "date", ["ticker"])


def upsert_profiles(spark: SparkSession, profiles: DataFrame, path: str) -> None:
    """Replace the stored rows of the tickers that occur in ``profiles``, keep the others; no rows is a no-op."""
    rows = project(profiles, PROFILE)
    kept = scan_table(spark, path, PROFILE, missing="empty").join(rows.select("ticker"), "ticker", "left_anti")
    if not rows.isEmpty():
        _replace(spark, project(kept, PROFILE).unionByName(rows), path, None, [])


def upsert_silver(metrics: DataFrame, path: str) -> None:
    """Replace the dates that occur in ``metrics``, keep the others; no rows is a no-op."""
    _write(project(metrics, METRICS), path, "overwrite", "date", ["ticker"])


def merge_membership_changes(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Insert-only merge on (effective_date, action, ticker), partitioned by year."""
    _append_new(spark, project(incoming, CHANGES), path, CHANGES, CHANGE_KEY)


def overwrite_membership_daily(membership: DataFrame, path: str, whole_table: bool = True) -> None:
    """Replace the whole snapshot, or only the dates that occur in it; no rows is a no-op."""
    rows = project(membership, MEMBERSHIP)
    if whole_table:
        _replace(membership.sparkSession, rows, path, "date", ["ticker"])
    else:
        _write(rows, path, "overwrite", "date", ["ticker"])


def overwrite_spells(spells: DataFrame, path: str) -> None:
    """Replace the whole table of spells; no rows is a no-op."""
    _replace(spells.sparkSession, project(spells, SPELLS), path, None, ["ticker"])


def write_applied(changed: DataFrame, stored: DataFrame, path: str) -> None:
    """Put changed event days in the place of the stored ones, month by month; other months are left alone.

    ``changed`` must be stored elsewhere; a day without events stays as a mark that it was withdrawn.
    """
    months = changed.select("month").distinct()
    kept = stored.join(F.broadcast(months), "month", "left_semi").join(changed.select("ticker", "ex_date"), ["ticker", "ex_date"], "left_anti")
    _write(project(changed, APPLIED).unionByName(project(kept, APPLIED)), path, "overwrite", "month", ["ticker"])


def write_landed_prices(rows: DataFrame, path: str) -> None:
    """Put a batch's landed rows beside those of other batches; written again, a batch takes its own place."""
    _write(project(rows, LANDED_PRICE), path, "overwrite", ["month", "batch"], ["date", "ticker"])


def upsert_price_view(rows: DataFrame, path: str) -> None:
    """Replace the dates that occur in ``rows``, keep the others."""
    _write(project(rows, PRICE_VIEW), path, "overwrite", "date", ["ticker"])


def write_price_state(state: DataFrame, path: str) -> None:
    """Add the state as of a date, or replace it; no sort, as a state is read whole."""
    _write(project(state, PRICE_STATE), path, "overwrite", "date", [])


def append_marks(marks: DataFrame, path: str) -> None:
    """Add marks to the log of marks; the newest of a ticker counts, so adding them twice does no harm."""
    _write(project(marks, MARKS), path, "append", "date", ["ticker"])


def append_quarantine(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Add faulty rows that aren't there yet."""
    found = project(rows, QUARANTINE)
    stored = scan_table(spark, path, QUARANTINE, missing="empty")
    fresh = without_stored(found, stored, ["source", "day", "ticker", "reason", "record"])
    _write(fresh, path, "append", "source", ["ticker"])


def write_parquet_zstd(df: DataFrame, path: str, partition: str | None = None, sort: list[str] | None = None) -> None:
    """Plain ZSTD-5 Parquet, for other readers."""
    _write(df, path, "overwrite", partition, sort or [], replace="static")
