"""Landing as a stream: files dropped in a folder reach bronze once each, in as many runs as it takes.

A run takes what has been dropped since the last one and ends (``availableNow``). Spark's checkpoint remembers the files
taken; a run that is lost goes on with the batch it was at, so that what a batch writes must bear being written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DIVIDEND, PRICE, project
from ..sources.lake import Lake
from ..sources.landing import collected_prices, dated_dividends, typed_prices
from ..sources.tables import append_dividends, write_landed_prices, write_price_overwrite


def _drain(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    checkpoint: str,
    store: Callable[[DataFrame, int], None],
    kind: str,
    files_per_batch: int | None,
) -> None:
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = reader.load(folder).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_prices(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    lake: Lake,
    stream: str = "prices",
    kind: str = "parquet",
    files_per_batch: int | None = None,
) -> list[date]:
    """Take the newly dropped price files; returns the dates they touched, in order.

    A batch's rows are kept as landed under the batch's own name, where a repetition replaces them. Then each date it
    touched is written anew from all that has landed for it, so a date whose rows come in several drops ends as if they had
    come at once, and a close that comes later still collects the rows without one. Only the touched dates are
    replaced. Rows without a date stay landed. A date belongs to streams or to jobs: one that a stream touches holds what
    streams have landed. A stream that begins anew, with its checkpoint gone, needs a new name.
    """
    touched: set[date] = set()

    def store(batch: DataFrame, number: int) -> None:
        own, name = batch.sparkSession, f"{stream}-{number}"
        typed = typed_prices(batch).withColumns({"month": F.trunc("date", "month"), "batch": F.lit(name)})
        write_landed_prices(typed, lake.landed_price)
        landed = lake.read_landed_price(own)
        days = landed.where((F.col("batch") == name) & F.col("date").isNotNull()).select("date").distinct()
        found = [row["date"] for row in days.collect()]  # the calendar bounds them
        if found:
            # months prune folders, days row groups, as files are sorted by day
            months = sorted({d.replace(day=1) for d in found})
            rows = landed.where(F.col("month").isin(months) & F.col("date").isin(found)).select(*PRICE.names)
            write_price_overwrite(collected_prices(rows), lake.price)
        touched.update(found)

    _drain(spark, folder, schema, lake.stream_checkpoint(stream), store, kind, files_per_batch)
    return sorted(touched)


def stream_dividends(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    lake: Lake,
    collected: date,
    stream: str = "dividends",
    zone: str | None = "America/New_York",
    kind: str = "parquet",
    files_per_batch: int | None = None,
) -> None:
    """Take the newly dropped events, however late, with ``collected`` as their collection date.

    An event that is stored already isn't stored again, which makes a repeated batch harmless (see ``append_dividends``);
    of one that a batch brings several times as many copies are kept. ``silver_backfill`` then finds the dates they change.
    """

    def store(batch: DataFrame, number: int) -> None:
        events = dated_dividends(batch, zone).withColumn("date", F.lit(collected))
        append_dividends(batch.sparkSession, project(events, DIVIDEND), lake.dividends)

    _drain(spark, folder, schema, lake.stream_checkpoint(stream), store, kind, files_per_batch)
