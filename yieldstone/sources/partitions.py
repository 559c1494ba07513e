"""Dates of a stored table from the names of its partitions: a listing of folders, no file of data is opened."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import few_listing_tasks

#: What a partition of null is named by.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """Values of the partition column whose folder holds a file, null as None; none if the path is absent."""
    try:
        with few_listing_tasks(spark):
            rows = spark.read.schema("_none int").parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return values_of(rows, column)


def values_of(rows: DataFrame, column: str) -> list[str | None]:
    """The same of a table as it is read, without listing it again.

    Spark lists the folders, many at a time where they are many; names that begin with a dot or an underscore belong to a
    write under way and don't count. The names come back as one text, as a call for each would take longer than the listing.
    """
    files = rows._jdf.inputFiles()
    listed = rows.sparkSession._jvm.org.apache.hadoop.util.StringUtils.arrayToString(files)
    values = set(re.findall(rf"/{re.escape(column)}=([^/]+)/[^/,]+", listed))
    return sorted((None if v == NULL_PARTITION else v for v in values), key=str)


def dates_of(rows: DataFrame, column: str = "date") -> list[date]:
    """Dates that a table as it is read has files of, in order."""
    return sorted(date.fromisoformat(v) for v in values_of(rows, column) if v is not None)


def stored_dates(spark: SparkSession, path: str, column: str = "date") -> list[date]:
    """Dates that the table at ``path`` has rows of, in order; the calendar bounds them. A null date isn't listed."""
    return sorted(date.fromisoformat(v) for v in partition_values(spark, path, column) if v is not None)


def dates_frame(spark: SparkSession, dates: list[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "date date")


def listed_dates(spark: SparkSession, path: str) -> DataFrame:
    """``stored_dates`` as rows."""
    return dates_frame(spark, stored_dates(spark, path))


def pending_listed(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Dates that the table at ``source`` has and the one at ``target`` has not."""
    done = set(stored_dates(spark, target))
    return dates_frame(spark, [d for d in stored_dates(spark, source) if d not in done])
