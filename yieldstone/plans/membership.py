"""Membership setup: change log to daily snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.changes import seed_membership_changes
from ..operators.membership import membership_daily, membership_in_range
from ..sources.lake import Lake
from ..sources.tables import merge_membership_changes, overwrite_membership_daily


def membership_setup(
    spark: SparkSession,
    lake: Lake,
    base: DataFrame,
    start: date | str,
    end: date | str,
    changes: DataFrame | None = None,
    whole_table: bool = True,
) -> DataFrame:
    """Merge the change log (by default the seed rows) and store the daily snapshot of the range.

    The snapshot is made from everything in the stored log. ``whole_table=False`` leaves the stored
    days outside the range alone. Returns the stored rows of the range.
    """
    merge_membership_changes(spark, seed_membership_changes(spark) if changes is None else changes, lake.changes)
    daily = membership_daily(lake.read_changes(spark), base, start, end)
    overwrite_membership_daily(daily, lake.membership, whole_table)
    return membership_in_range(lake.read_membership(spark), start, end)
