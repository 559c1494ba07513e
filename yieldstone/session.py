"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Ends the name of a table that is being replaced.
SET_ASIDE = "__set_aside"

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks that list a stored table at most.
LISTING_TASKS = 64


def build_session(app: str = "yieldstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE on and UTC time; ``master`` is left to spark-submit when None."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Thousands of dates are listed by a few tasks, not by one each.
        .config(LISTING, str(LISTING_TASKS))
        # Executors come and go on a large cluster: move blocks off a node before it leaves.
        .config("spark.decommission.enabled", "true")
        .config("spark.storage.decommission.enabled", "true")
        .config("spark.storage.decommission.shuffleBlocks.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables that are opened inside are listed by a few tasks, in a session that would start one for each of their dates."""
    given = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(given), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, given)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job wrote for itself, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def swap_path(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``: renames only, so the table is there whole before and after.

    If the driver is lost between the two renames, the old table lies under the name that ``settle_path`` looks for.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, old = hadoop.Path(path), hadoop.Path(f"{path}{SET_ASIDE}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.mkdirs(target.getParent())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"{path} can't be set aside")
    if not fs.rename(hadoop.Path(fresh), target):
        raise OSError(f"{fresh} can't be moved to {path}")
    fs.delete(old, True)


def settle_path(spark: SparkSession, path: str) -> None:
    """Bring back a table that a lost swap has set aside."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, old = hadoop.Path(path), hadoop.Path(f"{path}{SET_ASIDE}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target) and fs.exists(old):
        fs.rename(old, target)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the session itself is
    local, as in tests; on a cluster the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
