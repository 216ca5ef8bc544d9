"""Session settings the results depend on, and stored intermediate tables."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.sources import files


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the results depend on. Memory and parallelism stay with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


PART_BYTES, LARGE_BYTES, MOST_PART_BYTES = 64 << 20, 64 << 30, 1 << 30


def shuffle_parts(stored_bytes: int) -> int:
    """Shuffle partitions for so many bytes of Parquet (some four times that as shuffled rows).

    64 MB each up to 64 GB; beyond it parts and their number both grow with the square root, for every part
    costs each map task a block, up to 1 GB each.
    """
    size = min(MOST_PART_BYTES, PART_BYTES * max(1.0, stored_bytes / LARGE_BYTES) ** 0.5)
    return max(1, math.ceil(stored_bytes / size))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]):
    """Inside, the session has these settings; then it has what it had before."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=8)
def observing_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with its settings, for jobs whose rows are counted by an ``Observation``.

    A session that has made one observation cannot be shipped with a task any more, which Spark ML does with
    the session that fits and scores models. Files are all that both sessions share.
    """
    return spark.newSession()


def with_settings_of(spark: SparkSession, other: SparkSession) -> SparkSession:
    """``other`` with the settings that ``spark`` has now."""
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def bytes_under(spark: SparkSession, folder: str) -> int:
    """Bytes of all files under ``folder``: sizes only, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


@contextmanager
def sized_shuffles(spark: SparkSession, folder: str):
    """Inside, ``spark.sql.shuffle.partitions`` fits the Parquet files under ``folder``; then it is as before.

    The setting is never lowered: adaptive execution merges partitions that turn out small, but
    cannot split too few of them.
    """
    stored_bytes = bytes_under(spark, folder)
    key = "spark.sql.shuffle.partitions"
    with settings(spark, {key: max(int(spark.conf.get(key)), shuffle_parts(stored_bytes))}):
        yield


SCRATCH = "tradewind.scratch"


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder of the ``scratch`` block around the call, else the one that the
    cluster names in ``spark.checkpoint.dir``, else one beside the session's tables in its warehouse."""
    folder = spark.conf.get(SCRATCH, None) or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tradewind"
    return re.sub("^file:/(?!/)", "file:///", folder).rstrip("/")


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None):
    """Inside, ``stored`` writes to a new folder under ``folder`` (or the shared one), which is removed at the end.

    No DataFrame that was stored inside can be read after it. A block may lie within another, but only one
    thread of a session may have blocks.
    """
    own = f"{(folder or shared_folder(spark)).rstrip('/')}/run-{uuid.uuid4()}"
    try:
        with settings(spark, {SCRATCH: own}):
            yield own
    finally:
        files.remove(spark, own)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (or ``folder``) as Parquet and go on from there.

    Cuts the lineage in a way that survives lost executors, and later readers scan only the columns
    they need. A ``scratch`` block removes what is stored inside it, but for what goes to a ``folder`` outside.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/tradewind-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], object]], at_once: int = 4) -> list:
    """Submit independent jobs side by side, so that one job's last tasks do not leave the cluster idle.

    Results come in the order of ``jobs``; the first failure is raised once the others have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
