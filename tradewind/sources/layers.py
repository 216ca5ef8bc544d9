"""Layer folders of Parquet tables, and their registration in the catalog."""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.sources import files

VERSION = re.compile(r"\d{20}-[0-9a-f]{8}")


@dataclass(frozen=True)
class LayerPaths:
    """Where each stage reads and writes. ``database`` is optional: without it, temp views are used."""

    raw_csv: str
    staged: str
    normalized: str
    cleaned: str
    wrangled: str
    reports: str
    models: str
    database: str | None = None
    scratch: str | None = None  # for intermediate tables of a run; by default the session's shared folder

    @classmethod
    def under(cls, base: str, raw_csv: str, database: str | None = None) -> "LayerPaths":
        base = base.rstrip("/")
        names = ("staged", "normalized", "cleaned", "wrangled", "reports", "models", "scratch")
        return cls(raw_csv=raw_csv, database=database, **{n: f"{base}/{n}" for n in names})

    @classmethod
    def from_json(cls, text: str) -> "LayerPaths":
        values = json.loads(text)
        return cls(**{f.name: values[f.name] for f in fields(cls) if f.name in values})


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _versions(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/_published/{name}"


@dataclass(frozen=True)
class Published:
    """A finished version of a table: its folder, and a note of what it was made from."""

    version: str
    path: str
    note: str | None


def published(spark: SparkSession, base: str, name: str) -> Published | None:
    """The newest finished version of a table, or None if none was published."""
    found = [v for v in files.names(spark, _versions(base, name)) if not v.endswith(".part")]
    if not found:
        return None
    entry = json.loads(files.read_text(spark, f"{_versions(base, name)}/{found[-1]}"))
    return Published(found[-1], f"{table_path(base, name)}/{found[-1]}", entry["note"])


def location(spark: SparkSession, base: str, name: str) -> str:
    """The folder with the files of a table: its newest version, or its own folder if it was never published."""
    found = published(spark, base, name)
    return found.path if found else table_path(base, name)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The table ``name`` of a layer, or None when its folder is not there. Other errors surface."""
    try:
        return spark.read.parquet(location(spark, base, name))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_layer(spark: SparkSession, base: str, names) -> dict[str, DataFrame]:
    found = {name: read_table(spark, base, name) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def publish(df: DataFrame, base: str, name: str, note: str | None = None) -> str:
    """Write a new version of a table and make it the current one; returns its folder.

    The files go to a folder of their own: snappy Parquet, microsecond timestamps (see ``session.prepare``).
    Only when all are there, a small entry names the version, in one step. A job that fails or is
    killed before that leaves the old version as it was, for readers and for the catalog. Readers of
    the version before can go on; older ones and what failed writers left are removed. One writer a table at a time.
    """
    spark, before = df.sparkSession, published(df.sparkSession, base, name)
    at = max(time.time_ns(), int(before.version.split("-")[0]) + 1 if before else 0)
    version = f"{at:020d}-{uuid.uuid4().hex[:8]}"
    path = f"{table_path(base, name)}/{version}"
    df.write.option("compression", "snappy").parquet(path)
    files.write_text(spark, f"{_versions(base, name)}/{version}", json.dumps({"note": note}))
    kept = {version, before.version if before else None}
    for entry in files.names(spark, _versions(base, name)):
        if entry not in kept:
            files.remove(spark, f"{_versions(base, name)}/{entry}")
    for folder in files.names(spark, table_path(base, name)):
        if VERSION.fullmatch(folder) and folder not in kept:
            files.remove(spark, f"{table_path(base, name)}/{folder}")
    return path


def fingerprint(spark: SparkSession, base: str, name: str) -> str | None:
    """A digest of a table's files by name, size and time, added up in Spark; None if there is no such table."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(location(spark, base, name))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    one = F.xxhash64("path", "length", "modificationTime")
    count, size, mixed = found.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.bit_xor(one)).first()
    return f"{count}-{size}-{(mixed or 0) & 0xFFFFFFFFFFFFFFFF:016x}"


def register_layer(spark: SparkSession, base: str, names, database: str | None = None) -> list[str]:
    """Make the tables of a layer queryable by name; returns the names to use in SQL.

    A table that a database already has with the same columns is switched to the newest version by its
    location, in one step of the catalog: there is no moment without the table. Only when its columns
    have changed is it dropped and created anew. Without a database, temporary views are used.
    """
    registered = []
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        df = read_table(spark, base, name)
        if df is None:
            continue
        if not database:
            df.createOrReplaceTempView(name)
            registered.append(name)
            continue
        full = f"`{database}`.`{name}`"
        where = location(spark, base, name).replace("'", "\\'")
        if spark.catalog.tableExists(full) and spark.table(full).dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{where}'")
            spark.sql(f"REFRESH TABLE {full}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{where}'")
        registered.append(full)
    return registered
