"""Report results as CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.sources.layers import table_path


def write_report(df: DataFrame, base: str, name: str) -> str:
    path = table_path(base, name)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Header and rows of a stored report; every value is text."""
    return spark.read.option("header", True).csv(table_path(base, name))
