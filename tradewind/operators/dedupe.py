"""One row per key, chosen the same way every time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the smallest row of each key, by ``order`` and then by the other columns (NULL first).

    A plain minimum over a struct: each task reduces its rows before the shuffle, so a key with a
    third of all rows sends one row per task. A ranking window would sort that key in one task.
    """
    rest = list(order) + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def except_rows(df: DataFrame, rejected) -> DataFrame:
    """Distinct rows of ``df`` without those for which ``rejected`` is true (NULL keeps the row)."""
    return df.where(~F.coalesce(rejected, F.lit(False))).distinct()


def removed_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count before and after ``one_per_key``, and the difference."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
