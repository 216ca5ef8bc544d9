"""Projection helpers that tolerate absent columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rename_or_add(df: DataFrame, mapping: dict[str, str], kind: str = "double") -> DataFrame:
    """Rename the columns that exist; where neither name exists, add the new one as typed NULL."""
    df = df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})
    missing = [new for new in mapping.values() if new not in df.columns]
    return df.withColumns({c: F.lit(None).cast(kind) for c in missing}) if missing else df


def keep_unless(df: DataFrame, rejected) -> DataFrame:
    """Rows for which ``rejected`` is not true: a NULL condition keeps the row."""
    return df.where(~F.coalesce(rejected, F.lit(False)))
