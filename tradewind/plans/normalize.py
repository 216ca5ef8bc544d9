"""Wide export → nine tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.timestamps import parse_named_timestamps
from tradewind.sources.schema import TABLES, TEXT_TIMESTAMP


def normalize_table(wide: DataFrame, columns: Iterable[str], fmt: str = TEXT_TIMESTAMP) -> DataFrame | None:
    """Distinct rows of the listed columns that exist, with the time columns parsed."""
    present = [c for c in columns if c in wide.columns]
    if not present:
        return None
    return parse_named_timestamps(wide.select(*present).distinct(), fmt)


def normalize_joined(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Iterable[str], fmt: str = TEXT_TIMESTAMP
) -> DataFrame | None:
    """``normalize_table`` of ``left`` left-joined with ``right``, whose columns have different names.

    Distinct rows of some columns follow from the distinct keys and columns of both sides, so these are reduced before
    the join: the joined rows, which grow with the product of the rows of a key, are not made.
    """
    wanted = list(columns)

    def reduced(df, key):
        return df.select(*dict.fromkeys([key, *(c for c in wanted if c in df.columns)])).distinct()

    return normalize_table(reduced(left, left_key).join(reduced(right, right_key), F.col(left_key) == F.col(right_key), "left"), wanted, fmt)


def normalize(wide: DataFrame, tables: Mapping[str, Iterable[str]] = TABLES) -> dict[str, DataFrame]:
    """All tables of which the export holds at least one column."""
    made = {name: normalize_table(wide, columns) for name, columns in tables.items()}
    return {name: df for name, df in made.items() if df is not None}
