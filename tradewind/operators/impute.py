"""Median imputation, one column after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewind.operators.running import ONE_TASK_ROWS, exact_medians


def median_impute(df: DataFrame, columns: Sequence[str], one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Fill NULL with the median, then keep positive values only, column by column.

    Each median is taken over the rows that the columns before it have kept. A column without any
    value is not filled, so the filter then removes every row.

    All medians come from one pass, on the expectation that a filled value is positive and so keeps
    its row. Should a median not be positive, the columns after it are done again on what is left.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    df = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    kept, seen = F.lit(True), {}
    for name in columns:
        seen[name] = F.when(kept, F.col(name)).alias(name)
        kept = kept & (F.col(name).isNull() | (F.col(name) > 0))
    medians = exact_medians(df.select(*seen.values()), columns, one_task_rows)

    for i, name in enumerate(columns):
        median = medians[name]
        if median is not None:
            df = df.fillna({name: float(median)})
        df = df.where(F.col(name) > 0)
        if median is not None and median <= 0:
            return median_impute(df, columns[i + 1 :], one_task_rows)
    return df
