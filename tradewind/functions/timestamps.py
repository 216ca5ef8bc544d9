"""Timestamp parsing by input type, and the two kinds of day difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.sources.schema import TEXT_TIMESTAMP

# A column holds times when its name contains one of these.
TIME_WORDS = ("timestamp", "date")

MICROS_PER_DAY = 86_400_000_000


def to_ts(df: DataFrame, name: str, fmt: str | None = TEXT_TIMESTAMP) -> Column:
    """Timestamp of column ``name``, chosen by its type.

    Whole numbers are epoch milliseconds (cut to seconds), text is parsed with ``fmt`` (``None``:
    Spark's own formats) and turns NULL when it does not fit, fractional numbers are epoch seconds.
    """
    kind, value = dict(df.dtypes)[name], F.col(name)
    if kind == "timestamp":
        return value
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return F.timestamp_seconds(F.expr(f"`{name}` div 1000"))
    if kind == "string":
        return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)
    if kind in ("timestamp_ntz", "date"):
        return value.cast("timestamp")
    return F.timestamp_seconds(value.try_cast("bigint"))


def with_timestamps(df: DataFrame, names, fmt: str | None = TEXT_TIMESTAMP) -> DataFrame:
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: to_ts(df, n, fmt) for n in present}) if present else df


def parse_named_timestamps(df: DataFrame, fmt: str = TEXT_TIMESTAMP) -> DataFrame:
    """Parse each text column whose name says it holds a time; typed columns stay."""
    kinds = dict(df.dtypes)
    return with_timestamps(
        df,
        [c for c in df.columns if any(w in c for w in TIME_WORDS) and kinds[c] in ("string", "timestamp_ntz")],
        fmt,
    )


def whole_days(start: Column, end: Column) -> Column:
    """Complete 24-hour units from ``start`` to ``end``; -36 hours is -1 (the reports)."""
    return F.timestamp_diff("DAY", start, end)


def floor_days(start: Column, end: Column) -> Column:
    """Days rounded down; -36 hours is -2 (the features)."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(MICROS_PER_DAY)).cast("bigint")


def late_flag(days: Column) -> Column:
    """1 from 24 hours after the estimate on, else 0; an unknown delay is not late."""
    return F.coalesce(days > 0, F.lit(False)).cast("int")
