"""Codes 0, 1, ... of the sorted distinct values of a column, without all of them in one task or on the driver."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tradewind.operators.copies import COPIES
from tradewind.session import stored

PART_VALUES = 1_000_000  # distinct values that one task sorts
VALUES_TO_BROADCAST = 500_000  # of a dictionary
BYTES_TO_BROADCAST = 64 << 20
HOT_SHARE = 1000  # a value with more than this fraction of the rows is joined by broadcast: fewer than this many


def dictionary(df: DataFrame, column: str, part_values: int = PART_VALUES) -> DataFrame:
    """``value, code``: the dense rank, from 0, of each distinct non-NULL value of ``column``.

    The distinct values are dealt to value ranges, and each range is sorted and numbered by its own task. The
    sizes of the ranges, one row each, tell with which code each of them begins.
    """
    values = stored(df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct())
    parts = max(1, math.ceil(values.count() / part_values))
    # Numbers given by a task begin anew with each partition, in the low 33 bits.
    place = F.monotonically_increasing_id()
    ranged = values.repartitionByRange(parts, "value").sortWithinPartitions("value")
    numbered = stored(ranged.select("value", F.shiftrightunsigned(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return numbered.join(F.broadcast(starts), "part").select("value", (F.col("start") + F.col("place")).alias("code"))


def _size(values: DataFrame) -> tuple[int, int]:
    n, size = values.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("value").cast("string")) + 16), F.lit(0))).first()
    return n, size


def encode(df: DataFrame, column: str, codes: DataFrame, most_values: int = VALUES_TO_BROADCAST) -> DataFrame:
    """``df`` with each value of ``column`` replaced by its code; a value without one, and NULL, becomes NULL.

    A dictionary of a checked size is broadcast. A larger one is joined by shuffle; only values with more than
    a thousandth of the rows, of which there are fewer than a thousand, are broadcast then, so that no task gets
    all rows of a hot value.
    """
    n, size = _size(codes)
    coded = lambda rows, side: rows.join(side, rows[column].eqNullSafe(side["value"]), "left").select(
        *[F.col("code").alias(c) if c == column else rows[c] for c in df.columns]
    )
    if n <= most_values and size <= BYTES_TO_BROADCAST:
        return coded(df, F.broadcast(codes))
    counts = stored(df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias(COPIES)))
    rows = counts.agg(F.sum(COPIES)).first()[0] or 0
    frequent = counts.where(F.col(COPIES) * HOT_SHARE > rows).select("value")
    hot = stored(frequent.join(codes, frequent["value"].eqNullSafe(codes["value"]), "left").select(frequent["value"], "code", F.lit(True).alias("hot")))
    marked = df.join(F.broadcast(hot), df[column].eqNullSafe(hot["value"]), "left")
    near = marked.where("hot").select(*[F.col("code").alias(c) if c == column else df[c] for c in df.columns])
    far = marked.where("hot IS NULL").select(*[df[c] for c in df.columns])
    far = far.join(codes, far[column] == codes["value"], "left")
    return near.unionByName(far.select(*[F.col("code").alias(c) if c == column else F.col(c) for c in df.columns]))

