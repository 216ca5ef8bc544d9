"""Running totals and exact quantiles without sorting a table in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from tradewind.session import stored

ONE_TASK_ROWS = 1_000_000  # up to this many distinct values, one sorted task is enough
MAX_BUCKETS = 10_000


def running_totals(
    df: DataFrame,
    by: str,
    sums: Sequence[str],
    descending: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add ``<name>_upto`` for each of ``sums``: its total over all rows up to this value of ``by``.

    ``by`` is numeric and holds each value once, without NULL. The number of rows is checked first,
    unless the caller knows it (``rows``).
    A larger input is cut into value ranges at approximate quantiles; each range is summed by its
    own task and starts from the totals of the ranges before it (at most 10,000 rows of totals).
    """
    if rows is None:
        rows = df.count()
    order = F.col(by).desc() if descending else F.col(by).asc()
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if rows <= one_task_rows:
        return df.withColumns({f"{s}_upto": F.sum(s).over(upto) for s in sums})

    n = min(MAX_BUCKETS, math.ceil(rows / one_task_rows) + 1)
    steps = [F.lit(i / n) for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(F.col(by).cast("double"), F.array(*steps), 10 * n)).first()[0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    ranged = Bucketizer(splits=splits, inputCol="__value", outputCol="__range").transform(
        df.withColumn("__value", F.col(by).cast("double"))
    )
    totals = ranged.groupBy("__range").agg(*[F.sum(s).alias(f"__{s}") for s in sums])
    range_order = F.col("__range").desc() if descending else F.col("__range").asc()
    before = Window.orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__range", *[F.coalesce(F.sum(f"__{s}").over(before), F.lit(0)).alias(f"__{s}") for s in sums])
    inside = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(F.broadcast(starts), "__range")  # one row per range
        .withColumns({f"{s}_upto": F.col(f"__{s}") + F.sum(s).over(inside) for s in sums})
        .drop("__range", "__value", *[f"__{s}" for s in sums])
    )


def value_counts_upto(df: DataFrame, column: str, one_task_rows: int = ONE_TASK_ROWS) -> tuple[DataFrame, int]:
    """Each distinct non-NULL value with its count ``n`` and running count ``n_upto``; and the total.

    The counts are stored: ``df`` is scanned once, whatever is made of them."""
    counts = stored(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    size = counts.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    return running_totals(counts, column, ["n"], one_task_rows=one_task_rows, rows=size.rows), size.total


def quantile_of(column: str, share: float, total: int):
    """Aggregate over ``value_counts_upto``: smallest value with at least ``share`` of the rows at or below."""
    rank = max(1, math.ceil(share * total))
    return F.min(F.when(F.col("n_upto") >= rank, F.col(column)))


def exact_medians(
    df: DataFrame, columns: Sequence[str], one_task_rows: int = ONE_TASK_ROWS
) -> dict[str, float | None]:
    """Lower median of the non-NULL values of each column, None where there are none.

    The distinct values of all columns are counted together, and small columns ranked together.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = stored(
        df.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = {
        r.name: r
        for r in counts.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total")).collect()
    }
    medians: dict[str, float | None] = dict.fromkeys(columns)

    small = [name for name, size in sizes.items() if size.rows <= one_task_rows]
    if small:
        rank = F.coalesce(*[F.when(F.col("name") == c, F.lit(math.ceil(0.5 * sizes[c].total))) for c in small])
        upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.where(F.col("name").isin(small)).withColumn("n_upto", F.sum("n").over(upto))
        found = ranked.where(F.col("n_upto") >= rank).groupBy("name").agg(F.min("value").alias("value"))
        medians.update({r.name: r.value for r in found.collect()})

    for name in set(sizes) - set(small):
        own = counts.where(F.col("name") == name).drop("name")
        ranked = running_totals(own, "value", ["n"], one_task_rows=one_task_rows, rows=sizes[name].rows)
        medians[name] = ranked.agg(quantile_of("value", 0.5, sizes[name].total)).first()[0]
    return medians
