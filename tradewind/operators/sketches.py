"""Approximate quantiles from mergeable sketches, one per group, that can be stored and merged later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SIZE = 500  # values that a sketch keeps on its lowest level


def rank_error(size: int = SIZE) -> float:
    """With a chance of 99 %, a quantile's rank is off by less than this share of the rows: 0.85 % for 500.

    The fitted error of KLL sketches (Karnin, Lang, Liberty 2016) as their public library states it.
    """
    return 2.296 / size**0.9021


def sketch_by(df: DataFrame, column: str, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """``keys, n, sketch``: a KLL sketch of the non-NULL values of a column for each group.

    Some kilobytes for a group of any size; tasks reduce their rows before the shuffle. Stored, a new month or file
    only adds its own sketch.
    """
    known = df.where(F.col(column).isNotNull())
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(column).cast("double"), size).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, shares: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, share, value, n``: quantiles of all rows behind the sketches of a group, without looking at a row again."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    quantile = lambda share: F.struct(
        F.lit(float(share)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))).alias("value")
    )
    points = merged.where(F.kll_sketch_get_n_double("sketch") > 0).select(
        *keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(F.array(*map(quantile, shares)))
    )
    return points.select(*keys, "share", "value", "n")


def sketched_medians(df: DataFrame, columns: Sequence[str], size: int = SIZE) -> dict[str, float | None]:
    """The approximate median of each column from one pass over the rows; None for a column without values."""
    cells = [F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(c) for c in columns]
    filled = lambda c: F.when(F.kll_sketch_get_n_double(c) > 0, F.col(c))  # noqa: E731 - an empty sketch has no median
    row = df.agg(*cells).select(*[F.kll_sketch_get_quantile_double(filled(c), F.lit(0.5)).alias(c) for c in columns])
    return row.first().asDict()


def rank_gaps(counts: DataFrame, column: str, points: Sequence[tuple[float, float]]) -> DataFrame:
    """``share, n, gap``: how far the share of each point (share, value) lies outside the exact ranks of its value, as a
    share of the ``n`` rows. ``counts`` has each value of ``column`` once, with its count ``n``; a value's ranks go from
    the rows below it to those up to it."""
    value, rows = F.col(column), F.col("n")
    sums = [
        F.sum(F.when(value < v, rows).otherwise(0)) if below else F.sum(F.when(value <= v, rows).otherwise(0))
        for _, v in points
        for below in (True, False)
    ]
    found = counts.agg(F.array(*sums).alias("r"), F.sum("n").alias("n"))
    cells = [
        F.struct(
            F.lit(float(share)).alias("share"),
            F.greatest(F.lit(0.0), F.col("r")[2 * k] / F.col("n") - share, share - F.col("r")[2 * k + 1] / F.col("n")).alias("gap"),
        )
        for k, (share, _) in enumerate(points)
    ]
    return found.select("n", F.inline(F.array(*cells))).select("share", "n", "gap")
