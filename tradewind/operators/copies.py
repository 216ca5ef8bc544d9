"""Equal rows as one row and a count, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPIES = "__copies"
PER_CHUNK = 10_000


def pack_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row, with its number of copies (counted before the shuffle too)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def unpack_copies(df: DataFrame, per_chunk: int = PER_CHUNK, most: int | None = None) -> DataFrame:
    """Repeat each row by its count; a large count is first split, then spread over tasks.

    ``most`` is an upper bound of the counts, for rows too many to shuffle, such as those of a join: rows with up to
    ``per_chunk`` copies are then repeated where they lie, and ``df`` is read once more for the others, if there can be any.
    """
    rows = [c for c in df.columns if c != COPIES]
    if most is not None:
        small = df if most <= per_chunk else df.where(F.col(COPIES) <= per_chunk)
        again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES)))
        here = small.where(F.col(COPIES) > 0)
        here = here.select(*rows) if most <= 1 else here.withColumn("__again", again).select(*rows)
        if most <= per_chunk:
            return here
        return here.unionByName(unpack_copies(df.where(F.col(COPIES) > per_chunk), per_chunk))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({COPIES} - 1) div {per_chunk}")))
    here = F.least(F.lit(per_chunk).cast("bigint"), F.col(COPIES) - F.col("__chunk") * per_chunk)
    return (
        df.where(F.col(COPIES) > 0)
        .withColumn("__chunk", chunk)
        .withColumn("__here", here)
        .repartition(*rows, "__chunk")
        .withColumn("__again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__here"))))
        .select(*rows)
    )
