"""Held-out folds by checksum of the id, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the row is held out. A row without an id is: nothing can be learned from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows_per_class: int, files: int = 8
) -> DataFrame:
    """``doc_id, text, label, copies, weight`` of at most ``rows_per_class`` learnable documents of either class.

    The rows with the smallest hashes of their ids are taken, so the sample does not depend on the
    partitioning. ``weight`` is how many learnable rows of its class each sampled row stands for. The
    ids are broadcast: ``2 * rows_per_class`` of them at most. The texts go to a few partitions,
    whatever the size of ``docs``. An id with two different labels is left out. Rows with the same id and text are
    one row, however many they are, with their number as ``copies``; ``weight`` counts them all.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~in_fold("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        usable.where(F.col("label") == c)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows_per_class)
        .withColumn("weight", F.lit(max(1.0, sizes.get(c, 0) / rows_per_class)))
        for c in (0, 1)
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    once = found.groupBy("doc_id", "text", "label", "weight").agg(F.count("*").alias("copies"))
    rows = once.select("doc_id", "text", "label", "copies", (F.col("weight") * F.col("copies")).alias("weight"))
    return rows.repartition(files, "doc_id")
