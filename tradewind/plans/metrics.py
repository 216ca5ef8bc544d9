"""Classification metrics as DataFrame aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.operators.running import ONE_TASK_ROWS, running_totals
from tradewind.session import stored


def _ratio(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(acc, precision, recall, f1) in one pass; 0 where a ratio is undefined."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    cells = df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("acc"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, n): all four cells, also the empty ones."""
    cell = lambda a, p: F.struct(
        F.lit(a).alias("actual"),
        F.lit(p).alias("predicted"),
        F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias("n"),
    )
    cells = df.agg(F.array(*[cell(a, p) for a in (0, 1) for p in (0, 1)]).alias("cells"))
    return cells.select(F.explode("cells").alias("c")).select("c.*")


def _score_counts(df: DataFrame, label: str, score: str, copies: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score; a row counts as often as ``copies`` says."""
    positive = F.col(label).cast("double") == 1.0
    rows = F.col(copies) if copies else F.lit(1).cast("bigint")
    found = lambda condition: F.sum(F.when(condition, rows).otherwise(0))
    return stored(
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(found(positive).alias("pos"), found(~positive).alias("neg"))
    )


def roc_auc(
    df: DataFrame, label: str, score: str, one_task_rows: int = ONE_TASK_ROWS, copies: str | None = None
) -> DataFrame:
    """(auc): the chance that a positive scores above a negative, a tie counting half."""
    counts = running_totals(_score_counts(df, label, score, copies), "score", ["neg"], one_task_rows=one_task_rows)
    # Decimal sums: exact, and wide enough for products of row counts.
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    twice_won = F.sum(wide("pos") * (wide("neg_upto") * 2 - wide("neg")))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return counts.agg((twice_won.cast("double") / 2 / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, plus the start at threshold infinity."""
    counts = _score_counts(df, label, score)
    totals = counts.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    points = running_totals(counts, "score", ["pos", "neg"], descending=True, one_task_rows=one_task_rows)
    rate = lambda c, total: (F.col(c) / F.lit(float(total)) if total else F.lit(None).cast("double"))
    curve = points.select(
        F.col("score").alias("threshold"),
        rate("neg_upto", totals[1]).alias("fpr"),
        rate("pos_upto", totals[0]).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return curve.unionByName(start)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(class, label, n) for both classes, also when one has no rows. The labels are fixed values."""
    cell = lambda value, name: F.struct(
        F.lit(value).alias("class"), F.lit(name).alias("label"), F.count_if(F.col(label) == value).alias("n")
    )
    both = df.agg(F.array(cell(0, "On Time (0)"), cell(1, "Late (1)")).alias("cells"))
    return both.select(F.explode("cells").alias("c")).select("c.*")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, correlation): Pearson, each unordered pair once, from one matrix of products.

    Tasks add up the products of their rows as vectors; one matrix of columns × columns comes back, whatever
    the number of rows, and the plan does not grow with the number of pairs. Rows with a NULL in any of the
    columns are left out. NULL for a constant column, and for all if fewer than two rows are left.
    """
    rows = VectorAssembler(inputCols=list(columns), outputCol="__v", handleInvalid="skip").transform(df).select("__v")
    found, spread = None, None
    if rows.limit(2).count() == 2:
        found = Correlation.corr(rows, "__v").first()[0].toArray()
        spread = rows.select(Summarizer.std(F.col("__v"))).first()[0]
    # The matrix has 1 on its diagonal for a constant column too.
    known = lambda i, j: found is not None and spread[i] > 0 and spread[j] > 0 and not math.isnan(found[i, j])
    value = lambda i, j: float(found[i, j]) if known(i, j) else None
    pairs = [(a, columns[j], value(i, j)) for i, a in enumerate(columns) for j in range(i, len(columns))]
    return df.sparkSession.createDataFrame(pairs, "feature_a string, feature_b string, correlation double")


def data_kpis(features: DataFrame, label: str = "is_late") -> DataFrame:
    """(samples, late_pct, avg_delay_days) of an enhanced feature table that kept ``delay_days``."""
    return features.agg(
        F.count(F.lit(1)).alias("samples"),
        F.coalesce(F.avg(label) * 100, F.lit(0.0)).alias("late_pct"),
        F.coalesce(F.avg("delay_days"), F.lit(0.0)).alias("avg_delay_days"),
    )


def best_model(comparison: DataFrame) -> DataFrame:
    """The row with the highest AUC; the earlier position wins a tie."""
    return comparison.orderBy(F.desc("auc"), "position").limit(1)


def ml_kpi_row(features: DataFrame, comparison: DataFrame) -> DataFrame:
    """(samples, late_pct, avg_delay_days, best_model, best_auc, best_accuracy) in one row."""
    best = best_model(comparison).first()
    name, auc, accuracy = (best["model"], best["auc"], best["acc"]) if best else (None, None, None)
    return data_kpis(features).select(
        "*",
        F.lit(name).cast("string").alias("best_model"),
        F.lit(auc).cast("double").alias("best_auc"),
        F.lit(accuracy).cast("double").alias("best_accuracy"),
    )


def feature_importance(spark: SparkSession, model_name: str, importances, names: Sequence[str]) -> DataFrame:
    """(model, feature, importance), most important first."""
    rows = [(model_name, n, float(v)) for n, v in zip(names, importances.toArray())]
    return spark.createDataFrame(rows, "model string, feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
