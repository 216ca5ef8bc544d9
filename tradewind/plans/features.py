"""Model input: extract, feature tables, encoding, scaling, and the stratified split."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewind.functions.numbers import as_double
from tradewind.functions.timestamps import floor_days, late_flag
from tradewind.operators.copies import COPIES, unpack_copies
from tradewind.operators.dictionary import VALUES_TO_BROADCAST, dictionary, encode
from tradewind.operators.running import ONE_TASK_ROWS
from tradewind.session import run_together, stored
from tradewind.sources.layers import fingerprint, publish, published, read_table

# The columns the models see.
NUMBERS = ("price", "freight_value", "product_weight_g")
CATEGORIES = ("customer_state", "seller_state", "product_category_name_english")
TIMES = ("order_delivered_customer_date", "order_estimated_delivery_date")
LABEL = "is_late"


def ml_extract(commerce: DataFrame) -> DataFrame:
    """The eight model columns of the delivered rows."""
    delivered = commerce.where(F.col(TIMES[0]).isNotNull())
    return delivered.select("customer_state", "seller_state", *NUMBERS, CATEGORIES[2], *TIMES)


def stored_extract(spark: SparkSession, base: str, wrangled: str, table: str = "commerce", name: str = "ml_extract") -> DataFrame:
    """The extract stored under ``base`` if it was made from the files that the commerce table has now.

    With the stored extract lies a digest of the files it was made from. If they have changed, or nothing is
    stored, it is built and published anew. Where the commerce table is gone, the stored extract still serves.
    """
    now, found = fingerprint(spark, wrangled, table), published(spark, base, name)
    if now is None and found is None:
        raise ValueError(f"no stored extract under {base}, and no table {table} under {wrangled} to build it from")
    if now is not None and (found is None or found.note != now):
        publish(ml_extract(read_table(spark, wrangled, table)), base, name, note=now)
    return read_table(spark, base, name)


def _features(extract: DataFrame, delay, keep_delay: bool) -> DataFrame:
    columns = [*NUMBERS, *CATEGORIES, LABEL] + (["delay_days"] if keep_delay else [])
    return (
        extract.withColumn("delay_days", delay)
        .withColumn(LABEL, late_flag(F.col("delay_days")))
        .withColumns({c: as_double(c) for c in NUMBERS})
        .select(*columns)
        .na.drop("any")
    )


def features_base(extract: DataFrame) -> DataFrame:
    """Three numbers, three categories and the label; rows with any NULL are left out."""
    return _features(extract, floor_days(F.col(TIMES[1]), F.col(TIMES[0])), keep_delay=False)


def features_enhanced(extract: DataFrame, leak: bool = False) -> DataFrame:
    """The same with an unknown delay counted as 0. ``leak=True`` keeps ``delay_days`` as a feature.

    The label is computed from ``delay_days``, so a model that sees it learns nothing else.
    """
    days = F.coalesce(floor_days(F.col(TIMES[1]), F.col(TIMES[0])), F.lit(0).cast("bigint"))
    return _features(extract, days, keep_delay=leak)


def feature_names(df: DataFrame, label: str = LABEL) -> list[str]:
    return [c for c in df.columns if c != label]


def label_indexer(columns: Sequence[str] = CATEGORIES) -> StringIndexer:
    """Codes 0, 1, … in the sort order of the values."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_code" for c in columns], stringOrderType="alphabetAsc"
    )


def label_encode(df: DataFrame, columns: Sequence[str] = CATEGORIES, most_values: int = VALUES_TO_BROADCAST) -> DataFrame:
    """Replace each category by its code: 0, 1, ... in the sort order of the values, NULL for NULL.

    The dictionaries are made and joined in Spark, whatever number of values they hold.
    """
    made = run_together(df.sparkSession, [partial(dictionary, df, column) for column in columns])
    for column, codes in zip(columns, made):
        df = encode(df, column, codes, most_values).withColumn(column, F.col(column).cast("int"))
    return df


def preparation(df: DataFrame, label: str = LABEL) -> Pipeline:
    """Encode, assemble and standardize; fitted on all rows, as one savable pipeline.

    Spark scales by the sample deviation; the factor turns that into the population deviation.
    """
    rows = df.count()
    names = feature_names(df, label)
    coded = [f"{c}_code" if c in CATEGORIES else c for c in names]
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    return Pipeline(
        stages=[
            label_indexer([c for c in names if c in CATEGORIES]),
            VectorAssembler(inputCols=coded, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="sample_scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                scalingVec=Vectors.dense([factor] * len(names)), inputCol="sample_scaled", outputCol="features"
            ),
        ]
    )


def standardize(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Each feature as its distance from the mean, in population standard deviations."""
    names = feature_names(df, label)
    scaled = preparation(df, label).fit(df).transform(df).withColumn("__v", vector_to_array("features"))
    return scaled.select(*[F.col("__v")[i].alias(c) for i, c in enumerate(names)], label)


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    train_share: float = 0.8,
    seed: int = 42,
    buckets: int = 65_536,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add ``split`` ('train' or 'test'): per class exactly round(share × rows) train rows.

    Rows are ordered by a hash of their values, cut into hash buckets. The bucket counts (classes ×
    ``buckets`` rows at most) tell which buckets are all train or all test; only the bucket of each
    class that holds the cut is looked at further. Its equal rows are interchangeable and go on as one row with
    a count. While it has more than ``one_task_rows`` of these, it is hashed anew and counted again, as in a
    radix sort; then it is ranked in one task. The same data gives the same split, whatever its order or partitioning.
    Rows that come with a count of their copies keep one, of the copies in that part.
    """
    counted, columns = COPIES in df.columns, [c for c in df.columns if c != COPIES]
    rows = df if counted else df.withColumn(COPIES, F.lit(1).cast("bigint"))
    kept = [*columns, "split", COPIES] if counted else [*columns, "split"]
    spread = (lambda parts: parts.where(F.col(COPIES) > 0)) if counted else unpack_copies
    all_of_class = F.sum("__n").over(Window.partitionBy(label))
    target = lambda sizes: sizes.withColumn("__left", F.round(all_of_class * F.lit(train_share)).cast("bigint"))
    decided, cut = _past_buckets(rows, target, label, columns, seed, buckets)
    # Uncut rows are not shuffled; those of a cut bucket are few, or many times the same.
    out = [decided.select(*kept)]
    packed = cut.groupBy(*columns, "__left").agg(F.sum(COPIES).alias(COPIES))
    packed, turn = stored(packed), 0
    while True:
        largest = packed.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= one_task_rows:
            break
        turn += 1
        quotas = packed.select(F.col(label).alias("__of"), "__left").distinct()  # one row per class
        target = lambda sizes: sizes.join(F.broadcast(quotas), sizes[label].eqNullSafe(quotas["__of"]))  # noqa: B023, E731
        decided, cut = _past_buckets(packed.drop("__left"), target, label, columns, seed + turn, max(2, buckets))
        out.append(spread(decided.select(*columns, "split", COPIES)))
        packed = stored(cut.select(*columns, "__left", COPIES))

    hashed = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
    ranked = Window.partitionBy(label).orderBy(hashed, *columns).rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("__left") - F.coalesce(F.sum(COPIES).over(ranked), F.lit(0))
    shares = packed.withColumn("__to_train", F.greatest(F.lit(0), F.least(F.col(COPIES), room))).withColumn(
        "__part",
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("split"), F.col("__to_train").alias("copies")),
                F.struct(F.lit("test").alias("split"), (F.col(COPIES) - F.col("__to_train")).alias("copies")),
            )
        ),
    )
    out.append(spread(shares.select(*columns, "__part.split", F.col("__part.copies").alias(COPIES))))
    return reduce(DataFrame.unionByName, out)


def _past_buckets(
    rows: DataFrame, target: Callable[[DataFrame], DataFrame], label: str, columns: Sequence[str], seed: int, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with a count of copies) of the buckets that are all train or all test, with ``split``; and those of
    the bucket of each class that the cut is in, with ``__left``, how many of them are still to be train.

    ``target`` adds to the sizes of the buckets how many rows of the class are to be train, as ``__left``.
    """
    hashed = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
    rows = rows.withColumn("__bucket", F.pmod(hashed, F.lit(buckets)).cast("int"))
    sizes = target(rows.groupBy(label, "__bucket").agg(F.sum(COPIES).alias("__n")))
    earlier = Window.partitionBy(label).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("__left") - F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    quota = sizes.select(
        F.col(label).alias("__label"), F.col("__bucket").alias("__cut"), "__n", F.greatest(F.lit(0), F.least(F.col("__n"), room)).alias("__left")
    )
    # Classes × buckets rows at most, each a few numbers. NULL is a class too.
    same = rows[label].eqNullSafe(quota["__label"]) & (rows["__bucket"] == quota["__cut"])
    tagged = rows.join(F.broadcast(quota), same).drop("__label", "__cut", "__bucket")
    uncut = (F.col("__left") == 0) | (F.col("__left") == F.col("__n"))
    split = F.when(F.col("__left") == 0, F.lit("test")).otherwise(F.lit("train"))
    return tagged.where(uncut).withColumn("split", split).drop("__n", "__left"), tagged.where(~uncut).drop("__n")
