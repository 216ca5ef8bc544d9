"""Row counts, schemas and samples of a set of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tradewind.sources.layers import read_table


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), counted in one job."""
    return _stack(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    )


def schema_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, column_type, row_count), one row per column."""
    frames = []
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("column_type"),
                )
                for i, (c, t) in enumerate(df.dtypes)
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(
            counted.select(F.lit(name).alias("table_name"), F.explode(columns).alias("c"), "row_count").select(
                "table_name", "c.*", "row_count"
            )
        )
    return _stack(frames)


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a fixed order: each task keeps its own ``n``."""
    return df.orderBy(*order).limit(n)


def profile_samples(tables: Mapping[str, DataFrame], n: int = 10) -> DataFrame:
    """(table_name, position, row): ``n`` rows of each table as JSON, the first ones in the order of that text.

    Each task keeps ``n`` rows of a table at most.
    """
    frames = []
    for name, df in tables.items():
        shown = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        first = df.select(shown.alias("row")).orderBy("row").limit(n)
        numbered = first.agg(F.sort_array(F.collect_list("row")).alias("rows"))
        frames.append(
            numbered.select(F.lit(name).alias("table_name"), F.posexplode("rows").alias("position", "row")).withColumn(
                "position", F.col("position") + 1
            )
        )
    return _stack(frames)


def profile_layer(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    """(table_name, status, row_count, column_count, columns) per name; one bad table does not stop the rest."""
    kinds = "table_name string, status string, row_count bigint, column_count int, columns string"
    rows = []
    for name in names:
        try:
            df = read_table(spark, base, name)
            if df is None:
                rows.append((name, "missing", None, None, None))
            else:
                rows.append((name, "ok", df.count(), len(df.columns), df.schema.simpleString()))
        except PySparkException as error:
            rows.append((name, f"failed: {error.getCondition() or type(error).__name__}", None, None, None))
        except Py4JJavaError as error:  # a file that cannot be read surfaces as a plain JVM error
            rows.append((name, f"failed: {error.java_exception.getClass().getSimpleName()}", None, None, None))
    return spark.createDataFrame(rows, kinds)


def counted(name: str, df: DataFrame, change: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, Callable[[], tuple]]:
    """``change(df)`` with its rows in and out observed by the job that writes it; call the second after that.

    ``df`` belongs to ``session.observing_session``. No job is run for the counts. The first one over the input gives the rows in, also where ``change`` looks at
    its input beforehand (medians). A task that runs again for a lost executor may be counted twice.
    """
    rows_in, rows_out = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    changed = change(df.observe(rows_in, count)).observe(rows_out, count)
    return changed, lambda: (name, rows_in.get["rows"], rows_out.get["rows"])


def count_rows(spark: SparkSession, found: Sequence[tuple]) -> DataFrame:
    """(table_name, rows_in, rows_removed, rows_out) of what ``counted`` has seen, one row per table."""
    rows = [(name, before, before - after, after) for name, before, after in found]
    return spark.createDataFrame(rows, "table_name string, rows_in bigint, rows_removed bigint, rows_out bigint")
