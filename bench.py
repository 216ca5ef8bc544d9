"""Seconds per stage and per report, on one JSON line.

The test tables are first stored as the domain layer they stand for (not timed). Then the stages run
as in ``run_all``: each reads its layer from Parquet and writes the next. Reports are the warm median
of three runs on the stored commerce table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tradewind.plans import features as ft  # noqa: E402
from tradewind.plans import reports as rp  # noqa: E402
from tradewind.plans import run  # noqa: E402
from tradewind.plans import training as tr  # noqa: E402
from tradewind.plans.normalize import normalize  # noqa: E402
from tradewind.session import prepare, scratch  # noqa: E402
from tradewind.sources.layers import LayerPaths, publish, read_table  # noqa: E402
from tradewind_queries import bindings  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def median_of_three(work) -> float:
    work()  # warm-up
    return round(statistics.median(timed(work) for _ in range(3)), 3)


def main() -> None:
    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    with scratch(spark) as folder:
        run_bench(spark, folder)
    spark.stop()


def run_bench(spark: SparkSession, folder: str) -> None:
    paths = LayerPaths.under(folder, raw_csv="")
    for name, df in bindings.raw_tables(spark, SF_DIR).items():
        publish(df, paths.normalized, name)
    publish(bindings.wide(spark, SF_DIR), paths.staged, "wide")

    def normalize_wide():
        run.write_all(spark, normalize(read_table(spark, paths.staged, "wide")), f"{paths.staged}/tables")

    seconds = {
        "normalize_layer": median_of_three(normalize_wide),
        "clean_layer": median_of_three(lambda: run.clean_stage(spark, paths)),
        "commerce": median_of_three(lambda: run.wrangle_stage(spark, paths)),
    }
    commerce = read_table(spark, paths.wrangled, "commerce")
    for name, report in rp.REPORTS.items():
        seconds[name] = median_of_three(lambda: report(commerce).collect())
    seconds["eda_kpis"] = median_of_three(lambda: rp.eda_kpis(commerce).collect())

    features = ft.features_base(ft.ml_extract(commerce))
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    seconds["ml_features"] = median_of_three(lambda: noop(features))
    seconds["stratified_split"] = median_of_three(lambda: noop(ft.stratified_split(features)))
    seconds["ml_three_models"] = timed(
        lambda: tr.model_comparison(tr.train_models(features, tr.ALL_MODELS)).collect()
    )
    print(
        json.dumps(
            {
                "metric": "stages_reports_and_models_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
