"""The thirteen reports over the commerce table, the KPI row and the chart series.

Orders lost their id on the way into the commerce table: an "order" count by group is a count of
distinct statuses, and a plain count is a count of joined rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.functions.numbers import as_double, money, money_sum, safe_double, safe_long
from tradewind.functions.timestamps import whole_days
from tradewind.operators.sketches import merged_quantiles, sketch_by
from tradewind.operators.running import ONE_TASK_ROWS, quantile_of, value_counts_upto
from tradewind.sources.reportfiles import write_report


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def order_status_distribution(commerce: DataFrame) -> DataFrame:
    counts = commerce.groupBy("order_status").agg(_rows("total_orders"))
    return counts.orderBy(F.desc("total_orders"), "order_status")


def monthly_orders_revenue(commerce: DataFrame) -> DataFrame:
    month = F.date_trunc("month", "order_purchase_timestamp").alias("month")
    priced = commerce.where(as_double("price").isNotNull())
    return (
        priced.groupBy(month)
        .agg(F.count_distinct("order_status").alias("total_orders"), money_sum(F.col("price")).alias("total_revenue"))
        .orderBy("month")
    )


def top_states_by_order_count(commerce: DataFrame, n: int = 10) -> DataFrame:
    counts = commerce.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
    return counts.agg(F.count_distinct("order_status").alias("total_orders")).orderBy(
        F.desc("total_orders"), "customer_state"
    ).limit(n)


def payment_type_distribution(commerce: DataFrame) -> DataFrame:
    return (
        commerce.groupBy("payment_type")
        .agg(_rows("transactions"), money_sum(F.col("payment_value")).alias("total_value"))
        .orderBy(F.desc("transactions"), "payment_type")
    )


def installments_distribution(commerce: DataFrame) -> DataFrame:
    return commerce.groupBy("payment_installments").agg(_rows("num_orders")).orderBy("payment_installments")


def orders_per_customer(commerce: DataFrame) -> DataFrame:
    area = F.col("customer_zip_code_prefix").alias("customer_area")
    return commerce.groupBy(area).agg(F.count_distinct("order_status").alias("num_orders")).orderBy(
        F.desc("num_orders"), "customer_area"
    )


def customers_by_state(commerce: DataFrame) -> DataFrame:
    counts = commerce.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
    return counts.agg(F.count_distinct("customer_zip_code_prefix").alias("num_customers")).orderBy(
        F.desc("num_customers"), "customer_state"
    )


def top_categories_by_sales(commerce: DataFrame, n: int = 15) -> DataFrame:
    sold = commerce.where(F.col("product_category_name_english").isNotNull() & as_double("price").isNotNull())
    return (
        sold.groupBy(F.col("product_category_name_english").alias("category"))
        .agg(money_sum(F.col("price")).alias("total_sales"), F.count_distinct("order_status").alias("num_orders"))
        .orderBy(F.desc("total_sales"), "category")
        .limit(n)
    )


def product_price_distribution(commerce: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Exact quartiles and mean, from the counts of the distinct prices."""
    counts, total = value_counts_upto(commerce.select(as_double("price").alias("price")), "price", one_task_rows)
    spent = F.sum(money(F.col("price")) * F.col("n"))
    return counts.agg(
        quantile_of("price", 0.25, total).alias("p25"),
        quantile_of("price", 0.50, total).alias("median"),
        quantile_of("price", 0.75, total).alias("p75"),
        (spent.cast("double") / F.sum("n")).alias("avg_price"),
    )


def price_sketches(commerce: DataFrame) -> DataFrame:
    """A sketch of the prices of each month (``month, n, sketch``), to be stored and merged for any range of months."""
    priced = commerce.select(F.date_trunc("month", "order_purchase_timestamp").alias("month"), as_double("price").alias("price"))
    return sketch_by(priced, "price", ["month"])


def sketched_price_distribution(sketches: DataFrame) -> DataFrame:
    """(share, price, prices): approximate quartiles of the months whose sketches are given; see ``sketches.rank_error``."""
    return merged_quantiles(sketches, (0.25, 0.5, 0.75)).toDF("share", "price", "prices")


def review_score_distribution(commerce: DataFrame) -> DataFrame:
    scored = commerce.where(F.col("review_score").isNotNull())
    return scored.groupBy("review_score").agg(_rows("num_reviews")).orderBy("review_score")


def _day_distribution(commerce: DataFrame, start: str, end: str, alias: str) -> DataFrame:
    known = commerce.where(F.col(end).isNotNull())
    days = whole_days(F.col(start), F.col(end)).alias(alias)
    return known.groupBy(days).agg(_rows("num_orders")).orderBy(alias)


def delivery_delay_distribution(commerce: DataFrame) -> DataFrame:
    return _day_distribution(
        commerce, "order_estimated_delivery_date", "order_delivered_customer_date", "delay_days"
    )


def shipping_time_distribution(commerce: DataFrame) -> DataFrame:
    return _day_distribution(commerce, "order_purchase_timestamp", "order_delivered_customer_date", "shipping_days")


def carrier_time_distribution(commerce: DataFrame) -> DataFrame:
    return _day_distribution(commerce, "order_purchase_timestamp", "order_delivered_carrier_date", "carrier_days")


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        order_status_distribution,
        monthly_orders_revenue,
        top_states_by_order_count,
        payment_type_distribution,
        installments_distribution,
        orders_per_customer,
        customers_by_state,
        top_categories_by_sales,
        product_price_distribution,
        review_score_distribution,
        delivery_delay_distribution,
        shipping_time_distribution,
        carrier_time_distribution,
    )
}


def run_report(name: str, commerce: DataFrame, base: str) -> str:
    """Run one report and store it as CSV."""
    return write_report(REPORTS[name](commerce), base, name)


def eda_kpis(commerce: DataFrame) -> DataFrame:
    """The four headline numbers in one pass; equal to adding up the reports they come from."""
    score, delay = safe_long(F.col("review_score")), whole_days(
        F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    )
    scored, delivered = F.col("review_score").isNotNull(), F.col("order_delivered_customer_date").isNotNull()
    return commerce.agg(
        _rows("total_orders"),
        F.coalesce(money_sum(F.col("price")), F.lit(0.0)).alias("total_revenue"),
        (F.coalesce(F.sum(score * F.when(scored, 1)), F.lit(0)) / F.greatest(F.lit(1), F.count_if(scored))).alias(
            "avg_review_score"
        ),
        F.coalesce(F.avg(F.when(delivered, F.coalesce(delay, F.lit(0)))), F.lit(0.0)).alias("avg_delivery_delay_days"),
    )


def _series(df: DataFrame, chart: str, x: Column, values: dict[str, Column]) -> DataFrame:
    points = F.array(
        *[F.struct(F.lit(name).alias("series"), y.cast("double").alias("y")) for name, y in values.items()]
    )
    return df.select(F.lit(chart).alias("chart"), x.cast("string").alias("x"), F.explode(points).alias("p")).select(
        "chart", "x", "p.*"
    )


def eda_chart_series(reports: dict[str, DataFrame]) -> DataFrame:
    """Tidy (chart, x, series, y) of the nine charted reports, from their results."""
    spec = {
        "order_status_distribution": (F.col("order_status"), {"orders": safe_long(F.col("total_orders"))}),
        "monthly_orders_revenue": (
            F.date_format("month", "yyyy-MM-dd"),
            {"orders": safe_long(F.col("total_orders")), "revenue": safe_double(F.col("total_revenue"))},
        ),
        "payment_type_distribution": (F.col("payment_type"), {"value": safe_double(F.col("total_value"))}),
        "installments_distribution": (
            safe_long(F.col("payment_installments")),
            {"orders": safe_long(F.col("num_orders"))},
        ),
        "customers_by_state": (F.col("customer_state"), {"customers": safe_long(F.col("num_customers"))}),
        "top_categories_by_sales": (F.col("category"), {"sales": safe_double(F.col("total_sales"))}),
        "review_score_distribution": (safe_long(F.col("review_score")), {"reviews": safe_long(F.col("num_reviews"))}),
        "delivery_delay_distribution": (safe_long(F.col("delay_days")), {"orders": safe_long(F.col("num_orders"))}),
        "shipping_time_distribution": (safe_long(F.col("shipping_days")), {"orders": safe_long(F.col("num_orders"))}),
    }
    parts = [_series(reports[name], name, x, values) for name, (x, values) in spec.items() if name in reports]
    return reduce(DataFrame.unionByName, parts)


def sql_report(spark: SparkSession, table: str) -> DataFrame:
    """The status report as SQL over a registered table."""
    return spark.sql(
        f"SELECT order_status, COUNT(*) AS total_orders FROM {table} GROUP BY order_status ORDER BY total_orders DESC, order_status"
    )
