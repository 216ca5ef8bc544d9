"""The driver's test tables as the nine domain tables (the SQL form is in ``oracles``)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.session import prepare


@lru_cache(maxsize=64)
def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its schema is read from the file once per session."""
    df = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def orders(spark, sf_dir):
    shipped = source(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    placed = source(spark, sf_dir, "orders")
    return placed.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("order_approved_at"),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .otherwise(F.col("last_ship") + F.expr("INTERVAL 12 HOUR"))
        .alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1000 DAY")).alias("order_estimated_delivery_date"),
    )


def order_items(spark, sf_dir):
    return source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") - 5).alias("freight_value"),
    )


def order_payments(spark, sf_dir):
    placed = source(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "1-URGENT", "boleto")
        .when(priority == "2-HIGH", "credit_card")
        .when(priority == "3-MEDIUM", "voucher")
        .when(priority == "4-NOT SPECIFIED", "not_defined")
        .otherwise("debit_card")
    )
    first = placed.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        kind.alias("payment_type"),
        (F.col("o_orderkey") % 12 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    second = placed.where(F.col("o_orderkey") % 5 == 0).select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(2).alias("payment_sequential"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("voucher")).alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(10.5).cast("double").alias("payment_value"),
    )
    return first.unionByName(second)


def order_reviews(spark, sf_dir):
    event = F.col("event_id")
    return source(spark, sf_dir, "events").select(
        F.when(event % 97 == 0, F.lit(None)).when(event % 10 == 1, event - 1).otherwise(event).alias("review_id"),
        event.alias("order_id"),
        (event % 5 + 1).cast("int").alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        (F.col("ts") + F.expr("INTERVAL 2 DAY")).alias("review_answer_timestamp"),
    )


def customers(spark, sf_dir):
    people, places = source(spark, sf_dir, "customer"), source(spark, sf_dir, "nation")
    return people.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(spark, sf_dir):
    shops, places = source(spark, sf_dir, "supplier"), source(spark, sf_dir, "nation")
    kind = F.col("s_suppkey") % 5
    return shops.join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.when(kind == 0, " São Paulo - SP ")
        .when(kind == 1, "SAO MIGUEL")
        .when(kind == 2, "Florianópolis")
        .otherwise(F.col("s_name"))
        .alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(spark, sf_dir):
    part, size = F.col("p_partkey"), F.col("p_size")
    return source(spark, sf_dir, "part").select(
        part.alias("product_id"),
        F.when(part % 50 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        F.length("p_brand").cast("int").alias("product_description_lenght"),
        (part % 5).cast("int").alias("product_photos_qty"),
        F.when(part % 10 != 0, size.cast("double")).alias("product_weight_g"),
        (F.col("p_retailprice") - 900).alias("product_length_cm"),
        (size % 7).cast("double").alias("product_height_cm"),
        F.when(part % 13 != 0, (size % 3 + 1).cast("double")).alias("product_width_cm"),
    )


def geolocation(spark, sf_dir):
    shops = source(spark, sf_dir, "supplier").where("s_nationkey <> 7")
    places, areas = source(spark, sf_dir, "nation"), source(spark, sf_dir, "region")
    return (
        shops.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(areas, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_nationkey").alias("geolocation_zip_code_prefix"),
            (F.col("s_acctbal") / 100).alias("geolocation_lat"),
            (F.col("s_acctbal") / 40).alias("geolocation_lng"),
            F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("geolocation_city"),
            F.col("r_name").alias("geolocation_state"),
        )
    )


def translations(spark, sf_dir):
    return source(spark, sf_dir, "part").where("p_type <> 'PROMO'").select(
        F.col("p_type").alias("product_category_name"), F.lower("p_type").alias("product_category_name_english")
    ).distinct()


RAW = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "geolocation": geolocation,
    "product_category_name_translation": translations,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in RAW.items()}


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tables joined back into one export (without geo rows, see ``wide_geo``)."""
    t = raw_tables(spark, sf_dir)
    items = (
        t["order_items"]
        .join(t["products"], "product_id", "left")
        .join(t["product_category_name_translation"], "product_category_name", "left")
        .join(t["sellers"], "seller_id", "left")
    )
    return (
        t["orders"]
        .join(t["customers"], "customer_id")
        .join(items, "order_id", "left")
        .join(t["order_payments"], "order_id", "left")
        .join(t["order_reviews"], "order_id", "left")
    )


def wide_geo(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str, str]:
    """Two tables, and their columns, by which the export holds every customer with every geo row of its ZIP."""
    people, geo = customers(spark, sf_dir), geolocation(spark, sf_dir)
    return people, geo, "customer_zip_code_prefix", "geolocation_zip_code_prefix"
