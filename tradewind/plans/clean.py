"""Cleaning rules, one function per table. Input: normalized table; output: typed clean table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.text import map_values, replace_if_contains, strip_accents
from tradewind.functions.timestamps import with_timestamps
from tradewind.operators.columns import keep_unless, rename_or_add
from tradewind.operators.dedupe import one_per_key
from tradewind.operators.impute import median_impute
from tradewind.sources.schema import typed_numbers

# Fixed values of the cleaning rules.
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
PAYMENT_NAMES = {"boleto": "bank_slip"}
UNDEFINED_PAYMENT = "not_defined"
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
PRODUCT_MEASURES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
CITY_FIXES = {"sao miguel": "sao miguel d'oeste", "sao pau": "sao paulo"}
EXTRA_TRANSLATIONS = (
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_and_food_preparers"),
    ("pc_gamer", "pc_gamer"),
)


def impossible_timeline() -> Column:
    """True where two known times of an order contradict each other; NULL where that is unknown."""
    purchase, approved, carrier, delivered, estimated = (F.col(c) for c in ORDER_TIMES)
    return (approved < purchase) | (carrier < approved) | (delivered < carrier) | (estimated < purchase)


def clean_orders(df: DataFrame) -> DataFrame:
    df = with_timestamps(df, ORDER_TIMES)
    return one_per_key(keep_unless(df, impossible_timeline()), ["order_id"])


def clean_items(df: DataFrame) -> DataFrame:
    df = typed_numbers(df, "order_items").where((F.col("price") > 0) & (F.col("freight_value") >= 0))
    df = df.withColumnsRenamed({"shipping_limit_date": "shipping_deadline"})
    return with_timestamps(df, ["shipping_deadline"], fmt=None)


def clean_payments(df: DataFrame) -> DataFrame:
    df = typed_numbers(df, "order_payments")
    df = df.withColumn("payment_type", map_values(F.col("payment_type"), PAYMENT_NAMES))
    return df.where(F.col("payment_type") != UNDEFINED_PAYMENT)


def clean_reviews(df: DataFrame) -> DataFrame:
    df = typed_numbers(df, "order_reviews")
    df = with_timestamps(df, ["review_creation_date", "review_answer_timestamp"], fmt=None)
    return one_per_key(df.where(F.col("review_id").isNotNull()), ["review_id"])


def clean_products(df: DataFrame) -> DataFrame:
    """Runs two small jobs to find the medians."""
    df = typed_numbers(rename_or_add(df, PRODUCT_RENAMES), "products")
    # Renamed columns are not under their old names any more, so they are typed here.
    df = df.withColumns({c: F.col(c).try_cast("double") for c in PRODUCT_RENAMES.values()})
    if "product_category_name" in df.columns:
        df = df.where(F.col("product_category_name").isNotNull())
    return median_impute(df, PRODUCT_MEASURES)


def clean_translations(df: DataFrame, extra=EXTRA_TRANSLATIONS) -> DataFrame:
    """One English name per category; an extra row counts only where the table has none."""
    columns = ["product_category_name", "product_category_name_english"]
    pairs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in extra]
    added = df.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    both = df.withColumn("__rank", F.lit(0)).unionByName(
        added.withColumn("__rank", F.lit(1)), allowMissingColumns=True
    )
    return one_per_key(both, ["product_category_name"], order=["__rank"]).drop("__rank")


def clean_sellers(df: DataFrame) -> DataFrame:
    df = one_per_key(df.where(F.col("seller_id").isNotNull()), ["seller_id"])
    if "seller_city" not in df.columns:
        return df
    city = strip_accents(F.lower(F.trim(F.col("seller_city"))))
    return df.withColumn("seller_city", city).withColumn(
        "seller_city", replace_if_contains(F.col("seller_city"), CITY_FIXES)
    )


def clean_customers(df: DataFrame) -> DataFrame:
    return one_per_key(df.where(F.col("customer_id").isNotNull()), ["customer_id"])


def clean_geolocation(df: DataFrame) -> DataFrame:
    df = typed_numbers(df, "geolocation")
    on_earth = F.col("geolocation_lat").between(-90, 90) & F.col("geolocation_lng").between(-180, 180)
    # Both bounds are on key columns, so filtering first leaves the same keys with fewer rows to reduce.
    return one_per_key(
        df.where(on_earth), ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"]
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": clean_orders,
    "order_items": clean_items,
    "order_payments": clean_payments,
    "order_reviews": clean_reviews,
    "products": clean_products,
    "product_category_name_translation": clean_translations,
    "sellers": clean_sellers,
    "customers": clean_customers,
    "geolocation": clean_geolocation,
}


def clean(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean the tables that are there."""
    return {name: CLEANERS[name](df) for name, df in tables.items() if name in CLEANERS}
