"""The nine tables, their columns, and the types the clean layer gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Column names and the text timestamp format of the source data.
TEXT_TIMESTAMP = "M/d/yyyy H:mm"

TABLES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp",
        "price": "double",
        "freight_value": "double",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "order_reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp",
        "review_answer_timestamp": "timestamp",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "string",
        "seller_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "double",
        "product_description_lenght": "double",
        "product_photos_qty": "int",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "string",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
    "product_category_name_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

NUMERIC = ("int", "double")


def typed_numbers(df: DataFrame, table: str) -> DataFrame:
    """Give the number columns of ``table`` their declared type; text that is no number turns NULL.

    A comparison of text with an integer would cast the text to INT and lose the fraction, so every
    cleaning rule runs on typed columns.
    """
    wanted = {c: t for c, t in TABLES[table].items() if t in NUMERIC and c in df.columns}
    # '3.0' is a valid count in an export that went through a float column, hence the double step.
    # NaN, typed or as text, is no number either; it would pass every lower bound.
    number = {c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in wanted}
    casts = {
        c: number[c] if t == "double" else number[c].try_cast(t)
        for c, t in wanted.items()
        if t == "double" or dict(df.dtypes)[c] != t
    }
    return df.withColumns(casts) if casts else df


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select ``columns`` in order: cast those present, add the missing ones as typed NULL."""
    return df.select(
        *[
            (F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c)
            for c, t in columns.items()
        ]
    )
