"""Declared schemas of the nine landing CSVs and the file → table registry.

Types are declared, never inferred: inference turns a zip prefix such as
``01037`` into the integer 1037 and lets one malformed value turn a whole
column into strings.  Timestamps are wall-clock values without a zone in
the files, so they are ``timestamp_ntz``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, D, TS = StringType(), IntegerType(), DoubleType(), TimestampNTZType()

RETAIL_SCHEMAS: dict[str, StructType] = {
    "orders": _schema(
        ("order_id", S),
        ("customer_id", S),
        ("order_status", S),
        ("order_purchase_timestamp", TS),
        ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "order_items": _schema(
        ("order_id", S),
        ("order_item_id", I),
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", TS),
        ("price", D),
        ("freight_value", D),
    ),
    "order_payments": _schema(
        ("order_id", S),
        ("payment_sequential", I),
        ("payment_type", S),
        ("payment_installments", I),
        ("payment_value", D),
    ),
    "order_reviews": _schema(
        ("review_id", S),
        ("order_id", S),
        ("review_score", I),
        ("review_comment_title", S),
        ("review_comment_message", S),
        ("review_creation_date", TS),
        ("review_answer_timestamp", TS),
    ),
    "customers": _schema(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", S),
        ("customer_city", S),
        ("customer_state", S),
    ),
    "sellers": _schema(
        ("seller_id", S),
        ("seller_zip_code_prefix", S),
        ("seller_city", S),
        ("seller_state", S),
    ),
    "products": _schema(
        ("product_id", S),
        ("product_category_name", S),
        ("product_name_lenght", I),
        ("product_description_lenght", I),
        ("product_photos_qty", I),
        ("product_weight_g", I),
        ("product_length_cm", I),
        ("product_height_cm", I),
        ("product_width_cm", I),
    ),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S),
        ("geolocation_lat", D),
        ("geolocation_lng", D),
        ("geolocation_city", S),
        ("geolocation_state", S),
    ),
    "category_translation": _schema(
        ("product_category_name", S),
        ("product_category_name_english", S),
    ),
}


@dataclass(frozen=True)
class LandingFile:
    file_name: str
    table: str
    # Only the free-text table may hold quoted newlines; multi-line parsing
    # makes a file unsplittable, so it is enabled for that table alone.
    multiline: bool = False


# The landing file names of the nine tables.
LANDING_FILES: tuple[LandingFile, ...] = (
    LandingFile("olist_customers_dataset.csv", "customers"),
    LandingFile("olist_geolocation_dataset.csv", "geolocation"),
    LandingFile("olist_order_items_dataset.csv", "order_items"),
    LandingFile("olist_order_payments_dataset.csv", "order_payments"),
    LandingFile("olist_order_reviews_dataset.csv", "order_reviews", multiline=True),
    LandingFile("olist_orders_dataset.csv", "orders"),
    LandingFile("olist_products_dataset.csv", "products"),
    LandingFile("olist_sellers_dataset.csv", "sellers"),
    LandingFile("product_category_name_translation.csv", "category_translation"),
)
