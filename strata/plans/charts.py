"""The five dashboard aggregates over the raw (bronze) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import money_sum, to_money_double
from strata.plans.medallion import Lake


def monthly_orders(lake: Lake) -> DataFrame:
    """COUNT(order_id) per purchase month, ``yyyy-MM``."""
    orders = lake.model("bronze_orders")
    month = F.trunc(F.to_date("order_purchase_timestamp"), "month")
    return (
        orders.groupBy(month.alias("m"))
        .agg(F.count("order_id").alias("orders"))
        .select(F.date_format("m", "yyyy-MM").alias("month"), "orders")
        .orderBy("month")
    )


def payment_types(lake: Lake) -> DataFrame:
    """SUM and COUNT of payments per payment type."""
    return (
        lake.model("bronze_order_payments")
        .groupBy("payment_type")
        .agg(
            to_money_double(money_sum("payment_value")).alias("total_value"),
            F.count(F.lit(1)).alias("payments"),
        )
        .orderBy(F.desc("total_value"), F.asc_nulls_last("payment_type"))
    )


def customers_by_state(lake: Lake) -> DataFrame:
    """COUNT(customer_id) per customer state."""
    return (
        lake.model("bronze_customers")
        .groupBy("customer_state")
        .agg(F.count("customer_id").alias("customers"))
        .orderBy(F.desc("customers"), F.asc_nulls_last("customer_state"))
    )


def avg_review(lake: Lake) -> DataFrame:
    """Global AVG(review_score) over all raw review rows, with the rows it averages."""
    reviews = lake.model("bronze_order_reviews")
    return reviews.agg(
        (F.sum("review_score").cast("double") / F.count("review_score")).alias("avg_review_score"),
        F.count("review_score").alias("reviews"),
    )


def top_categories(lake: Lake) -> DataFrame:
    """Items sold per (native) product category: items ⋈ products, counted.

    Items are counted per product first, so the join sees one row per product.
    """
    per_product = lake.model("bronze_order_items").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    products = lake.model("bronze_products").select("product_id", "product_category_name")
    return (
        per_product.join(products, "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("n").alias("items"))
        .orderBy(F.desc("items"), F.asc_nulls_last("product_category_name"))
    )
