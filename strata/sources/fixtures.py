"""Adapter from the driver's TPC-H-style test tables to the nine raw tables of
the retail lake (orders, order_items, order_payments, order_reviews,
customers, sellers, products, geolocation, category_translation).

The mapping is a fixed, documented convention (FIXTURES.md §3); the oracle
side writes the same definitions in DuckDB SQL.  Everything here is a lazy
DataFrame over the Parquet tables, so Catalyst prunes columns and pushes
filters into the scans of whatever query uses them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

RAW_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "customers",
    "sellers",
    "products",
    "geolocation",
    "category_translation",
)


class TestTables:
    """Lazy readers for the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]


def _purchase_ts(orderdate: Column, orderkey: Column) -> Column:
    """Order date plus a deterministic time of day, so elapsed days have fractions."""
    seconds = ((orderkey * 37) % 86400).cast("decimal(18,6)")
    return orderdate + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def customers(t: TestTables) -> DataFrame:
    c, n = t.table("customer"), t.table("nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string")).alias(
            "customer_unique_id"
        ),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(t: TestTables) -> DataFrame:
    s, n, r = t.table("supplier"), t.table("nation"), t.table("region")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("r_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
    )


def products(t: TestTables) -> DataFrame:
    p = t.table("part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (F.col("p_size") % 5).alias("product_photos_qty"),
        (F.col("p_size") * 10).alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        (F.col("p_size") + 1).alias("product_height_cm"),
        (F.col("p_size") + 2).alias("product_width_cm"),
    )


def category_translation(t: TestTables) -> DataFrame:
    p = t.table("part")
    return (
        p.where(~F.col("p_brand").isin("Brand#1", "Brand#2"))
        .select(
            F.col("p_brand").alias("product_category_name"),
            F.lower("p_brand").alias("product_category_name_english"),
        )
        .distinct()
    )


def geolocation(t: TestTables) -> DataFrame:
    c, n = t.table("customer"), t.table("nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.col("c_nationkey").cast("double") / 2).alias("geolocation_lat"),
        (F.col("c_nationkey").cast("double") / 4).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def order_items(t: TestTables) -> DataFrame:
    return t.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def order_payments(t: TestTables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "R", "credit_card")
        .when(flag == "A", "boleto")
        .otherwise("voucher")
        .alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def order_reviews(t: TestTables) -> DataFrame:
    """``ln`` and ``px`` are tie-break helpers for the review dedupe; Silver drops them."""
    li = t.table("lineitem")
    return li.select(
        F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias(
            "review_id"
        ),
        F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("review_score"),
        F.when(F.col("l_tax") > 0.06, F.col("l_returnflag")).alias("review_comment_title"),
        F.when(F.col("l_discount") > 0.05, F.concat("l_returnflag", "l_linestatus")).alias(
            "review_comment_message"
        ),
        F.col("l_shipdate").alias("review_creation_date"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .otherwise(F.col("l_shipdate"))
        .alias("review_answer_timestamp"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_extendedprice").alias("px"),
    )


def orders(t: TestTables) -> DataFrame:
    o = t.table("orders")
    # first / last ship date per order stand in for carrier and customer delivery
    shipped = t.table("lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("d0"), F.max("l_shipdate").alias("d1")
    )
    ts = _purchase_ts(F.col("o_orderdate"), F.col("o_orderkey"))
    status = F.col("o_orderstatus")
    return o.join(shipped, o.o_orderkey == shipped.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered")
        .when(status == "O", "shipped")
        .otherwise("processing")
        .alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        F.when(F.col("o_orderkey") % 500 == 0, F.lit(None)).otherwise(ts).alias("order_approved_at"),
        F.col("d0").alias("order_delivered_carrier_date"),
        F.col("d1").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30))).alias(
            "order_estimated_delivery_date"
        ),
    )


ADAPTERS = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


class RawTables(Mapping[str, DataFrame]):
    """The nine raw tables of one test folder, each defined on first use.

    Defining a DataFrame already costs an analysis pass on the driver, so a
    query that touches two raw tables only pays for those two.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._tables = TestTables(spark, sf_dir)
        self._defined: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in ADAPTERS:
            raise KeyError(name)
        if name not in self._defined:
            self._defined[name] = ADAPTERS[name](self._tables)
        return self._defined[name]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The nine raw tables of the lake, derived lazily from one test folder."""
    return RawTables(spark, sf_dir)
