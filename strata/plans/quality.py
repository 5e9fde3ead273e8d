"""Data-quality profile and declarative data tests (§2.11–2.12).

Every report is a DataFrame: one small aggregation per checked table,
stacked with ``unionByName``.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import percent_text, rounded_ratio
from strata.operators import distinct_key_count, duplicate_counts, null_counts, union_all
from strata.plans.medallion import Lake
from strata.plans.models import GEO_COLUMNS

# The table notes of the reference's inventory report.
TABLE_NOTES = (
    ("orders", "lifecycle timestamps + status"),
    ("order_items", "product, seller, price, freight"),
    ("order_payments", "type, installments, value"),
    ("order_reviews", "score 1–5 + comments"),
    ("customers", "city, state, zip"),
    ("sellers", "city, state, zip"),
    ("products", "category, dimensions, weight"),
    ("geolocation", "zip → lat/lng"),
    ("category_translation", "PT → EN category names"),
)

# The reference's duplicate checks — (table, key columns, label, action).
DUPLICATE_CHECKS = (
    ("orders", ("order_id",), "orders.order_id", "none"),
    ("order_items", ("order_id", "order_item_id"), "order_items.(order_id, order_item_id)", "none"),
    (
        "order_payments",
        ("order_id", "payment_sequential"),
        "order_payments.(order_id, payment_sequential)",
        "none",
    ),
    ("customers", ("customer_id",), "customers.customer_id", "none"),
    (
        "customers",
        ("customer_unique_id",),
        "customers.customer_unique_id (repeat buyers)",
        "expected — not removed",
    ),
    ("sellers", ("seller_id",), "sellers.seller_id", "none"),
    ("products", ("product_id",), "products.product_id", "none"),
    ("order_reviews", ("review_id",), "reviews.review_id", "de-duplicate"),
    (
        "order_reviews",
        ("order_id",),
        "reviews.order_id (multi-review orders)",
        "keep latest review per order",
    ),
    ("geolocation", GEO_COLUMNS, "geolocation full-row", "de-duplicate"),
)

# The columns whose NULLs the reference reports.
NULL_CHECKS = (
    ("orders", ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")),
    ("order_reviews", ("review_comment_title", "review_comment_message")),
    ("products", ("product_category_name",)),
)

# The reference's declarative tests (model, column, tests).
DATA_TESTS = (
    ("dim_customer", "customer_id", ("unique", "not_null")),
    ("dim_seller", "seller_id", ("unique", "not_null")),
    ("dim_product", "product_id", ("unique", "not_null")),
    ("fact_sales", "order_id", ("not_null",)),
    ("fact_sales", "revenue", ("not_null",)),
    ("fact_orders", "order_id", ("unique", "not_null")),
)


def _raw(lake: Lake, table: str) -> DataFrame:
    return lake.model(f"bronze_{table}")


def table_inventory(lake: Lake) -> DataFrame:
    """Rows per raw table with its note (A5)."""
    return union_all(
        [
            _raw(lake, table).agg(
                F.lit(table).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(note).alias("notes"),
            )
            for table, note in TABLE_NOTES
        ]
    )


def duplicate_keys(lake: Lake) -> DataFrame:
    """Duplicate counts per key, NULL keys counted like values.

    One scan a table; the keys of all checks are counted in one exchange of
    tagged hashes.  A check of an empty table reports no duplicates.
    """
    tables = list(dict.fromkeys(t for t, _, _, _ in DUPLICATE_CHECKS))
    counts = duplicate_counts(
        [
            (_raw(lake, table), {i: cols for i, (t, cols, _, _) in enumerate(DUPLICATE_CHECKS) if t == table})
            for table in tables
        ]
    )
    numbers = range(len(DUPLICATE_CHECKS))
    found = counts.agg(*[F.max(F.when(F.col("tag") == i, F.col("duplicates"))).alias(f"c{i}") for i in numbers])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(label).alias("key_name"),
                F.coalesce(f"c{i}", F.lit(0)).cast("long").alias("duplicates"),
                F.lit(action).alias("action"),
            )
            for i, (table, _, label, action) in enumerate(DUPLICATE_CHECKS)
        ]
    )
    return found.select(F.inline(rows))


def dedupe_effect(lake: Lake) -> DataFrame:
    """Rows before and after the two clean-up rules, each in one aggregate (A5)."""
    geo = _raw(lake, "geolocation").select(*GEO_COLUMNS)
    reviews = _raw(lake, "order_reviews").select("review_id")
    return union_all(
        [
            geo.agg(
                F.lit("geolocation").alias("table_name"),
                F.lit("full-row").alias("rule"),
                F.count(F.lit(1)).alias("rows_before"),
                distinct_key_count(list(GEO_COLUMNS)).alias("rows_after"),
            ),
            reviews.agg(
                F.lit("order_reviews").alias("table_name"),
                F.lit("review_id").alias("rule"),
                F.count(F.lit(1)).alias("rows_before"),
                distinct_key_count(["review_id"]).alias("rows_after"),
            ),
        ]
    )


def null_profile(lake: Lake) -> DataFrame:
    """NULL count and percentage (1 decimal, half-up; also as ``12.3%`` text).

    One aggregation per table (a single scan for all its columns), turned
    into one row per column with ``unpivot``.
    """
    frames = []
    for table, cols in NULL_CHECKS:
        counts = null_counts(_raw(lake, table), list(cols))
        rows = counts.unpivot(["__rows"], list(cols), "column_name", "nulls")
        frames.append(
            rows.select(
                F.lit(table).alias("table_name"),
                "column_name",
                "nulls",
                rounded_ratio(F.col("nulls") * 100, "__rows", 1).alias("pct"),
            ).withColumn("pct_text", percent_text("pct", 1))
        )
    return union_all(frames)


def _status(failures: str) -> F.Column:
    return F.when(F.col(failures) == 0, "pass").otherwise("fail")


def _key_tests(lake: Lake, model: str, column: str, tests: tuple[str, ...]) -> DataFrame:
    """``unique`` (and ``not_null``) of one key column from a single ``groupBy(key)``.

    Failing unique keys are the non-NULL keys counted more than once; the
    NULL key's group size is the not-null failure count, so both tests share
    one aggregation (partial on the map side, so a hot key is collapsed early).
    """
    per_key = lake.model(model).groupBy(column).count()
    key = F.col(column)
    counts = per_key.agg(
        F.count_if(key.isNotNull() & (F.col("count") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(key.isNull(), F.col("count"))), F.lit(0)).cast("long").alias("not_null"),
    )
    rows = counts.unpivot([], list(tests), "test_name", "failures")
    return rows.select(
        "test_name",
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        "failures",
    ).withColumn("status", _status("failures"))


def _not_null_tests(lake: Lake, model: str, columns: list[str]) -> DataFrame:
    """All not-null tests of one model in a single aggregation, one row per column."""
    counts = lake.model(model).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.unpivot([], columns, "column_name", "failures")
    return rows.select(
        F.lit("not_null").alias("test_name"),
        F.lit(model).alias("model"),
        "column_name",
        "failures",
    ).withColumn("status", _status("failures"))


def test_unique(lake: Lake) -> DataFrame:
    return union_all([_key_tests(lake, m, c, ("unique",)) for m, c, tests in DATA_TESTS if "unique" in tests])


def test_not_null(lake: Lake) -> DataFrame:
    by_model: dict[str, list[str]] = {}
    for m, c, tests in DATA_TESTS:
        if "not_null" in tests:
            by_model.setdefault(m, []).append(c)
    return union_all([_not_null_tests(lake, m, cols) for m, cols in by_model.items()])


def test_summary(lake: Lake) -> DataFrame:
    """All ten tests; a key column with both tests is aggregated once."""
    frames = []
    not_null_only: dict[str, list[str]] = {}
    for m, c, tests in DATA_TESTS:
        if "unique" in tests:
            frames.append(_key_tests(lake, m, c, tuple(t for t in ("unique", "not_null") if t in tests)))
        elif "not_null" in tests:
            not_null_only.setdefault(m, []).append(c)
    frames += [_not_null_tests(lake, m, cols) for m, cols in not_null_only.items()]
    return union_all(frames)
