"""The business questions on the star schema (§2.11).

Plan shape used throughout: aggregate the fact on the dimension's key
first (partial aggregation on the map side, so a hot key is collapsed
before any shuffle), then join the now key-grained result to the
dimension — the aggregate's output is already hash-partitioned on the
join key, so only the dimension moves — then aggregate to the reported
grain.  Catalyst does not push aggregates below joins by itself; the
result is identical because every dimension key is unique (see
``test_unique``) and decimal sums are exact.

Money is summed as decimal (order-free); reported averages are exact
integer ratios rounded half-up (``rounded_ratio``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import (
    cents_of_days,
    elapsed_seconds,
    id_prefix,
    missing_label,
    money_sum,
    rounded_ratio,
    thousands,
    to_money_double,
)
from strata.operators import enrich_bounded, top_k
from strata.plans.medallion import Lake
from strata.plans.models import REVIEW_COLUMNS, dedupe_review_ids

REVENUE = "revenue"


def _revenue_by(sales: DataFrame, key: str) -> DataFrame:
    """Exact decimal revenue per key (``rev``)."""
    return sales.groupBy(key).agg(money_sum(REVENUE).alias("rev"))


def _sum_by_order_attribute(
    lake: Lake,
    fact: str,
    lines: str,
    measure: str,
    order_keys: tuple[str, ...],
    line_keys: tuple[str, ...] = (),
    where: F.Column | None = None,
) -> DataFrame:
    """Exact money sum (``rev``) of a line-grain fact per order attributes (+ line attributes).

    ``fact`` is ``lines ⋈ silver_orders`` on ``order_id`` (fact_sales,
    fact_payments).  Over a materialized fact this is one aggregation of
    it.  Composed from silver, the lines are first summed per order (and
    line key) — partial aggregation on the map side, so the join moves one
    row per order instead of one per line and a hot order is collapsed
    before the shuffle — and the per-order sums are then joined to the
    orders.  Both forms equal the fact-table aggregate: decimal sums are
    exact and the join multiplicity is unchanged.  ``where`` may only use
    order columns.
    """
    if lake.is_materialized(fact):
        rows = lake.model(fact)
        if where is not None:
            rows = rows.where(where)
        return rows.groupBy(*order_keys, *line_keys).agg(money_sum(measure).alias("rev"))
    per_order = (
        lake.model(lines)
        .groupBy("order_id", *line_keys)
        .agg(money_sum(measure).alias("rev"))
    )
    orders = lake.model("silver_orders").select("order_id", *order_keys)
    if where is not None:
        orders = orders.where(where)
    return (
        per_order.join(orders, "order_id")
        .groupBy(*order_keys, *line_keys)
        .agg(F.sum("rev").alias("rev"))
    )


def _revenue_by_order_attribute(lake: Lake, key: str, where: F.Column | None = None) -> DataFrame:
    """Revenue (``rev``) per attribute of the order (date key, customer, date)."""
    return _sum_by_order_attribute(lake, "fact_sales", "silver_order_items", REVENUE, (key,), (), where)


def _payments_by(lake: Lake, order_keys: tuple[str, ...], where: F.Column | None = None) -> DataFrame:
    """Payment value (``rev``) per order attributes and payment type."""
    return _sum_by_order_attribute(
        lake, "fact_payments", "silver_order_payments", "payment_value", order_keys, ("payment_type",), where
    )


def _month_of(d: str) -> F.Column:
    """First day of the month: a cheap grouping key, formatted only after aggregation."""
    return F.trunc(F.col(d), "month")


# ------------------------------------------------------------- SQL KPIs 1–7


def monthly_revenue(lake: Lake) -> DataFrame:
    """KPI 1: revenue by (year, month) through dim_date (NULL dates drop out, D13)."""
    by_day = _revenue_by_order_attribute(lake, "date_key")
    dates = lake.model("dim_date").select("date_key", "year", "month")
    return (
        by_day.join(dates, "date_key")
        .groupBy("year", "month")
        .agg(to_money_double(F.sum("rev")).alias("monthly_revenue"))
        .orderBy("year", "month")
    )


def revenue_by_category(lake: Lake) -> DataFrame:
    """KPI 2 (SQL form): inner join to dim_product, NULL category kept, all rows."""
    by_product = _revenue_by(lake.model("fact_sales"), "product_id")
    products = lake.model("dim_product").select(
        "product_id", F.col("product_category_name_english").alias("category")
    )
    return (
        by_product.join(products, "product_id")
        .groupBy("category")
        .agg(to_money_double(F.sum("rev")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
    )


def top_sellers(lake: Lake, k: int = 20) -> DataFrame:
    """KPI 3 (SQL form): top ``k`` sellers by revenue with city and state."""
    by_seller = _revenue_by(lake.model("fact_sales"), "seller_id")
    sellers = lake.model("dim_seller").select("seller_id", "seller_city", "seller_state")
    ranked = by_seller.join(sellers, "seller_id").select(
        "seller_id", "seller_city", "seller_state", to_money_double("rev").alias("revenue")
    )
    return top_k(ranked, k, [F.desc("revenue"), F.asc("seller_id"), F.asc("seller_city")])


def sales_by_state(lake: Lake) -> DataFrame:
    """KPI 4 (SQL form): revenue by customer state, inner join."""
    by_customer = _revenue_by_order_attribute(lake, "customer_id")
    customers = lake.model("dim_customer").select("customer_id", "customer_state")
    return (
        by_customer.join(customers, "customer_id")
        .groupBy("customer_state")
        .agg(to_money_double(F.sum("rev")).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("customer_state"))
    )


def _delivered(lake: Lake) -> DataFrame:
    return lake.model("fact_orders").where(
        (F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull()
    )


def delivery_by_state(lake: Lake) -> DataFrame:
    """KPI 5 (SQL form): mean of the 2-decimal delivery days, rounded to 2, and a count."""
    per_customer = (
        _delivered(lake)
        .groupBy("customer_id")
        .agg(F.sum(cents_of_days("delivery_days")).alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    customers = lake.model("dim_customer").select("customer_id", "customer_state")
    per_state = (
        per_customer.join(customers, "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    )
    return per_state.select(
        "customer_state",
        rounded_ratio("cents", F.col("n") * 100, 2).alias("avg_delivery_days"),
        F.col("n").alias("delivered_orders"),
    ).orderBy("avg_delivery_days", F.asc_nulls_last("customer_state"))


def delivery_unrounded(lake: Lake) -> DataFrame:
    """KPI 5 (pandas form): mean of *unrounded* days, left join, NULL state dropped.

    Computed as Σ elapsed seconds / (n · 86400), rounded half-up to 6 places.
    """
    orders = _delivered(lake).select(
        "customer_id",
        elapsed_seconds("order_purchase_timestamp", "order_delivered_customer_date").alias("secs"),
    )
    per_customer = orders.groupBy("customer_id").agg(
        F.sum("secs").alias("secs"), F.count(F.lit(1)).alias("n")
    )
    customers = lake.model("dim_customer").select("customer_id", "customer_state")
    per_state = (
        per_customer.join(customers, "customer_id", "left")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("secs").alias("secs"), F.sum("n").alias("n"))
    )
    return per_state.select(
        "customer_state",
        rounded_ratio("secs", F.col("n") * 86400, 6).alias("avg_delivery_days"),
    ).orderBy("avg_delivery_days", "customer_state")


def payment_trends(lake: Lake) -> DataFrame:
    """KPI 6: payment value by (year, month, payment_type) through dim_date."""
    by_day = _payments_by(lake, ("date_key",))
    dates = lake.model("dim_date").select("date_key", "year", "month")
    return (
        by_day.join(dates, "date_key")
        .groupBy("year", "month", "payment_type")
        .agg(to_money_double(F.sum("rev")).alias("payment_value"))
        .orderBy("year", "month", "payment_type")
    )


#: Parts that an order's items are spread over in the review join.
ORDER_PARTS = 4


def _review_scores_by_product(lake: Lake) -> DataFrame:
    """Σ score and item rows per product for reviewed orders (J6, pre-aggregated).

    Items are first counted per (order, product) with partial sums, so an
    order that repeats a product moves one row; the review's score is then
    weighted by the count.  The join is on the order and a part of the
    product's hash: an order with very many products is spread, and both
    sides are fresh exchanges that AQE can split further.  Composed from
    silver, an order that occurs ``c`` times in ``silver_orders`` repeats
    its items and its review ``c`` times each, as in the fact tables.
    """
    if lake.is_materialized("fact_sales") and lake.is_materialized("fact_reviews"):
        reviews = lake.model("fact_reviews").select("order_id", "review_score", F.lit(1).alias("times"))
        items = lake.model("fact_sales")
    else:
        orders = lake.model("silver_orders").groupBy("order_id").agg(F.count(F.lit(1)).alias("c"))
        reviews = (
            lake.model("silver_order_reviews")
            .select("order_id", "review_score")
            .join(orders, "order_id")
            .select("order_id", "review_score", (F.col("c") * F.col("c")).alias("times"))
        )
        items = lake.model("silver_order_items")
    counted = items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("product_id"), F.lit(ORDER_PARTS)).cast("int")
    parts = F.explode(F.array(*[F.lit(k) for k in range(ORDER_PARTS)]))
    rows = F.col("n") * F.col("times")
    return (
        counted.withColumn("part", part)
        .join(reviews.withColumn("part", parts), ["order_id", "part"])
        .groupBy("product_id")
        .agg(
            F.sum(F.col("review_score") * rows).alias("s"),
            F.sum(rows).alias("n"),
            F.sum(F.when(F.col("review_score").isNotNull(), rows).otherwise(0)).alias("scored"),
        )
    )


def review_by_category(lake: Lake) -> DataFrame:
    """KPI 7 (SQL form): average review score per category at item grain, with row count."""
    products = lake.model("dim_product").select(
        "product_id", F.col("product_category_name_english").alias("category")
    )
    per_category = (
        _review_scores_by_product(lake)
        .join(products, "product_id")
        .groupBy("category")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("scored").alias("scored"))
    )
    return per_category.select(
        "category",
        rounded_ratio("s", "scored", 2).alias("avg_review_score"),
        F.col("n").alias("review_item_rows"),
    ).orderBy(F.desc("avg_review_score"), F.asc_nulls_last("category"))


# ------------------------------------------------------- report variants


def _revenue_by_purchase_date(lake: Lake) -> DataFrame:
    """Revenue per purchase date; orders without a purchase date are left out."""
    return _revenue_by_order_attribute(lake, "purchase_date", F.col("purchase_date").isNotNull())


def _revenue_by_month(lake: Lake) -> DataFrame:
    """Revenue per purchase month (``m`` = first day), from the per-date sums."""
    return (
        _revenue_by_purchase_date(lake)
        .groupBy(_month_of("purchase_date").alias("m"))
        .agg(F.sum("rev").alias("rev"))
    )


def monthly_revenue_period(lake: Lake) -> DataFrame:
    """Revenue per ``yyyy-MM`` purchase month (pandas form of KPI 1)."""
    return (
        _revenue_by_month(lake)
        .select(
            F.date_format("m", "yyyy-MM").alias("purchase_month"),
            to_money_double("rev").alias("revenue"),
        )
        .orderBy("purchase_month")
    )


def total_revenue(lake: Lake) -> DataFrame:
    """Grand total of all sales, those of orders without a purchase date included (A4)."""
    return _revenue_by_order_attribute(lake, "purchase_date").agg(
        to_money_double(F.sum("rev")).alias("total_revenue")
    )


def report_monthly_revenue(lake: Lake) -> DataFrame:
    """Report lines: each month's revenue as ``1,234.56`` text, then the total.

    The facts are aggregated once to months; the total is a ``rollup`` over
    those few month rows, so the sales are scanned a single time.  Revenue
    without a purchase date has no line but counts in the total.
    """
    months = (
        _revenue_by_order_attribute(lake, "purchase_date")
        .groupBy(_month_of("purchase_date").alias("m"))
        .agg(F.sum("rev").alias("rev"))
    )
    lines = (
        months.rollup("m")
        .agg(F.sum("rev").alias("rev"), F.grouping("m").alias("is_total"))
        .where(F.col("m").isNotNull() | (F.col("is_total") == 1))
    )
    return lines.select(
        F.when(F.col("is_total") == 1, F.lit("Total revenue"))
        .otherwise(F.date_format("m", "yyyy-MM"))
        .alias("label"),
        thousands(F.round("rev", 2), 2).alias("revenue_brl"),
    )


def category_top10(lake: Lake, k: int = 10) -> DataFrame:
    """KPI 2 (pandas form): left join, NULL category dropped, top ``k``, ``(missing)`` label."""
    by_product = _revenue_by(lake.model("fact_sales"), "product_id")
    products = lake.model("dim_product").select(
        "product_id", F.col("product_category_name_english").alias("category")
    )
    per_category = (
        by_product.join(products, "product_id", "left")
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(to_money_double(F.sum("rev")).alias("revenue"))
    )
    best = top_k(per_category, k, [F.desc("revenue"), F.asc("category")])
    return best.select(missing_label("category").alias("category"), "revenue")


def sellers_top10(lake: Lake, k: int = 10) -> DataFrame:
    """KPI 3 (pandas form): aggregate, take the top ``k``, then enrich (J8); a NULL seller is no group."""
    by_seller = _revenue_by(lake.model("fact_sales").where(F.col("seller_id").isNotNull()), "seller_id").select(
        "seller_id", to_money_double("rev").alias("revenue")
    )
    best = top_k(by_seller, k, [F.desc("revenue"), F.asc("seller_id")])
    sellers = lake.model("dim_seller").select("seller_id", "seller_city", "seller_state")
    return enrich_bounded(best, k, sellers, "seller_id").select(
        "seller_id",
        id_prefix("seller_id").alias("seller_label"),
        "seller_city",
        "seller_state",
        "revenue",
    )


def state_left(lake: Lake) -> DataFrame:
    """KPI 4 (pandas form): left join, NULL state dropped."""
    by_customer = _revenue_by_order_attribute(lake, "customer_id")
    customers = lake.model("dim_customer").select("customer_id", "customer_state")
    return (
        by_customer.join(customers, "customer_id", "left")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(to_money_double(F.sum("rev")).alias("revenue"))
        .orderBy(F.desc("revenue"), "customer_state")
    )


def _payments_by_month(lake: Lake) -> DataFrame:
    by_date = _payments_by(lake, ("purchase_date",), F.col("purchase_date").isNotNull())
    return (
        by_date.groupBy(_month_of("purchase_date").alias("m"), "payment_type")
        .agg(F.sum("rev").alias("v"))
        .select(
            F.date_format("m", "yyyy-MM").alias("purchase_month"),
            "payment_type",
            to_money_double("v").alias("payment_value"),
        )
    )


def payment_totals(lake: Lake) -> DataFrame:
    """Total payment value per type (pandas form of KPI 6); a NULL type is no group."""
    return (
        _payments_by(lake, ())
        .where(F.col("payment_type").isNotNull())
        .select("payment_type", to_money_double("rev").alias("payment_value"))
        .orderBy(F.desc("payment_value"), "payment_type")
    )


def payment_recent_months(lake: Lake, months: int = 6) -> DataFrame:
    """Month × type values for the last ``months`` distinct months (A13, J9); a NULL type is no group.

    The recent months are the top of the distinct months (each task keeps
    ``months`` of them), and the month × type aggregate is semi-joined to
    them; its exchange is reused.
    """
    pay = _payments_by_month(lake).where(F.col("payment_type").isNotNull())
    recent = pay.select("purchase_month").distinct().orderBy(F.desc("purchase_month")).limit(months)
    return pay.join(recent, "purchase_month", "left_semi").orderBy("purchase_month", "payment_type")


def review_top15(lake: Lake, k: int = 15) -> DataFrame:
    """KPI 7 (pandas form): NULL category dropped, top ``k`` by mean score."""
    products = lake.model("dim_product").select(
        "product_id", F.col("product_category_name_english").alias("category")
    )
    per_category = (
        _review_scores_by_product(lake)
        .join(products, "product_id", "left")
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.sum("s").alias("s"), F.sum("scored").alias("scored"))
    )
    mean = F.when(F.col("scored") > 0, F.col("s").cast("double") / F.col("scored").cast("double"))
    best = top_k(per_category, k, [mean.desc_nulls_last(), F.asc("category")])
    return best.select(
        missing_label("category").alias("category"),
        rounded_ratio("s", "scored", 2).alias("avg_review_score"),
    )


def latest_review_per_order(lake: Lake) -> DataFrame:
    """The window-free form of the per-order review rule.

    The aggregate holds only keys and ordering columns (fixed-width ones, and
    the review id as the tie-break); the payload of the winners is joined back.
    """
    one_per_review = dedupe_review_ids(lake.model("bronze_order_reviews")).select(*REVIEW_COLUMNS)
    latest = one_per_review.groupBy("order_id").agg(F.max("review_answer_timestamp").alias("last"))
    at_last = one_per_review.join(
        latest.withColumnRenamed("order_id", "latest_order"),
        F.col("order_id").eqNullSafe(F.col("latest_order"))
        & F.col("review_answer_timestamp").eqNullSafe(F.col("last")),
    )
    first = at_last.groupBy("order_id").agg(F.min(F.struct("review_id"))["review_id"].alias("first_id"))
    picked = one_per_review.join(
        first.withColumnRenamed("order_id", "picked_order"),
        F.col("order_id").eqNullSafe(F.col("picked_order")) & F.col("review_id").eqNullSafe(F.col("first_id")),
    )
    return picked.select(*REVIEW_COLUMNS).withColumn(
        "review_score", F.col("review_score").try_cast("int")
    )
