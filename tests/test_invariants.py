"""Invariants of the star schema and agreement of the DataFrame KPIs with
their plain Spark SQL statements (join first, aggregate after)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.plans import kpis
from strata.plans.medallion import STAR_TABLES
from strata.plans.queries import lake as make_lake


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return make_lake(spark, sf_dir)


def test_fact_sales_grain_is_items_joined_to_orders(lake):
    items = lake.model("silver_order_items")
    orders = lake.model("silver_orders")
    assert lake.model("fact_sales").count() == items.join(orders, "order_id").count()


def test_revenue_totals_agree(lake):
    monthly = kpis.monthly_revenue(lake).agg(F.sum("monthly_revenue")).first()[0]
    total = kpis.total_revenue(lake).first().total_revenue
    by_state = kpis.sales_by_state(lake).agg(F.sum("revenue")).first()[0]
    period = kpis.monthly_revenue_period(lake).agg(F.sum("revenue")).first()[0]
    assert monthly == pytest.approx(total, abs=1e-6)
    assert by_state == pytest.approx(total, abs=1e-6)
    assert period == pytest.approx(total, abs=1e-6)


def test_one_review_per_order(lake):
    reviews = lake.model("fact_reviews")
    assert reviews.count() == reviews.select("order_id").distinct().count()


def test_dimension_keys_unique(lake):
    for model, key in [("dim_customer", "customer_id"), ("dim_seller", "seller_id"),
                       ("dim_product", "product_id"), ("dim_date", "date_key"),
                       ("fact_orders", "order_id")]:
        df = lake.model(model)
        assert df.count() == df.select(key).distinct().count(), model


def test_payment_totals_match_chart_over_joined_orders(lake):
    totals = {r.payment_type: r.payment_value for r in kpis.payment_totals(lake).collect()}
    trends = kpis.payment_trends(lake).groupBy("payment_type").agg(F.sum("payment_value").alias("v"))
    for r in trends.collect():
        assert totals[r.payment_type] == pytest.approx(r.v, abs=1e-6)


MONEY = "cast(round(sum(cast({} as decimal(18,2))), 2) as double)"

SQL_KPIS = {
    "monthly_revenue": (
        kpis.monthly_revenue,
        f"""select d.year, d.month, {MONEY.format('f.revenue')} monthly_revenue
            from fact_sales f join dim_date d on f.date_key = d.date_key group by d.year, d.month""",
    ),
    "revenue_by_category": (
        kpis.revenue_by_category,
        f"""select p.product_category_name_english category, {MONEY.format('f.revenue')} revenue
            from fact_sales f join dim_product p on f.product_id = p.product_id
            group by p.product_category_name_english""",
    ),
    "top_sellers": (
        kpis.top_sellers,
        f"""select s.seller_id, s.seller_city, s.seller_state, {MONEY.format('f.revenue')} revenue
            from fact_sales f join dim_seller s on f.seller_id = s.seller_id
            group by s.seller_id, s.seller_city, s.seller_state
            order by revenue desc, seller_id, seller_city limit 20""",
    ),
    "sales_by_state": (
        kpis.sales_by_state,
        f"""select c.customer_state, {MONEY.format('f.revenue')} revenue
            from fact_sales f join dim_customer c on f.customer_id = c.customer_id
            group by c.customer_state""",
    ),
    "delivery_by_state": (
        kpis.delivery_by_state,
        """select c.customer_state, round(avg(o.delivery_days), 2) avg_delivery_days,
                  count(*) delivered_orders
           from fact_orders o join dim_customer c on o.customer_id = c.customer_id
           where o.order_status = 'delivered' and o.delivery_days is not null
           group by c.customer_state""",
    ),
    "payment_trends": (
        kpis.payment_trends,
        f"""select d.year, d.month, p.payment_type, {MONEY.format('p.payment_value')} payment_value
            from fact_payments p join dim_date d on p.date_key = d.date_key
            group by d.year, d.month, p.payment_type""",
    ),
    "review_by_category": (
        kpis.review_by_category,
        """select p.product_category_name_english category,
                  round(avg(r.review_score), 2) avg_review_score, count(*) review_item_rows
           from fact_reviews r join fact_sales f on r.order_id = f.order_id
           join dim_product p on f.product_id = p.product_id
           group by p.product_category_name_english""",
    ),
}


@pytest.mark.parametrize("name", sorted(SQL_KPIS))
def test_dataframe_kpi_equals_sql_kpi(spark, lake, name):
    fn, sql = SQL_KPIS[name]
    for table in STAR_TABLES:
        lake.model(table).createOrReplaceTempView(table)
    def key(row):
        return tuple((v is None, "" if v is None else str(v)) for v in row)

    got = sorted((tuple(r) for r in fn(lake).collect()), key=key)
    want = sorted((tuple(r) for r in spark.sql(sql).collect()), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if isinstance(a, float):
                # averages of doubles in SQL vs exact ratios: equal to the cent
                assert a == pytest.approx(float(b), abs=0.0051)
            else:
                assert a == b
