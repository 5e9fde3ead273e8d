"""One key holding a third of all rows: results stay whole and right, and
the hot rows are split instead of meeting in one task.

Expectations are computed by brute force in pandas on the same small frames.
"""

from __future__ import annotations

import contextlib
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.plans import kpis
from strata.plans.medallion import Lake

N_ITEMS = 30_000  # every third item belongs to order 0
N_ORDERS = 300
N_REVIEWS = 6_000  # every third review row carries review id "r-hot"
HOT_ORDER = 0


@contextlib.contextmanager
def session_conf(spark, settings: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _ts(base: str, col, unit: str = "mins"):
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(**{unit: col.cast("int")})


@pytest.fixture(scope="module")
def sources(spark):
    i = F.col("id")
    orders = spark.range(N_ORDERS).select(
        i.alias("order_id"),
        (i % 7).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        _ts("2021-03-01 00:00:00", i, "hours").alias("order_purchase_timestamp"),
        _ts("2021-03-01 00:00:00", i, "hours").alias("order_approved_at"),
        _ts("2021-03-02 00:00:00", i, "hours").alias("order_delivered_carrier_date"),
        _ts("2021-03-05 00:00:00", i, "hours").alias("order_delivered_customer_date"),
        _ts("2021-03-10 00:00:00", i, "hours").alias("order_estimated_delivery_date"),
    )
    items = spark.range(N_ITEMS).select(
        F.when(i % 3 == 0, F.lit(HOT_ORDER)).otherwise(i % N_ORDERS).cast("long").alias("order_id"),
        i.cast("int").alias("order_item_id"),
        (i % 20).alias("product_id"),
        (i % 11).alias("seller_id"),
        _ts("2021-04-01 00:00:00", i).alias("shipping_limit_date"),
        ((i * 7919) % 10007 / 100).alias("price"),
        ((i * 31) % 997 / 100).alias("freight_value"),
    )
    reviews = spark.range(N_REVIEWS).select(
        F.when(i % 3 == 0, F.lit("r-hot")).otherwise(F.concat(F.lit("r"), i.cast("string"))).alias("review_id"),
        (i % 250).alias("order_id"),
        (i % 5 + 1).cast("string").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        _ts("2021-05-01 00:00:00", i).alias("review_creation_date"),
        F.when(i % 13 == 0, F.lit(None)).otherwise(_ts("2021-06-01 00:00:00", (i * 7) % N_REVIEWS)).alias(
            "review_answer_timestamp"
        ),
    )
    p = F.col("id")
    products = spark.range(20).select(
        p.alias("product_id"),
        F.when(p == 3, F.lit(None)).otherwise(F.concat(F.lit("cat"), (p % 4).cast("string"))).alias(
            "product_category_name"
        ),
        *[F.lit(1).alias(c) for c in (
            "product_name_lenght", "product_description_lenght", "product_photos_qty",
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        )],
    )
    translation = spark.createDataFrame(
        [("cat0", "toys"), ("cat1", "books"), ("cat2", "garden")],
        "product_category_name string, product_category_name_english string",
    )
    return {
        "orders": orders,
        "order_items": items,
        "order_reviews": reviews,
        "products": products,
        "category_translation": translation,
    }


def _latest(df: pd.DataFrame, key: str, tie: list[str]) -> pd.DataFrame:
    """Newest answer first, NULL last, then ``tie`` ascending; first row per key."""
    d = df.assign(_null=df["review_answer_timestamp"].isna())
    d = d.sort_values(["_null", "review_answer_timestamp", *tie], ascending=[True, False, *[True] * len(tie)])
    return d.groupby(key, sort=False).head(1).drop(columns="_null")


@pytest.fixture(scope="module")
def expected_reviews(sources):
    r = sources["order_reviews"].toPandas()
    one_per_review = _latest(r, "review_id", ["order_id", "review_score"])
    return _latest(one_per_review, "order_id", ["review_id"])


def _half_up(x: float, places: int) -> float:
    q = 10**places
    return math.floor(x * q + 0.5) / q


def test_hot_review_id_dedupe_is_exact(spark, sources, expected_reviews):
    got = Lake(sources).model("silver_order_reviews").select("review_id", "order_id").toPandas()
    exp = expected_reviews[["review_id", "order_id"]]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, exp.values.tolist()))


def _category_scores(sources, expected_reviews):
    items = sources["order_items"].toPandas()[["order_id", "product_id"]]
    rev = expected_reviews[["order_id", "review_score"]].astype({"review_score": int})
    prod = sources["products"].toPandas()[["product_id", "product_category_name"]]
    tr = sources["category_translation"].toPandas()
    j = items.merge(rev, on="order_id").merge(prod, on="product_id").merge(tr, on="product_category_name", how="left")
    j["category"] = j["product_category_name_english"].astype(object).where(j["product_category_name_english"].notna(), None)
    grouped = j.groupby(j["category"].fillna("<null>"), sort=False)
    expected = {
        (None if c == "<null>" else c): (_half_up(g["review_score"].sum() / len(g), 2), len(g)) for c, g in grouped
    }
    return expected


def test_review_kpi_with_hot_order_matches_brute_force(spark, sources, expected_reviews):
    got = kpis.review_by_category(Lake(sources)).collect()
    assert {r["category"]: (r["avg_review_score"], r["review_item_rows"]) for r in got} == _category_scores(
        sources, expected_reviews
    )


def _categories(sources):
    named = Lake(sources).model("dim_product")
    return named.select("product_id", F.col("product_category_name_english").alias("c")).collect()


def test_review_kpi_with_many_hot_orders(spark, sources, expected_reviews):
    """More than 10,000 orders of 30 items each: no cap on the number of large orders."""
    n = 12_000
    k = F.col("id")
    many = {
        **sources,
        "orders": spark.range(n).select(
            k.alias("order_id"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in sources["orders"].schema if f.name != "order_id"],
        ),
        "order_items": spark.range(n * 30).select(
            (k % n).alias("order_id"),
            (k / n).cast("int").alias("order_item_id"),
            (k % 20).alias("product_id"),
            F.lit(1).cast("long").alias("seller_id"),
            F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
            F.lit(1.0).alias("price"),
            F.lit(1.0).alias("freight_value"),
        ),
    }
    reviews = expected_reviews[["order_id", "review_score"]]
    score = {int(o): int(s) for o, s in reviews.values.tolist()}
    category = {r["product_id"]: r["c"] for r in _categories(sources)}
    sums: dict = {}
    for order in score:
        for j in range(30):
            c = category[(order + j * n) % 20]
            s, m = sums.get(c, (0, 0))
            sums[c] = (s + score[order], m + 1)
    got = kpis.review_by_category(Lake(many)).collect()
    assert {r["category"]: (r["avg_review_score"], r["review_item_rows"]) for r in got} == {
        c: (_half_up(s / m, 2), m) for c, (s, m) in sums.items()
    }


def test_review_kpi_counts_repeated_orders_as_the_facts_do(spark, sources):
    twice = {**sources, "orders": sources["orders"].union(sources["orders"].where("order_id < 5"))}
    lazy = Lake(twice)
    facts = {t: lazy.model(t) for t in ("fact_sales", "fact_reviews", "dim_product")}
    want = sorted(map(str, kpis.review_by_category(Lake({}, pinned=facts)).collect()))
    assert sorted(map(str, kpis.review_by_category(Lake(twice)).collect())) == want


def test_review_join_is_one_plan_without_jobs(spark, sources):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("define-reviews", "")
    try:
        df = kpis._review_scores_by_product(Lake(sources))
        assert tracker.getJobIdsForGroup("define-reviews") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "Union" not in plan and "SortMergeJoin" in plan or "HashJoin" in plan


def test_skewed_item_join_is_split_by_aqe(spark, sources):
    """fact_sales (items ⋈ orders) as a shuffle join: AQE splits the hot order's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session_conf(spark, settings):
        df = Lake(sources).model("fact_sales")
        assert df.count() == N_ITEMS
        rows = df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        got = {r["customer_id"]: r["n"] for r in rows.collect()}
        plan = rows._jdf.queryExecution().executedPlan().toString()
    assert sum(got.values()) == N_ITEMS
    assert "SortMergeJoin(skew=true)" in plan, plan
