"""The whole lake on hand-written landing CSVs shaped like the original
dataset (string ids, text timestamps, a quoted multi-line comment)."""

from __future__ import annotations

from pathlib import Path

import pytest

from strata.plans import jobs, kpis, quality
from strata.plans.medallion import Lake
from strata.sources.schemas import LANDING_FILES

# landing file contents by table; file names come from the landing registry
FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00
o2,c2,delivered,2017-11-20 08:00:00,2017-11-20 09:00:00,2017-11-21 10:00:00,2017-11-25 08:00:00,2017-12-01 00:00:00
o3,c1,shipped,2017-11-21 12:00:00,,,,2017-12-05 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72
o2,1,p2,s2,2017-11-22 09:00:00,100.00,10.00
o2,2,p1,s1,2017-11-22 09:00:00,29.99,8.72
o3,1,p3,s2,2017-11-23 12:00:00,15.50,4.50
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,1,38.71
o2,1,boleto,1,148.71
o3,1,voucher,1,20.00
""",
    "order_reviews": '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,4,,"Chegou antes
do prazo, ""otimo""",2017-10-11 00:00:00,2017-10-12 03:43:48
r2,o2,5,,,2017-11-26 00:00:00,2017-11-27 10:00:00
r2,o2,5,,,2017-11-26 00:00:00,2017-11-28 10:00:00
r3,o2,1,,,2017-11-26 00:00:00,
''',
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01037,sao paulo,SP
c2,u2,20040,rio de janeiro,RJ
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,13023,campinas,SP
s2,04195,sao paulo,SP
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,perfumaria,40,287,1,225,16,10,14
p2,cama_mesa_banho,44,276,1,1000,30,18,20
p3,,,,,,,,
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01037,-23.54562128115268,-46.63929204800168,sao paulo,SP
01037,-23.54562128115268,-46.63929204800168,sao paulo,SP
20040,-22.9,-43.17,rio de janeiro,RJ
""",
    "category_translation": """product_category_name,product_category_name_english
perfumaria,perfumery
cama_mesa_banho,bed_bath_table
""",
}


@pytest.fixture(scope="module")
def built(spark):
    from strata.session import run_dir

    root = run_dir(spark, "e2e")
    landing = Path(root[len("file:"):] if root.startswith("file:") else root) / "landing"
    landing.mkdir(parents=True)
    for f in LANDING_FILES:
        (landing / f.file_name).write_text(FILES[f.table])
    inventory = {r.model: r.row_count for r in jobs.run_from_landing(spark, f"{root}/landing", root).collect()}
    return inventory, Lake.from_catalog(spark)


def test_inventory(built):
    inventory, _ = built
    assert len(inventory) == 26
    assert inventory["bronze_order_reviews"] == 4          # the quoted newline stays one record
    assert inventory["silver_order_reviews"] == 2          # r2 deduped, then one review per order
    assert inventory["silver_geolocation"] == 2
    assert inventory["fact_sales"] == 4
    assert inventory["dim_date"] == 3


def test_kpis(built):
    _, lake = built
    monthly = {(r.year, r.month): r.monthly_revenue for r in kpis.monthly_revenue(lake).collect()}
    assert monthly == {(2017, 10): 38.71, (2017, 11): 168.71}
    assert kpis.total_revenue(lake).first().total_revenue == 207.42
    states = {r.customer_state: r.revenue for r in kpis.sales_by_state(lake).collect()}
    assert states == {"SP": 58.71, "RJ": 148.71}
    delivery = {r.customer_state: r.avg_delivery_days for r in kpis.delivery_by_state(lake).collect()}
    assert delivery == {"SP": 8.44, "RJ": 5.0}
    cats = {r.category: r.revenue for r in kpis.revenue_by_category(lake).collect()}
    assert cats == {"perfumery": 77.42, "bed_bath_table": 110.0, None: 20.0}
    reviews = {r.category: (r.avg_review_score, r.review_item_rows) for r in kpis.review_by_category(lake).collect()}
    assert reviews == {"perfumery": (4.5, 2), "bed_bath_table": (5.0, 1)}


def test_zip_and_tests(built):
    _, lake = built
    zips = {r.customer_id: r.customer_zip_code_prefix for r in lake.model("dim_customer").collect()}
    assert zips == {"c1": "01037", "c2": "20040"}
    results = {(r.test_name, r.model, r.column_name): r.status for r in quality.test_summary(lake).collect()}
    assert len(results) == 10 and set(results.values()) == {"pass"}
