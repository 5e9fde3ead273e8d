"""DuckDB SQL for every query key: an independent statement of each answer.

The driver registers the test tables as views in DuckDB; the adapter views,
models and KPIs are written here as CTEs in plain SQL, and each key's
statement pulls in exactly the CTEs it depends on.  KPIs are written in
their textbook join-then-aggregate shape, which cross-checks the
aggregate-before-join plans of ``strata.plans.kpis``.

Dialect notes: DuckDB's ``year``/``month``/``quarter``/``length`` are
BIGINT and integer ``sum`` is HUGEINT, so they are cast to the Spark
types; rounding of ratios is done in exact integer arithmetic on both
sides (see ``strata.functions.measures.rounded_ratio``).
"""

from __future__ import annotations

import re

from strata.plans.medallion import MODELS, STAR_TABLES
from strata.plans.models import GOLD_COLUMNS
from strata.plans.quality import DATA_TESTS, DUPLICATE_CHECKS, NULL_CHECKS, TABLE_NOTES
from strata.sources.catalog import RAW_DATABASE, STAR_DATABASE
from strata.sources.fixtures import RAW_TABLES
from strata.sources.schemas import LANDING_FILES, RETAIL_SCHEMAS


def money(expr: str) -> str:
    return f"cast(round(sum(cast({expr} as decimal(18,2))), 2) as double)"


def rounded_ratio(num: str, den: str, scale: int) -> str:
    """round(num/den, scale) half away from zero, exact for integers; NULL if den = 0."""
    d = f"nullif(cast({den} as hugeint), 0)"
    q = f"((abs(cast({num} as hugeint)) * {2 * 10**scale} + {d}) // (2 * {d}))"
    return f"(cast(sign({num}) * {q} as double) / cast({10**scale} as double))"


def delivery_cents(start: str, end: str) -> str:
    """Hundredths of a day from start to end, rounded half away from zero."""
    x = f"(cast(epoch({end}) as bigint) - cast(epoch({start}) as bigint))"
    return f"(sign({x}) * ((abs({x}) * 100 + 43200) // 86400))"


PURCHASE_TS = "o_orderdate + to_seconds((o_orderkey * 37) % 86400)"

# name → SQL body; dependencies are found by name.
CTES: dict[str, str] = {}

CTES["f_customers"] = """
select c_custkey customer_id,
       concat(c_mktsegment, '-', cast(c_nationkey as varchar)) customer_unique_id,
       c_nationkey customer_zip_code_prefix, c_mktsegment customer_city, n_name customer_state
from customer join nation on c_nationkey = n_nationkey"""

CTES["f_sellers"] = """
select s_suppkey seller_id, s_nationkey seller_zip_code_prefix, r_name seller_city, n_name seller_state
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

CTES["f_products"] = """
select p_partkey product_id,
       case when p_type = 'ECONOMY' then null else p_brand end product_category_name,
       cast(length(p_name) as integer) product_name_lenght,
       cast(length(p_brand) as integer) product_description_lenght,
       p_size % 5 product_photos_qty, p_size * 10 product_weight_g, p_size product_length_cm,
       p_size + 1 product_height_cm, p_size + 2 product_width_cm
from part"""

CTES["f_category_translation"] = """
select distinct p_brand product_category_name, lower(p_brand) product_category_name_english
from part where p_brand not in ('Brand#1', 'Brand#2')"""

CTES["f_geolocation"] = """
select c_nationkey geolocation_zip_code_prefix, cast(c_nationkey as double) / 2 geolocation_lat,
       cast(c_nationkey as double) / 4 geolocation_lng, c_mktsegment geolocation_city,
       n_name geolocation_state
from customer join nation on c_nationkey = n_nationkey"""

CTES["f_order_items"] = """
select l_orderkey order_id, l_linenumber order_item_id, l_partkey product_id, l_suppkey seller_id,
       l_shipdate shipping_limit_date, l_extendedprice price, l_quantity freight_value
from lineitem"""

CTES["f_order_payments"] = """
select l_orderkey order_id, l_linenumber payment_sequential,
       case l_returnflag when 'R' then 'credit_card' when 'A' then 'boleto' else 'voucher' end payment_type,
       cast(l_quantity as integer) payment_installments, l_extendedprice payment_value
from lineitem"""

CTES["f_order_reviews"] = """
select concat(cast(l_partkey as varchar), '-', cast(l_suppkey as varchar)) review_id,
       l_orderkey order_id, 1 + cast(l_quantity as integer) % 5 review_score,
       case when l_tax > 0.06 then l_returnflag end review_comment_title,
       case when l_discount > 0.05 then concat(l_returnflag, l_linestatus) end review_comment_message,
       l_shipdate review_creation_date,
       case when l_linenumber = 7 then null else l_shipdate end review_answer_timestamp,
       l_linenumber ln, l_extendedprice px
from lineitem"""

CTES["f_orders"] = f"""
select o_orderkey order_id, o_custkey customer_id,
       case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end order_status,
       {PURCHASE_TS} order_purchase_timestamp,
       case when o_orderkey % 500 = 0 then null else {PURCHASE_TS} end order_approved_at,
       d0 order_delivered_carrier_date, d1 order_delivered_customer_date,
       o_orderdate + interval 30 days order_estimated_delivery_date
from orders left join (
  select l_orderkey, min(l_shipdate) d0, max(l_shipdate) d1 from lineitem group by l_orderkey
) x on l_orderkey = o_orderkey"""

for _t in RAW_TABLES:
    CTES[f"bronze_{_t}"] = f"select * from f_{_t}"

CTES["silver_customers"] = """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
from bronze_customers"""

CTES["silver_sellers"] = """
select seller_id, seller_zip_code_prefix, seller_city, seller_state from bronze_sellers"""

CTES["silver_orders"] = f"""
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
       cast(order_purchase_timestamp as date) purchase_date,
       cast(strftime(cast(order_purchase_timestamp as date), '%Y%m%d') as integer) date_key,
       case when order_delivered_customer_date is not null and order_purchase_timestamp is not null
            then cast({delivery_cents('order_purchase_timestamp', 'order_delivered_customer_date')}
                      as double) / 100.0::double end delivery_days
from bronze_orders"""

CTES["silver_order_items"] = """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       cast(price as double) price, cast(freight_value as double) freight_value,
       cast(price as double) + cast(freight_value as double) revenue
from bronze_order_items"""

CTES["silver_order_payments"] = """
select order_id, payment_sequential, payment_type,
       cast(payment_installments as integer) payment_installments,
       cast(payment_value as double) payment_value
from bronze_order_payments"""

REVIEW_DEDUPED = """(
  select * from bronze_order_reviews
  qualify row_number() over (
    partition by review_id
    order by review_answer_timestamp desc nulls last, order_id asc nulls first,
             ln asc nulls first, px asc nulls first) = 1
)"""

CTES["silver_order_reviews"] = f"""
select review_id, order_id, cast(review_score as integer) review_score, review_comment_title,
       review_comment_message, review_creation_date, review_answer_timestamp
from {REVIEW_DEDUPED} r1
qualify row_number() over (
  partition by order_id order by review_answer_timestamp desc nulls last, review_id asc nulls first) = 1"""

CTES["silver_products"] = """
select p.product_id, p.product_category_name, c.product_category_name_english,
       p.product_name_lenght, p.product_description_lenght, p.product_photos_qty,
       p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm
from bronze_products p
left join bronze_category_translation c on p.product_category_name = c.product_category_name"""

CTES["silver_geolocation"] = """
select distinct geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
       geolocation_city, geolocation_state
from bronze_geolocation"""

CTES["dim_customer"] = "select * from silver_customers"
CTES["dim_seller"] = "select * from silver_sellers"
CTES["dim_geolocation"] = "select * from silver_geolocation"

CTES["dim_product"] = """
select product_id, product_category_name, product_category_name_english, product_weight_g,
       product_length_cm, product_height_cm, product_width_cm
from silver_products"""

CTES["dim_date"] = """
select distinct date_key, purchase_date as date, cast(year(purchase_date) as integer) as year,
       cast(month(purchase_date) as integer) as month, monthname(purchase_date) as month_name,
       cast(quarter(purchase_date) as integer) as quarter
from silver_orders where purchase_date is not null"""

CTES["fact_orders"] = """
select order_id, customer_id, order_status, date_key, purchase_date, order_purchase_timestamp,
       order_delivered_customer_date, order_estimated_delivery_date, delivery_days
from silver_orders"""

CTES["fact_sales"] = """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id, o.date_key,
       o.purchase_date, i.price, i.freight_value, i.revenue
from silver_order_items i join silver_orders o on i.order_id = o.order_id"""

CTES["fact_payments"] = """
select p.order_id, p.payment_sequential, o.date_key, o.purchase_date, p.payment_type,
       p.payment_installments, p.payment_value
from silver_order_payments p join silver_orders o on p.order_id = o.order_id"""

CTES["fact_reviews"] = """
select r.review_id, r.order_id, o.date_key, o.purchase_date, r.review_score, r.review_creation_date
from silver_order_reviews r left join silver_orders o on r.order_id = o.order_id"""

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(sql)) if n in CTES]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) uses, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep)
        ordered.append(name)

    if body.strip().startswith("with "):
        body = f"select * from ({body.strip()}) own"
    for name in _deps(body):
        visit(name)
    if not ordered:
        return body.strip()
    clauses = ",\n".join(f"{n} as ({CTES[n].strip()})" for n in ordered)
    return f"with {clauses}\n{body.strip()}"


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


# ------------------------------------------------------------- statements

BODIES: dict[str, str] = {}

for _name in CTES:
    if not _name.startswith("f_"):
        BODIES[_name] = f"select * from {_name}"

BODIES["latest_review_per_order"] = "select * from silver_order_reviews"

BODIES["ingest_csv"] = "select * from f_order_reviews"
BODIES["ingest_registry"] = _union(
    [
        f"select '{f.table}' table_name, '{f.file_name}' file_name, count(*) row_count, "
        f"cast(0 as bigint) malformed_cells from f_{f.table}"
        for f in LANDING_FILES
    ]
)

_SQL_TYPES = {"string": "varchar", "int": "integer", "double": "double", "timestamp_ntz": "timestamp"}
for _t, _schema in RETAIL_SCHEMAS.items():
    _cells = ", ".join(f"cast({c.name} as {_SQL_TYPES[c.dataType.simpleString()]}) {c.name}" for c in _schema)
    BODIES[f"ingest_{_t}"] = f"select {_cells} from f_{_t}"

# columns of the written tables, for their digests
_RAW_COLUMNS = {t: tuple(schema.names) for t, schema in RETAIL_SCHEMAS.items()}
_RAW_COLUMNS["order_reviews"] += ("ln", "px")
_RETAIL = {t: tuple(schema.names) for t, schema in RETAIL_SCHEMAS.items()}
COLUMNS: dict[str, tuple[str, ...]] = {
    **{f"f_{t}": c for t, c in _RAW_COLUMNS.items()},
    **{f"bronze_{t}": c for t, c in _RAW_COLUMNS.items()},
    **{f"silver_{t}": _RETAIL[t] for t in ("customers", "sellers", "geolocation", "order_payments", "order_reviews")},
    "silver_orders": (*_RETAIL["orders"], "purchase_date", "date_key", "delivery_days"),
    "silver_order_items": (*_RETAIL["order_items"], "revenue"),
    "silver_products": (*_RETAIL["products"], "product_category_name_english"),
    "dim_customer": _RETAIL["customers"],
    "dim_seller": _RETAIL["sellers"],
    "dim_geolocation": _RETAIL["geolocation"],
    "dim_date": ("date_key", "date", "year", "month", "month_name", "quarter"),
    **GOLD_COLUMNS,
}
FRACTIONS = {"price", "freight_value", "revenue", "payment_value", "delivery_days", "geolocation_lat", "geolocation_lng", "px"}


def digest(table: str) -> str:
    """``row_count, digest``: the sum over rows of the first 12 hex digits of the row text's MD5."""
    texts = [
        f"coalesce(cast({f'cast({c} as decimal(28,8))' if c in FRACTIONS else c} as varchar), '~')"
        for c in sorted(COLUMNS[table])
    ]
    row = f"('0x' || substr(md5(concat_ws('|', {', '.join(texts)})), 1, 12))::hugeint"
    return f"count(*) row_count, cast(coalesce(sum({row}), 0) as varchar) digest"


BODIES["catalog_scan"] = "select * from f_orders"
BODIES["preview_orders"] = "select * from f_orders order by order_id limit 1000"

_STAR = STAR_TABLES
BODIES["catalog_sources"] = _union(
    [f"select '{RAW_DATABASE}' database_name, '{t}' table_name, {digest(f'f_{t}')} from f_{t}" for t in RAW_TABLES]
)
BODIES["catalog_register"] = _union(
    [BODIES["catalog_sources"]]
    + [f"select '{STAR_DATABASE}' database_name, '{t}' table_name, {digest(t)} from {t}" for t in _STAR]
)
_listed = [(RAW_DATABASE, t) for t in RAW_TABLES] + [(STAR_DATABASE, t) for t in _STAR]
BODIES["catalog_list"] = (
    'select * from (values '
    + ", ".join(f"('{db}', '{t}', false)" for db, t in _listed)
    + ') t(namespace, "tableName", "isTemporary")'
)
BODIES["star_roundtrip"] = _union(
    [f"select '{t}' table_name, {digest(t)} from {t}" for t in _STAR]
)


def _model_rows(layer_filter: str | None) -> str:
    return _union(
        [
            f"select '{m.layer}' layer, '{m.name}' model, '{m.alias}' table_name, {digest(m.name)} "
            f"from {m.name}"
            for m in MODELS
            if layer_filter is None or m.layer == layer_filter
        ]
    )


BODIES["medallion_build"] = _model_rows(None)
BODIES["medallion_layer"] = _model_rows("silver")

# --------------------------------------------------------------- KPIs

BODIES["kpi_monthly_revenue"] = f"""
with dated as (
  select date_key, revenue from fact_sales where date_key in (select date_key from dim_date)
)
select (date_key // 10000)::integer as year, (date_key // 100 % 100)::integer as month,
       {money('revenue')} monthly_revenue
from dated group by all"""

BODIES["kpi_revenue_by_category"] = f"""
with named as (
  select product_category_name_english category, revenue
  from dim_product inner join fact_sales using (product_id)
)
select category, {money('revenue')} revenue from named group by category"""

BODIES["kpi_top_sellers"] = f"""
with ranked as (
  select seller_id, seller_city, seller_state, {money('revenue')} revenue
  from dim_seller inner join fact_sales using (seller_id)
  group by all
)
select * from ranked
qualify row_number() over (order by revenue desc, seller_id, seller_city) <= 20"""

BODIES["kpi_sales_by_state"] = f"""
with placed as (
  select customer_state, revenue from dim_customer inner join fact_sales using (customer_id)
)
select customer_state, {money('revenue')} revenue from placed group by customer_state"""

BODIES["kpi_delivery_by_state"] = f"""
with delivered as (
  select customer_id, cast(round(delivery_days * 100) as bigint) cents
  from fact_orders where order_status = 'delivered' and delivery_days is not null
), summed as (
  select customer_state, sum(cents) cents, count(*) n
  from dim_customer inner join delivered using (customer_id) group by customer_state
)
select customer_state, {rounded_ratio('cents', 'n * 100', 2)} avg_delivery_days, n delivered_orders
from summed"""

_SECS = "(cast(epoch(o.order_delivered_customer_date) as bigint) - cast(epoch(o.order_purchase_timestamp) as bigint))"
BODIES["kpi_delivery_unrounded"] = f"""
select c.customer_state, {rounded_ratio(f'sum({_SECS})', 'count(*) * 86400', 6)} avg_delivery_days
from fact_orders o left join dim_customer c on o.customer_id = c.customer_id
where o.order_status = 'delivered' and o.delivery_days is not null and c.customer_state is not null
group by c.customer_state"""

BODIES["kpi_payment_trends"] = f"""
with dated as (
  select date_key, payment_type, payment_value
  from fact_payments where date_key in (select date_key from dim_date)
)
select (date_key // 10000)::integer as year, (date_key // 100 % 100)::integer as month, payment_type,
       {money('payment_value')} payment_value
from dated group by all"""

BODIES["kpi_review_by_category"] = f"""
with reviewed as (
  select product_id, review_score from fact_sales inner join fact_reviews using (order_id)
), summed as (
  select product_category_name_english category, sum(review_score) s, count(review_score) scored, count(*) n
  from reviewed inner join dim_product using (product_id) group by 1
)
select category, {rounded_ratio('s', 'scored', 2)} avg_review_score, n review_item_rows from summed"""

_PERIOD = "strftime(purchase_date, '%Y-%m')"
BODIES["kpi_monthly_revenue_period"] = f"""
select {_PERIOD} purchase_month, {money('revenue')} revenue
from fact_sales where purchase_date is not null group by 1"""

BODIES["kpi_total_revenue"] = f"""
select {money('revenue')} total_revenue from fact_sales"""

BODIES["report_monthly_revenue"] = f"""
select {_PERIOD} label, format('{{:,.2f}}', round(sum(cast(revenue as decimal(18,2))), 2)) revenue_brl
from fact_sales where purchase_date is not null group by 1
union all
select 'Total revenue' label, format('{{:,.2f}}', round(sum(cast(revenue as decimal(18,2))), 2)) revenue_brl
from fact_sales"""

BODIES["kpi_category_top10"] = f"""
select coalesce(nullif(category, ''), '(missing)') category, revenue from (
  select p.product_category_name_english category, {money('f.revenue')} revenue
  from fact_sales f left join dim_product p on f.product_id = p.product_id
  where p.product_category_name_english is not null
  group by 1 order by revenue desc, category limit 10
) t"""

BODIES["kpi_sellers_top10"] = f"""
select t.seller_id, concat(substring(cast(t.seller_id as varchar), 1, 8), '…') seller_label,
       s.seller_city, s.seller_state, t.revenue
from (
  select seller_id, {money('revenue')} revenue from fact_sales where seller_id is not null
  group by seller_id order by revenue desc, seller_id limit 10
) t left join dim_seller s on t.seller_id = s.seller_id"""

BODIES["kpi_state_left"] = f"""
select c.customer_state, {money('f.revenue')} revenue
from fact_sales f left join dim_customer c on f.customer_id = c.customer_id
where c.customer_state is not null group by c.customer_state"""

BODIES["kpi_payment_totals"] = f"""
select payment_type, {money('payment_value')} payment_value from fact_payments
where payment_type is not null group by payment_type"""

_PAY_MONTHLY = f"""(
  select {_PERIOD} purchase_month, payment_type, {money('payment_value')} payment_value
  from fact_payments where purchase_date is not null and payment_type is not null group by 1, 2
)"""
BODIES["kpi_payment_recent_months"] = f"""
select * from {_PAY_MONTHLY} pay
where purchase_month in (
  select purchase_month from (select distinct purchase_month from {_PAY_MONTHLY} m)
  order by purchase_month desc limit 6)"""

BODIES["kpi_review_top15"] = f"""
select coalesce(nullif(category, ''), '(missing)') category,
       {rounded_ratio('s', 'scored', 2)} avg_review_score
from (
  select p.product_category_name_english category, sum(r.review_score) s, count(r.review_score) scored
  from fact_reviews r join fact_sales f on r.order_id = f.order_id
  left join dim_product p on f.product_id = p.product_id
  where p.product_category_name_english is not null
  group by 1
  order by case when count(r.review_score) > 0
                then cast(sum(r.review_score) as double) / cast(count(r.review_score) as double) end
           desc nulls last, category
  limit 15
) t"""

# --------------------------------------------------------------- charts

BODIES["chart_monthly_orders"] = """
select strftime(order_purchase_timestamp, '%Y-%m') as month, count(order_id) as orders
from bronze_orders group by 1"""

BODIES["chart_payment_types"] = f"""
select payment_type, {money('payment_value')} total_value, count(*) payments
from bronze_order_payments group by payment_type"""

BODIES["chart_customers_by_state"] = """
select customer_state, count(customer_id) customers from bronze_customers group by customer_state"""

BODIES["chart_avg_review"] = """
select cast(sum(review_score) as double) / count(review_score) avg_review_score,
       count(review_score) reviews
from bronze_order_reviews"""

BODIES["chart_top_categories"] = """
select p.product_category_name, count(*) items
from bronze_order_items i join bronze_products p on i.product_id = p.product_id
group by p.product_category_name"""

# --------------------------------------------------------------- quality

BODIES["dq_table_inventory"] = _union(
    [
        f"select '{t}' table_name, count(*) row_count, '{note}' notes from bronze_{t}"
        for t, note in TABLE_NOTES
    ]
)

BODIES["dq_duplicate_keys"] = _union(
    [
        f"select '{t}' table_name, '{label}' key_name, "
        f"count(*) - count(distinct row({', '.join(cols)})) duplicates, '{action}' action "
        f"from bronze_{t}"
        for t, cols, label, action in DUPLICATE_CHECKS
    ]
)

BODIES["dq_dedupe_effect"] = """
select 'geolocation' table_name, 'full-row' rule, count(*) rows_before,
       count(distinct row(geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
                          geolocation_city, geolocation_state)) rows_after
from bronze_geolocation
union all
select 'order_reviews' table_name, 'review_id' rule, count(*) rows_before,
       count(distinct row(review_id)) rows_after
from bronze_order_reviews"""

BODIES["dq_null_profile"] = _union(
    [
        f"select '{t}' table_name, '{c}' column_name, count(*) filter (where {c} is null) nulls, "
        f"{rounded_ratio(f'count(*) filter (where {c} is null) * 100', 'count(*)', 1)} pct, "
        f"format('{{:.1f}}%', {rounded_ratio(f'count(*) filter (where {c} is null) * 100', 'count(*)', 1)}) pct_text "
        f"from bronze_{t}"
        for t, cols in NULL_CHECKS
        for c in cols
    ]
)


def _unique_sql(model: str, column: str) -> str:
    return (
        f"select 'unique' test_name, '{model}' model, '{column}' column_name, count(*) failures, "
        f"case when count(*) = 0 then 'pass' else 'fail' end status "
        f"from (select {column} from {model} where {column} is not null "
        f"group by {column} having count(*) > 1) t"
    )


def _not_null_sql(model: str, column: str) -> str:
    n = f"count(*) filter (where {column} is null)"
    return (
        f"select 'not_null' test_name, '{model}' model, '{column}' column_name, {n} failures, "
        f"case when {n} = 0 then 'pass' else 'fail' end status from {model}"
    )


BODIES["test_unique"] = _union([_unique_sql(m, c) for m, c, tests in DATA_TESTS if "unique" in tests])
BODIES["test_not_null"] = _union(
    [_not_null_sql(m, c) for m, c, tests in DATA_TESTS if "not_null" in tests]
)
BODIES["test_summary"] = BODIES["test_unique"] + "\nunion all\n" + BODIES["test_not_null"]


for _k in ("monthly_revenue", "revenue_by_category", "top_sellers", "sales_by_state", "delivery_by_state", "payment_trends", "review_by_category"):
    BODIES[f"catalog_kpi_{_k}"] = BODIES[f"kpi_{_k}"]
BODIES["sink_report_monthly_revenue"] = BODIES["report_monthly_revenue"]
BODIES["sink_dq_null_profile"] = BODIES["dq_null_profile"]


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
