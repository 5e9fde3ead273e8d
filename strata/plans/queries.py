"""Registry of every query: name → ``fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver's test tables of ``sf_dir`` through the adapter
views (``strata.sources.fixtures``) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import charts, jobs, kpis, medallion, quality
from strata.plans.medallion import Lake
from strata.session import sized_session, stored_bytes, tidy_session
from strata.sources import catalog, csv
from strata.sources.fixtures import DRIVER_TABLES, RAW_TABLES, RawTables, raw_tables
from strata.sources.schemas import RETAIL_SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]


def sized(spark: SparkSession, sf_dir: str) -> SparkSession:
    """The session whose shuffles fit the tables of ``sf_dir``."""
    return sized_session(spark, stored_bytes(spark, [f"{sf_dir}/{t}.parquet" for t in DRIVER_TABLES]))


def _raw(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, RawTables]:
    spark = sized(spark, sf_dir)
    return spark, raw_tables(spark, sf_dir)


def _tidy_raw(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, RawTables]:
    spark = tidy_session(sized(spark, sf_dir))
    return spark, raw_tables(spark, sf_dir)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(_raw(spark, sf_dir)[1])


def _on_lake(fn: Callable[[Lake], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lake(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lake(spark, sf_dir).model(name)

    run.__name__ = name
    return run


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The free-text review table through CSV landing → typed read → Parquet → read."""
    spark, raw = _raw(spark, sf_dir)
    raw_dir, _ = jobs.ingest_tables(spark, raw, ("order_reviews",))
    return csv.raw_table(spark, raw_dir, "order_reviews", raw["order_reviews"].schema)


def _ingest(table: str) -> Query:
    """One table through CSV landing and the declared retail schema, whole."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark, raw = _raw(spark, sf_dir)
        raw_dir, _ = jobs.ingest_tables(spark, raw, (table,), RETAIL_SCHEMAS)
        return csv.raw_table(spark, raw_dir, table, RETAIL_SCHEMAS[table])

    run.__name__ = f"ingest_{table}"
    return run


def ingest_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine landing files ingested; rows and malformed cells per loaded table."""
    _, registry = jobs.ingest_tables(*_raw(spark, sf_dir), schemas=RETAIL_SCHEMAS)
    return registry


# One written and registered lake per session and folder, shared by the catalog keys.
_REGISTERED: dict[tuple[str, str], jobs.Registration] = {}


def registered(spark: SparkSession, sf_dir: str) -> jobs.Registration:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REGISTERED:
        _REGISTERED[key] = jobs.register_lake(*_raw(spark, sf_dir))
    return _REGISTERED[key]


def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written folders registered (again); content of every table, read through the catalog."""
    done = registered(spark, sf_dir)
    done.register(spark)
    return catalog.table_digests(spark, done.raw_database, RAW_TABLES).unionByName(
        catalog.table_digests(spark, done.star_database, medallion.STAR_TABLES)
    )


def catalog_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = registered(spark, sf_dir)
    return catalog.list_tables(spark, [done.raw_database, done.star_database])


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.source(spark, "orders", registered(spark, sf_dir).raw_database)


def catalog_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content of the nine declared sources, read through the catalog."""
    return catalog.table_digests(spark, registered(spark, sf_dir).raw_database, RAW_TABLES)


def _on_catalog(name: str, fn: Callable[[Lake], DataFrame]) -> Query:
    """A business question over the registered star tables, as production asks it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = registered(spark, sf_dir).star_database
        return fn(Lake.from_catalog(sized(spark, sf_dir), {"gold": star}, ("gold",)))

    run.__name__ = name
    return run


def _report_section(name: str, fn: Callable[[Lake], DataFrame]) -> Query:
    """A report section through the Parquet sink, read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(jobs.publish_reports(spark, {name: fn(lake(spark, sf_dir))})[name])

    run.__name__ = f"sink_{name}"
    return run


def medallion_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.medallion_build(*_tidy_raw(spark, sf_dir))


def medallion_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, then silver alone: the silver run reads bronze from the catalog."""
    return jobs.medallion_build(*_tidy_raw(spark, sf_dir), ("bronze", "silver"))


def star_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.star_roundtrip(*_raw(spark, sf_dir))


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 1000 raw orders by order_id (the limit is the feature)."""
    return lake(spark, sf_dir).model("bronze_orders").orderBy(F.asc("order_id")).limit(1000)


# The business questions in SQL form.
SQL_KPIS: dict[str, Callable[[Lake], DataFrame]] = {
    "monthly_revenue": kpis.monthly_revenue,
    "revenue_by_category": kpis.revenue_by_category,
    "top_sellers": kpis.top_sellers,
    "sales_by_state": kpis.sales_by_state,
    "delivery_by_state": kpis.delivery_by_state,
    "payment_trends": kpis.payment_trends,
    "review_by_category": kpis.review_by_category,
}

QUERIES: dict[str, Query] = {
    # sources / sinks / catalog
    "ingest_csv": ingest_csv,
    "ingest_registry": ingest_registry,
    "catalog_register": catalog_register,
    "catalog_list": catalog_list,
    "catalog_scan": catalog_scan,
    "catalog_sources": catalog_sources,
    **{f"ingest_{t}": _ingest(t) for t in RAW_TABLES},
    **{f"catalog_kpi_{k}": _on_catalog(f"catalog_kpi_{k}", fn) for k, fn in SQL_KPIS.items()},
    "sink_report_monthly_revenue": _report_section("report_monthly_revenue", kpis.report_monthly_revenue),
    "sink_dq_null_profile": _report_section("dq_null_profile", quality.null_profile),
    "preview_orders": preview_orders,
    "star_roundtrip": star_roundtrip,
    "medallion_build": medallion_build,
    "medallion_layer": medallion_layer,
    # models
    **{spec.name: _model(spec.name) for spec in medallion.MODELS},
    "latest_review_per_order": _on_lake(kpis.latest_review_per_order),
    # KPIs
    "kpi_monthly_revenue": _on_lake(kpis.monthly_revenue),
    "kpi_monthly_revenue_period": _on_lake(kpis.monthly_revenue_period),
    "kpi_total_revenue": _on_lake(kpis.total_revenue),
    "kpi_revenue_by_category": _on_lake(kpis.revenue_by_category),
    "kpi_category_top10": _on_lake(kpis.category_top10),
    "kpi_top_sellers": _on_lake(kpis.top_sellers),
    "kpi_sellers_top10": _on_lake(kpis.sellers_top10),
    "kpi_sales_by_state": _on_lake(kpis.sales_by_state),
    "kpi_state_left": _on_lake(kpis.state_left),
    "kpi_delivery_by_state": _on_lake(kpis.delivery_by_state),
    "kpi_delivery_unrounded": _on_lake(kpis.delivery_unrounded),
    "kpi_payment_trends": _on_lake(kpis.payment_trends),
    "kpi_payment_totals": _on_lake(kpis.payment_totals),
    "kpi_payment_recent_months": _on_lake(kpis.payment_recent_months),
    "kpi_review_by_category": _on_lake(kpis.review_by_category),
    "kpi_review_top15": _on_lake(kpis.review_top15),
    "report_monthly_revenue": _on_lake(kpis.report_monthly_revenue),
    # charts
    "chart_monthly_orders": _on_lake(charts.monthly_orders),
    "chart_payment_types": _on_lake(charts.payment_types),
    "chart_customers_by_state": _on_lake(charts.customers_by_state),
    "chart_avg_review": _on_lake(charts.avg_review),
    "chart_top_categories": _on_lake(charts.top_categories),
    # quality
    "dq_table_inventory": _on_lake(quality.table_inventory),
    "dq_duplicate_keys": _on_lake(quality.duplicate_keys),
    "dq_dedupe_effect": _on_lake(quality.dedupe_effect),
    "dq_null_profile": _on_lake(quality.null_profile),
    "test_unique": _on_lake(quality.test_unique),
    "test_not_null": _on_lake(quality.test_not_null),
    "test_summary": _on_lake(quality.test_summary),
}
