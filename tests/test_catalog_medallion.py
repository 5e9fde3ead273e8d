"""Catalog registration, the layered build and the star round trip."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs, medallion
from strata.sources import catalog, lake
from strata.sources.fixtures import RAW_TABLES, raw_tables


def test_registration_sql_is_idempotent_text():
    stmts = catalog.registration_sql("db1", {"t": "file:/x/t"})
    assert stmts == [
        "CREATE DATABASE IF NOT EXISTS db1",
        "DROP TABLE IF EXISTS db1.t",
        "CREATE TABLE db1.t USING PARQUET LOCATION 'file:/x/t'",
    ]
    assert catalog.registration_sql("d", {"t": "/it's"})[2].endswith("LOCATION '/it\\'s'")


def test_register_twice_and_drop_keeps_files(spark, scratch):
    df = spark.range(5).withColumnRenamed("id", "x")
    locs = lake.write_tables({"nums": df}, scratch)
    catalog.register(spark, "strata_test_db", locs)
    catalog.register(spark, "strata_test_db", locs)  # second run replaces, no error
    assert spark.table("strata_test_db.nums").count() == 5
    spark.sql("DROP TABLE strata_test_db.nums")
    assert spark.read.parquet(locs["nums"]).count() == 5


def test_models_are_in_dependency_order():
    seen = set()
    for spec in medallion.MODELS:
        for ref in spec.inputs:
            if not ref.startswith(medallion.SOURCE):
                assert ref in seen, (spec.name, ref)
        seen.add(spec.name)
    assert len(medallion.MODELS) == 26
    assert {m.layer for m in medallion.MODELS} == set(medallion.LAYERS)


def test_layer_build_reads_upstream_from_catalog(spark, sf_dir):
    root = jobs.run_dir(spark, "t")
    own = medallion.run_databases("layers")
    inv = medallion.build(spark, raw_tables(spark, sf_dir), root, layer="bronze", databases=own)
    assert inv.count() == 9
    # no sources at all: every silver input must come from the bronze tables
    silver = medallion.build(spark, {}, root, layer="silver", databases=own)
    rows = {r.model: r.row_count for r in silver.collect()}
    assert set(rows) == {m.name for m in medallion.MODELS if m.layer == "silver"}
    assert rows["silver_order_reviews"] == spark.table("silver__layers.order_reviews").count()


def test_layers_only_depend_on_earlier_layers():
    rank = {layer: i for i, layer in enumerate(medallion.LAYERS)}
    for spec in medallion.MODELS:
        for ref in spec.inputs:
            if not ref.startswith(medallion.SOURCE):
                assert rank[medallion.BY_NAME[ref].layer] < rank[spec.layer], (spec.name, ref)


def test_unknown_layer_rejected(spark):
    with pytest.raises(ValueError):
        medallion.build(spark, {}, "unused", layer="platinum")


def test_star_roundtrip_counts_match_lazy_models(spark, sf_dir):
    counts = {r.table_name: r.row_count for r in jobs.star_roundtrip(spark, raw_tables(spark, sf_dir)).collect()}
    lazy = medallion.Lake(raw_tables(spark, sf_dir))
    for name in medallion.STAR_TABLES:
        assert counts[name] == lazy.model(name).count(), name


def test_catalog_lists_all_registered_tables(spark, sf_dir):
    done = jobs.register_lake(spark, raw_tables(spark, sf_dir))
    other = jobs.register_lake(spark, raw_tables(spark, sf_dir))
    assert done.raw_database != other.raw_database  # two runs do not meet
    listed = catalog.list_tables(spark, [done.raw_database, done.star_database])
    names = {(r.namespace, r.tableName) for r in listed.collect()}
    assert names == {(catalog.RAW_DATABASE, t) for t in RAW_TABLES} | {
        (catalog.STAR_DATABASE, t) for t in medallion.STAR_TABLES
    }
    orders = catalog.source(spark, "orders", done.raw_database)
    assert orders.agg(F.count("*")).first()[0] == raw_tables(spark, sf_dir)["orders"].count()


def test_absent_sources_leave_out_their_models():
    names = {m.name for m in medallion.buildable({"orders", "order_items"})}
    assert names == {
        "bronze_orders", "bronze_order_items", "silver_orders", "silver_order_items",
        "dim_date", "fact_orders", "fact_sales",
    }
    assert len(medallion.buildable(set(RAW_TABLES))) == 26


def test_partial_landing_builds_what_it_can(spark, scratch):
    root = Path(scratch.removeprefix("file:"))
    (root / "landing").mkdir(parents=True)
    (root / "landing" / "product_category_name_translation.csv").write_text(
        "product_category_name,product_category_name_english\ncama,bed\n"
    )
    built = jobs.run_from_landing(spark, f"{scratch}/landing", scratch).collect()
    assert [(r.model, r.row_count) for r in built] == [("bronze_category_translation", 1)]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from strata.session import shared_root

    unset = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://head:7077")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_root(SimpleNamespace(sparkContext=cluster, conf=unset))


def test_kpis_over_materialized_gold_equal_lazy_kpis(spark, sf_dir):
    from strata.plans import kpis

    own = medallion.run_databases("gold_test")
    medallion.build(spark, raw_tables(spark, sf_dir), jobs.run_dir(spark, "t"), databases=own)
    built = medallion.Lake.from_catalog(spark, own)
    lazy = medallion.Lake(raw_tables(spark, sf_dir))
    for fn in (kpis.monthly_revenue, kpis.review_by_category, kpis.delivery_by_state,
               kpis.payment_trends, kpis.payment_totals, kpis.total_revenue, kpis.sales_by_state):
        assert sorted(map(tuple, fn(built).collect()), key=str) == sorted(
            map(tuple, fn(lazy).collect()), key=str
        )
    plan = kpis.monthly_revenue(built)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan  # reads the gold tables only


def test_publish_reports_writes_each_section(spark, sf_dir, scratch):
    from strata.plans import kpis, quality

    lazy = medallion.Lake(raw_tables(spark, sf_dir))
    reports = {
        "kpi_monthly_revenue": kpis.monthly_revenue(lazy),
        "dq_null_profile": quality.null_profile(lazy),
    }
    written = jobs.publish_reports(spark, reports, scratch)
    for name, df in reports.items():
        assert sorted(map(str, spark.read.parquet(written[name]).collect())) == sorted(map(str, df.collect()))
    assert spark.read.parquet(f"{scratch}/dq_null_profile").columns[-1] == "pct_text"


def test_digest_of_a_write_is_the_digest_of_what_is_read_back(spark, sf_dir, scratch):
    from strata.operators import content_digest

    raw = raw_tables(spark, sf_dir)
    tables = {t: raw[t] for t in ("orders", "order_items", "order_reviews", "geolocation")}
    tables["empty"] = raw["orders"].where("1 = 0")
    tables["grouped"] = raw["order_items"].groupBy("order_id").agg(F.sum("price").alias("p")).repartition(7)
    for name, done in lake.write_tables_digested(tables, scratch).items():
        df = done.read(spark)
        assert (done.row_count, done.digest) == tuple(df.agg(*content_digest(df)).first()), name


def test_a_reader_never_sees_a_gap_or_two_versions(spark, scratch):
    """A table is rebuilt twenty times while another thread reads it."""
    import threading

    seen, stop, errors = [], threading.Event(), []

    def write(k: int) -> lake.Written:
        df = spark.range(1000).select(F.lit(k).cast("int").alias("version"), F.col("id")).repartition(3)
        return lake.write_digested(df, f"{scratch}/t/{lake.new_version()}")

    def read():
        while not stop.is_set():
            try:
                r = spark.table("strata_publish_db.t").agg(F.min("version"), F.max("version"), F.count("*")).first()
                seen.append(tuple(r))
            except Exception as error:  # noqa: BLE001 - the test asserts that there is none
                errors.append(error)

    catalog.publish(spark, "strata_publish_db", {"t": write(0)})
    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 21):
        catalog.publish(spark, "strata_publish_db", {"t": write(k)})
        lake.retire(spark, f"{scratch}/t")
    stop.set()
    reader.join()
    assert errors == [] and len(seen) > 5
    assert all(low == high and n == 1000 for low, high, n in seen)
    assert [v for v, *_ in seen] == sorted(v for v, *_ in seen)
    assert spark.table("strata_publish_db.t").first()["version"] == 20
    assert len(list(Path(scratch.removeprefix("file:"), "t").iterdir())) == lake.KEEP_VERSIONS


def test_changed_columns_are_published_too(spark, scratch):
    one = lake.write_digested(spark.range(3), f"{scratch}/a")
    two = lake.write_digested(spark.range(4).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n")), f"{scratch}/b")
    for done, rows, columns in ((one, 3, ["id"]), (two, 4, ["id", "n"])):
        catalog.publish(spark, "strata_shape_db", {"t": done})
        assert spark.table("strata_shape_db.t").columns == columns and spark.table("strata_shape_db.t").count() == rows


def test_a_failed_build_publishes_nothing(spark, sf_dir):
    own, root = medallion.run_databases("failing"), jobs.run_dir(spark, "t")
    raw = raw_tables(spark, sf_dir)
    medallion.build(spark, raw, root, databases=own)
    before = spark.table("bronze__failing.orders").inputFiles()
    broken = raw["order_items"].withColumn("price", F.raise_error(F.lit("broken source")).cast("double"))
    with pytest.raises(Exception, match="broken source"):
        medallion.build(spark, {**raw, "order_items": broken}, root, databases=own)
    assert spark.table("bronze__failing.orders").inputFiles() == before
    medallion.build(spark, raw, root, databases=own)
    assert spark.table("bronze__failing.orders").inputFiles() != before


def test_a_slow_model_delays_only_what_needs_it(spark, sf_dir, monkeypatch):
    """With bronze_geolocation held back, every model but its descendants is written before it."""
    import threading

    from strata.sources import lake as lake_module

    order, lock, others = [], threading.Lock(), threading.Event()
    slow = {"geolocation/", "dim_geolocation/"}
    real = lake_module.write_digested

    def watched(df, path):
        if "/bronze/geolocation/" in path:
            assert others.wait(120)
        done = real(df, path)
        with lock:
            order.append(path)
            if sum(not any(s in p for s in slow) for p in order) == 23:
                others.set()
        return done

    monkeypatch.setattr(lake_module, "write_digested", watched)
    built = medallion.build(spark, raw_tables(spark, sf_dir), jobs.run_dir(spark, "t"), databases=medallion.run_databases("slow"))
    assert built.count() == 26
    assert [any(s in p for s in slow) for p in order] == [False] * 23 + [True] * 3


def test_graph_of_actions():
    from strata.parallel import run_graph

    done = []
    out = run_graph({n: (needs, lambda n=n: done.append(n) or n) for n, needs in {"c": "ab", "a": "", "b": "a"}.items()}, 3)
    assert done == ["a", "b", "c"] and out == {"a": "a", "b": "b", "c": "c"}
    with pytest.raises(ValueError, match="circle"):
        run_graph({"a": ("b", int), "b": ("a", int)})
    with pytest.raises(ValueError, match="unknown"):
        run_graph({"a": ("b", int)})
    with pytest.raises(ZeroDivisionError):
        run_graph({"a": ("", lambda: 1 // 0), "b": ("a", int), "c": ("", int)})
    assert run_graph({}) == {}
