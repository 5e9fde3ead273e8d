"""Sessions whose tasks stay small however large the input is, and the lake's file size."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from strata import session
from strata.plans import queries
from strata.sources import lake

PARTITIONS = "spark.sql.shuffle.partitions"


def test_partitions_grow_with_the_input(spark):
    before = spark.conf.get(PARTITIONS)
    small = session.sized_session(spark, session.PARTITION_BYTES)
    large = session.sized_session(spark, 100 * session.PARTITION_BYTES)
    assert small is spark
    assert large.conf.get(PARTITIONS) == "100"
    assert large.conf.get("spark.sql.files.maxPartitionBytes") == str(session.READ_BYTES)
    assert spark.conf.get(PARTITIONS) == before


def test_settings_of_the_caller_are_kept(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    own.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    own.conf.set(PARTITIONS, "300")
    large = session.sized_session(own, 100 * session.PARTITION_BYTES)
    assert large.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert large.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    assert large.conf.get(PARTITIONS) == "300"


def test_stored_bytes(spark, scratch):
    lake.write_table(spark.range(1000), f"{scratch}/t")
    assert session.stored_bytes(spark, [f"{scratch}/t", f"{scratch}/absent"]) > 0
    assert session.stored_bytes(spark, [f"{scratch}/absent"]) == 0


@pytest.mark.parametrize("name", ["catalog_register", "catalog_kpi_review_by_category", "medallion_layer", "fact_reviews"])
def test_same_rows_in_a_sized_session(spark, sf_dir, monkeypatch, name):
    def rows() -> list:
        return sorted(map(tuple, queries.QUERIES[name](spark, sf_dir).collect()), key=repr)

    monkeypatch.setattr(queries, "_REGISTERED", {})
    plain = rows()
    seen = []
    sources = queries.raw_tables
    monkeypatch.setattr(queries, "_REGISTERED", {})
    monkeypatch.setattr(session, "PARTITION_BYTES", 20_000)
    monkeypatch.setattr(queries, "raw_tables", lambda own, path: seen.append(own) or sources(own, path))
    assert rows() == plain
    assert seen and all(int(own.conf.get(PARTITIONS)) > int(spark.conf.get(PARTITIONS)) for own in seen)


def test_lake_files_are_compressed_well(spark, scratch):
    rows = spark.range(50_000).select("id", F.concat(F.lit("order-"), F.col("id").cast("string")).alias("name"))
    rows.write.option("compression", "snappy").parquet(f"{scratch}/snappy")
    lake.write_table(rows, f"{scratch}/lake")
    sizes = [session.stored_bytes(spark, [f"{scratch}/{d}"]) for d in ("lake", "snappy")]
    assert sizes[0] < 0.8 * sizes[1]
    assert lake.read_tables(spark, scratch, ["lake"])["lake"].count() == 50_000
