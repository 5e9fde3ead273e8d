"""The disk of a build: large shuffles one at a time, and shuffle files that go with their query."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta
from pathlib import Path
from threading import Event, Lock

import pytest

from strata import session
from strata.plans import medallion
from strata.sources import lake
from strata.sources.schemas import RETAIL_SCHEMAS

SHUFFLING = [spec for spec in medallion.MODELS if spec.shuffles]


@pytest.fixture(scope="module")
def sources(spark):
    """Orders and lines with repeated, null and unknown keys, and null and equal answer times."""
    rng = random.Random(7)
    day = lambda: rng.choice([None, datetime(2018, 1, 1) + timedelta(hours=rng.randrange(900))])
    some = lambda prefix, n: rng.choice([None, f"{prefix}{rng.randrange(n)}"])
    orders = [(some("o", 60), some("c", 9), "shipped", day(), day(), day(), day(), day()) for _ in range(80)]
    items = [(some("o", 70), k % 4, some("p", 5), some("s", 5), day(), rng.choice([None, 2.5, 0.1]), 1.25) for k in range(200)]
    payments = [(some("o", 70), k % 3, "boleto", k % 5, rng.choice([None, 9.99])) for k in range(200)]
    reviews = [(some("r", 50), some("o", 40), k % 5, rng.choice([None, "t"]), some("m", 9), day(), day()) for k in range(200)]
    rows = {"orders": orders, "order_items": items, "order_payments": payments, "order_reviews": reviews}
    return {t: spark.createDataFrame(r + r[:20], RETAIL_SCHEMAS[t]).repartition(3) for t, r in rows.items()}


def _rows(df) -> list:
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("large", [True, False])
def test_large_models_that_shuffle_run_one_at_a_time(spark, sources, scratch, monkeypatch, large):
    """The bytes decide; either way the tables are those of the models."""
    running, most, guard, second = set(), [], Lock(), Event()
    write_digested = lake.write_digested

    def watched(df, path):
        name = next((spec.name for spec in SHUFFLING if f"/{spec.layer}/{spec.alias}/" in path), None)
        if name is None:
            return write_digested(df, path)
        with guard:
            running.add(name)
            most.append(len(running))
            if len(running) > 1:
                second.set()
        if not large and name in ("fact_payments", "fact_sales"):
            assert second.wait(60)  # nothing keeps another one from starting
        try:
            return write_digested(df, path)
        finally:
            with guard:
                running.discard(name)

    monkeypatch.setattr(lake, "write_digested", watched)
    monkeypatch.setattr(medallion, "ALONE_BYTES", 1 if large else 1 << 30)
    databases = medallion.run_databases(f"alone_{large}".lower())
    built = {r.model: r.row_count for r in medallion.build(spark, sources, scratch, databases=databases).collect()}
    assert len(most) == len(SHUFFLING) == 4 and (max(most) == 1) == large
    models = medallion.Lake(sources)
    for spec in SHUFFLING:
        rows = _rows(models.model(spec.name))
        assert _rows(spark.table(medallion.table_name(spec, databases))) == rows and built[spec.name] == len(rows) > 10


def test_bytes_of_what_is_scanned(spark, scratch):
    lake.write_table(spark.range(1000).selectExpr("id", "id as order_id"), f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    size = sum(p.stat().st_size for p in Path(f"{scratch}/t".removeprefix("file:")).glob("*.parquet"))
    assert session.scanned_bytes([df.where("id > 3").select("id"), df]) == 2 * size > 0


def test_a_build_leaves_no_shuffle_files(spark, sources, scratch):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> set[str]:
        found = blocks.getAllFiles()
        names = {found.apply(k).getName() for k in range(found.size())}
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = files()
    medallion.build(spark, sources, scratch, databases=medallion.run_databases("tidy"))
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert left == set()


def test_a_tidy_session_keeps_the_callers_settings(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "37")
    tidy = session.tidy_session(own)
    assert tidy.conf.get("spark.sql.shuffle.partitions") == "37" and tidy.conf.get(session.TIDY) == "true"
    assert own.conf.get(session.TIDY) == "false"
    assert session.tidy_session(tidy) is tidy
