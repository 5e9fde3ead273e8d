from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from strata.llm import decontam, jaccard_join, mixing, quality, registry
from strata.llm.scratch import Scratch
from tests.llm.test_native import _check_shards

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(registry.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    want = cur.fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))


def test_pipeline_equals_its_stages_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in quality.quality_scores(docs, Scratch(spark, "t")).where("keep").collect()}
    step = docs.where(docs["doc_id"].isin(sorted(good)))
    reps = {r["component_id"] for r in jaccard_join.jaccard_components(step, Scratch(spark, "t")).collect()}
    step = docs.where(docs["doc_id"].isin(sorted(reps)))
    dirty = {r["doc_id"] for r in decontam.contamination_digest(step, bench, Scratch(spark, "t")).where("contaminated").collect()}
    left = sorted(reps - dirty)
    step = docs.where(docs["doc_id"].isin(left))
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mixing_digest(step, Scratch(spark, "t")).collect()}
    want = sorted(i for i, (t, n) in taken.items() for _ in range(t // n if n else 0))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got if taken[r["doc_id"]][1]) == want
    _check_shards(got, len(got))
    assert all(r["size"] == len(rows[r["doc_id"]]["text"].encode()) + 1 for r in got)
    assert len(good) >= 0.7 * len(rows) and len(left) > 0.5 * len(good)


def test_stages_keep_the_columns(spark, sf_dir, docs):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, sf_dir).columns == frame.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_stages_take_odd_rows(spark, sf_dir, docs, no_docs):
    for frame in (docs, no_docs):
        step = frame
        for _, stage in corpus_pipeline.STAGES:
            step = Scratch(spark, "odd").table(stage(spark, step, sf_dir), "step")
        assert (step.count() > 0) == (frame is docs)
