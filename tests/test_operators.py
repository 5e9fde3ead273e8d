"""Operator-level properties: exact rounding, both dedupe forms, joins, top-k."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import rounded_ratio
from strata.operators import (
    content_digest,
    enrich_bounded,
    latest_per_key,
    top_k,
)


def half_up(num: int, den: int, scale: int) -> float:
    q = Fraction(abs(num) * 10**scale, den)
    n = int(q + Fraction(1, 2))  # floor(q + 1/2)
    return (n if num >= 0 else -n) / 10**scale


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)),
        min_size=1,
        max_size=40,
    )
)
def test_rounded_ratio_is_exact_half_up(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long")
    scales = (1, 2, 6)
    got = df.select(*[rounded_ratio("n", "d", s).alias(f"x{s}") for s in scales]).collect()
    for s in scales:
        assert [r[f"x{s}"] for r in got] == [half_up(n, d, s) for n, d in rows]


def test_rounded_ratio_ties_and_zero(spark):
    df = spark.createDataFrame([(5, 1000), (-5, 1000), (1, 0), (0, 7)], "n long, d long")
    got = [r.x for r in df.select(rounded_ratio("n", "d", 2).alias("x")).collect()]
    assert got == [0.01, -0.01, None, 0.0]


TS = [None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 2, 0, 0, 1)]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.sampled_from(range(len(TS))), st.integers(0, 5)),
        min_size=1,
        max_size=30,
    )
)
def test_window_dedupe_keeps_the_newest(spark, rows):
    data = [(k, TS[t], tb, i) for i, (k, t, tb) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, tb int, i int")
    a = sorted(tuple(r) for r in latest_per_key(df, ["k"], "ts", ["tb", "i"]).collect())
    # reference by plain Python: newest time first, NULL last, then tb, then i
    best = {}
    for k, ts, tb, i in data:
        key = (ts is None, -(ts.timestamp() if ts else 0), tb, i)
        if k not in best or key < best[k][0]:
            best[k] = (key, (k, ts, tb, i))
    assert a == sorted(v for _, v in best.values())


def test_enrich_bounded_keeps_every_bounded_row(spark):
    sales = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, 20.0), (9, 50.0)], "k int, v double")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    best = top_k(sales, 2, [F.desc("v"), F.asc("k")])
    got = sorted(map(tuple, enrich_bounded(best, 2, dim, "k").select("k", "name", "v").collect()))
    assert got == [(2, "b", 30.0), (9, None, 50.0)]


def test_enrichment_takes_a_bounded_number_of_rows(spark):
    dim = spark.range(5).withColumnRenamed("id", "k")
    assert enrich_bounded(dim, 3, dim, "k").count() == 3
    for k in (0, 10_001):
        with pytest.raises(ValueError):
            enrich_bounded(dim, k, dim, "k")


def test_content_digest_sees_values_and_not_order(spark):
    rows = [(1, "a", 1.5), (2, None, None), (3, "c", 0.1)]
    make = lambda data: spark.createDataFrame(data, "x int, y string, z double")
    digest = lambda df: tuple(df.agg(*content_digest(df)).first())
    first = digest(make(rows))
    assert first == digest(make(rows[::-1]).repartition(3)) == digest(make(rows).select("z", "y", "x"))
    assert first != digest(make([*rows[:2], (3, "c", 0.2)])) and first[0] == 3
    assert digest(make(rows[:0])) == (0, "0")


def test_threads_inherit_properties_and_raise(spark):
    from strata.parallel import run_all

    context = spark.sparkContext
    context.setLocalProperty("strata.test", "here")
    try:
        seen = run_all([lambda: context.getLocalProperty("strata.test")] * 3, threads=2)
    finally:
        context.setLocalProperty("strata.test", None)
    assert seen == ["here"] * 3
    assert run_all([lambda k=k: k for k in range(20)], threads=4) == list(range(20))
    with pytest.raises(ZeroDivisionError):
        run_all([lambda: 1 // 0, lambda: 2], threads=2)


def test_duplicate_counts_against_counting_rows(spark):
    from collections import Counter

    from strata.operators import duplicate_counts

    rows = [("a", None, 1), (None, "a", 1), ("a", None, 2), (None, None, 3), (None, None, None), ("", "a", 3), ("a", "b", 1)]
    rows += [("hot", "hot", k % 7) for k in range(500)]
    one = spark.createDataFrame(rows, "k string, l string, n int").repartition(3)
    other = spark.range(10).selectExpr("id % 4 as k")
    keys = {1: ("k", "l"), 2: ("l", "k"), 3: ("k",), 4: ("k", "l", "n")}
    got = duplicate_counts([(one, keys), (other, {9: ("k",)}), (one.where("false"), {7: ("k",)})])
    at = {"k": 0, "l": 1, "n": 2}
    want = {t: len(rows) - len(Counter(tuple(r[at[c]] for c in cols) for r in rows)) for t, cols in keys.items()}
    assert {r["tag"]: (r["rows"], r["duplicates"]) for r in got.collect()} == {
        **{t: (len(rows), n) for t, n in want.items()},
        9: (10, 6),
    }


def test_duplicate_keys_expand_no_rows(spark, sf_dir):
    from strata.plans.queries import QUERIES

    plan = QUERIES["dq_duplicate_keys"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("hashpartitioning(tag") >= 1


def test_digest_text_of_fractions_is_the_text_of_the_cast(spark):
    """Ties, noise, both zeros, tiny, large and not finite values: the short way gives what the cast gives."""
    import random

    from strata.operators.digest import FRACTION, _fraction

    rng = random.Random(5)
    values = [0.0, -0.0, 5e-9, -5e-9, 1.5e-8, 2.5e-8, 123456.123456785, 0.1 + 0.2, 9999999.99999999, 1e7, -1e7, 1e19]
    values += [float("nan"), float("inf"), None] + [rng.uniform(-(10**k), 10**k) for k in range(-8, 9) for _ in range(50)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    short, cast = _fraction(F.col("x")), F.col("x").cast(FRACTION)
    assert df.where(~short.cast("string").eqNullSafe(cast.cast("string"))).collect() == []
    assert short._jc.toString() != cast._jc.toString()
