"""Hand-made frames for the semantic traps the test tables cannot show
(FIXTURES.md §4): CSV quoting, declared types, casts, dedupe survivors,
NULL groups, NULL keys, orphan rows and missing landing files."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.plans import kpis, quality
from strata.plans.medallion import Lake
from strata.sources import csv
from strata.sources import lake as lake_folders
from strata.sources.schemas import RETAIL_SCHEMAS, LandingFile

T = dt.datetime


def local(path: str) -> Path:
    return Path(path[len("file:") :] if path.startswith("file:") else path)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, RETAIL_SCHEMAS[table])


REVIEW_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,,"great\nproduct, arrived ""early""",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
    "r2,o2,4,ok,fine,2018-01-03 00:00:00,\n"
    'r3,o3,1,"bad","never ""arrived""",2018-01-04 00:00:00,2018-01-05 08:30:00\n'
)


def test_csv_multiline_and_doubled_quotes(spark, scratch):
    d = local(scratch)
    d.mkdir(parents=True)
    (d / "reviews.csv").write_text(REVIEW_CSV)
    path = f"{scratch}/reviews.csv"
    df = csv.read_csv(spark, path, RETAIL_SCHEMAS["order_reviews"], multiline=True)
    rows = {r.review_id: r for r in df.collect()}
    assert len(rows) == 3
    assert rows["r1"].review_comment_message == 'great\nproduct, arrived "early"'
    assert rows["r3"].review_comment_message == 'never "arrived"'
    assert rows["r2"].review_answer_timestamp is None
    assert rows["r1"].review_answer_timestamp == T(2018, 1, 2, 10, 0, 0)
    assert dict(df.dtypes)["review_score"] == "int"
    # without multi-line parsing the quoted newline splits a record
    split = csv.read_csv(spark, path, RETAIL_SCHEMAS["order_reviews"], multiline=False)
    assert split.count() > 3


def test_zip_prefix_keeps_leading_zero(spark, scratch):
    d = local(scratch)
    d.mkdir(parents=True)
    (d / "c.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01037,sao paulo,SP\n"
    )
    df = csv.read_csv(spark, f"{scratch}/c.csv", RETAIL_SCHEMAS["customers"])
    assert df.first().customer_zip_code_prefix == "01037"


def test_bad_score_becomes_null_not_an_error(spark):
    bronze = spark.createDataFrame(
        [("r1", "o1", "x", None, None, T(2018, 1, 1), T(2018, 1, 2))],
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz",
    )
    lake = Lake({"order_reviews": bronze})
    assert lake.model("silver_order_reviews").first().review_score is None
    with pytest.raises((NumberFormatException, ArithmeticException, Exception)):
        bronze.select(F.col("review_score").cast("int")).collect()  # ANSI cast raises


def _reviews(spark, rows):
    return frame(spark, "order_reviews", rows)


def test_review_survivor_latest_then_null_loses(spark):
    rows = [
        # same review_id: the NULL answer time loses, the later time wins
        ("r1", "o1", 3, None, None, T(2018, 1, 1), None),
        ("r1", "o1", 4, None, None, T(2018, 1, 1), T(2018, 1, 3)),
        ("r1", "o1", 5, None, None, T(2018, 1, 1), T(2018, 1, 2)),
        # same order, two review ids with equal times: smallest review_id wins
        ("r3", "o2", 2, None, None, T(2018, 2, 1), T(2018, 2, 2)),
        ("r2", "o2", 1, None, None, T(2018, 2, 1), T(2018, 2, 2)),
        # only NULL times: still one survivor per order
        ("r4", "o3", 1, None, None, T(2018, 3, 1), None),
    ]
    lake = Lake({"order_reviews": _reviews(spark, rows)})
    got = {r.order_id: (r.review_id, r.review_score) for r in lake.model("silver_order_reviews").collect()}
    assert got == {"o1": ("r1", 4), "o2": ("r2", 1), "o3": ("r4", 1)}
    # the window-free form applies the same rule
    alt = {r.order_id: (r.review_id, r.review_score) for r in kpis.latest_review_per_order(lake).collect()}
    assert alt == got


def _star_lake(spark, *, items, orders, products=None, cat=None, customers=None):
    sources = {
        "order_items": frame(spark, "order_items", items),
        "orders": frame(spark, "orders", orders),
        "products": frame(spark, "products", products or []),
        "category_translation": frame(spark, "category_translation", cat or []),
        "customers": frame(spark, "customers", customers or []),
    }
    return Lake(sources)


def _order(oid, ts, cust="c1", status="delivered", delivered=None):
    return (oid, cust, status, ts, ts, delivered, delivered, ts)


def _item(oid, n, pid, price, freight=0.0, seller="s1"):
    return (oid, n, pid, seller, T(2018, 1, 1), price, freight)


def test_null_category_group_vs_missing_label(spark):
    lake = _star_lake(
        spark,
        items=[_item("o1", 1, "p1", 10.0), _item("o1", 2, "p2", 5.0), _item("o1", 3, "p3", 1.0)],
        orders=[_order("o1", T(2018, 1, 5, 10))],
        products=[
            ("p1", None, 1, 1, 1, 1, 1, 1, 1),
            ("p2", "cama", 1, 1, 1, 1, 1, 1, 1),
            ("p3", "mesa", 1, 1, 1, 1, 1, 1, 1),
        ],
        cat=[("cama", ""), ("mesa", "table")],
    )
    sql_form = {r.category: r.revenue for r in kpis.revenue_by_category(lake).collect()}
    assert sql_form == {None: 10.0, "": 5.0, "table": 1.0}
    report_form = {r.category: r.revenue for r in kpis.category_top10(lake).collect()}
    assert report_form == {"(missing)": 5.0, "table": 1.0}


def test_null_keys_count_as_duplicates(spark):
    from strata.operators import distinct_key_count

    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "k string")
    assert df.agg(distinct_key_count(["k"]).alias("n")).first().n == 3  # of five rows


def test_null_purchase_time_drops_from_dated_kpis(spark):
    lake = _star_lake(
        spark,
        items=[_item("o1", 1, "p1", 10.0), _item("o2", 1, "p1", 7.0)],
        orders=[_order("o1", T(2018, 1, 5, 10)), _order("o2", None)],
    )
    assert lake.model("fact_sales").count() == 2
    assert lake.model("dim_date").count() == 1
    monthly = kpis.monthly_revenue(lake).collect()
    assert [(r.year, r.month, r.monthly_revenue) for r in monthly] == [(2018, 1, 10.0)]
    assert kpis.total_revenue(lake).first().total_revenue == 17.0  # undated revenue counts in the total
    lines = {r.label: r.revenue_brl for r in kpis.report_monthly_revenue(lake).collect()}
    assert lines == {"2018-01": "10.00", "Total revenue": "17.00"}


def test_review_without_order_survives_with_null_dates(spark):
    lake = Lake(
        {
            "order_reviews": _reviews(spark, [("r1", "ghost", 5, None, None, T(2018, 1, 1), None)]),
            "orders": frame(spark, "orders", [_order("o1", T(2018, 1, 5, 10))]),
        }
    )
    row = lake.model("fact_reviews").first()
    assert (row.order_id, row.date_key, row.purchase_date) == ("ghost", None, None)


def test_null_price_fails_not_null_test(spark):
    lake = _star_lake(
        spark,
        items=[_item("o1", 1, "p1", None), _item("o1", 2, "p1", 3.0)],
        orders=[_order("o1", T(2018, 1, 5, 10))],
        customers=[("c1", "u1", "01037", "city", "SP")],
        products=[("p1", "cama", 1, 1, 1, 1, 1, 1, 1)],
    )
    lake.sources["sellers"] = frame(spark, "sellers", [("s1", "1", "x", "SP")])
    res = {(r.model, r.column_name): (r.failures, r.status) for r in quality.test_not_null(lake).collect()}
    assert res[("fact_sales", "revenue")] == (1, "fail")
    assert res[("fact_sales", "order_id")] == (0, "pass")


def test_delivery_days_rounding_and_null(spark):
    lake = _star_lake(
        spark,
        items=[],
        orders=[
            # 1 day + 432 s = 1.005 days → rounds half-up to 1.01
            _order("o1", T(2018, 1, 1, 0, 0, 0), delivered=T(2018, 1, 2, 0, 7, 12)),
            _order("o2", T(2018, 1, 1), delivered=None),
        ],
    )
    days = {r.order_id: r.delivery_days for r in lake.model("silver_orders").collect()}
    assert days == {"o1": 1.01, "o2": None}


def test_missing_landing_file_is_skipped_missing_dir_fails(spark, scratch):
    d = local(scratch)
    (d / "landing").mkdir(parents=True)
    (d / "landing" / "cat.csv").write_text(
        "product_category_name,product_category_name_english\ncama,bed\n"
    )
    files = [
        LandingFile("cat.csv", "category_translation"),
        LandingFile("absent.csv", "sellers"),
    ]
    reg = csv.ingest(spark, f"{scratch}/landing", f"{scratch}/raw", RETAIL_SCHEMAS, files).collect()
    assert [(r.table_name, r.row_count) for r in reg] == [("category_translation", 1)]
    with pytest.raises(FileNotFoundError):
        csv.ingest(spark, f"{scratch}/nowhere", f"{scratch}/raw2", RETAIL_SCHEMAS, files)


def test_csv_columns_are_bound_by_header(spark, scratch):
    d = local(scratch)
    (d / "pay").mkdir(parents=True)
    (d / "pay" / "a.csv").write_text(
        "payment_value,extra,payment_type,order_id,payment_installments,payment_sequential\n"
        "12.5,x,card,o1,3,1\noops,x,  padded  ,o2,,2\n"
    )
    schema = RETAIL_SCHEMAS["order_payments"]
    rows = [tuple(r) for r in csv.read_csv(spark, f"{scratch}/pay", schema).orderBy("order_id").collect()]
    assert rows == [("o1", 1, "card", 3, 12.5), ("o2", 2, "  padded  ", None, None)]
    files = [LandingFile("pay", "order_payments")]
    reg = csv.ingest(spark, scratch, f"{scratch}/raw3", RETAIL_SCHEMAS, files).first()
    assert (reg.row_count, reg.malformed_cells) == (2, 1)  # "oops"; an empty cell is no malformed one
    (d / "pay" / "b.csv").write_text("order_id,payment_type\no3,card\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_csv(spark, f"{scratch}/pay", schema).collect()
    with pytest.raises(ValueError, match="customer_id"):
        csv.read_csv(spark, f"{scratch}/pay", RETAIL_SCHEMAS["orders"])


def _landing(d) -> list[LandingFile]:
    """A payment folder of two files with three malformed cells, and a review file whose bad cell stands behind a line break."""
    (d / "in" / "pay").mkdir(parents=True)
    head = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    (d / "in" / "pay" / "a.csv").write_text(head + "o1,1,card,3,12.5\no2,first,card,2,oops\n")
    (d / "in" / "pay" / "b.csv").write_text(head + "o3,1,card,2,1e\no4,,card,,\n")
    (d / "in" / "rev.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines",2018-01-01 00:00:00,2018-01-02 00:00:00\nr2,o2,4,,,yesterday,\n'
    )
    (d / "in" / "cat.csv").write_text("product_category_name,product_category_name_english\ncama,bed\n")
    return [
        LandingFile("pay", "order_payments"),
        LandingFile("rev.csv", "order_reviews", multiline=True),
        LandingFile("cat.csv", "category_translation"),
    ]


def test_rejected_cells_are_named(spark, scratch):
    d = local(scratch)
    files = _landing(d)
    reg = csv.ingest(spark, f"{scratch}/in", f"{scratch}/raw", RETAIL_SCHEMAS, files).collect()
    assert {r.table_name: (r.row_count, r.malformed_cells) for r in reg} == {
        "order_payments": (4, 3), "order_reviews": (2, 1), "category_translation": (1, 0),
    }
    got = csv.rejected_cells(spark, f"{scratch}/raw").collect()
    assert sorted((r.table_name, r.file_name.rsplit("/", 1)[1], json.loads(r.record).get("order_id"), r.column_name, r.cell) for r in got) == [
        ("order_payments", "a.csv", "o2", "payment_sequential", "first"),
        ("order_payments", "a.csv", "o2", "payment_value", "oops"),
        ("order_payments", "b.csv", "o3", "payment_value", "1e"),
        ("order_reviews", "rev.csv", "o2", "review_creation_date", "yesterday"),
    ]
    for f in files:
        assert csv.raw_table(spark, f"{scratch}/raw", f.table, RETAIL_SCHEMAS[f.table]).columns == RETAIL_SCHEMAS[f.table].names
    # the rejects come from the written rows, by the one column that holds them
    plan = csv._rejects_of(spark, f"{scratch}/in", f"{scratch}/raw", files[0])._jdf.queryExecution().executedPlan().toString()
    assert "csv" not in plan.lower().replace(".csv", "") and "IsNotNull(_rejected.file)" in plan


def test_ingest_again_reads_changed_files_only(spark, scratch):
    d = local(scratch)
    files = _landing(d)
    raw = d / "raw"

    def run(schemas=RETAIL_SCHEMAS):
        reg = csv.ingest(spark, f"{scratch}/in", f"{scratch}/raw", schemas, files).collect()
        written = {f.table: sorted(p.name for p in (raw / f.table).glob("part-*")) for f in files}
        return {r.table_name: (r.row_count, r.malformed_cells) for r in reg}, written

    first, before = run()
    assert run() == (first, before)
    with (d / "in" / "pay" / "b.csv").open("a") as out:
        out.write("o5,1,card,2,never\n")
    second, after = run()
    assert second == {**first, "order_payments": (5, 4)}
    assert [t for t in before if before[t] != after[t]] == ["order_payments"]
    cells = {r.cell for r in csv.rejected_cells(spark, f"{scratch}/raw").collect()}
    assert cells == {"first", "oops", "1e", "never", "yesterday"}
    (d / "in" / "pay" / "c.csv").write_text((d / "in" / "pay" / "a.csv").read_text())
    third, later = run()
    assert third["order_payments"] == (7, 6) and later["order_reviews"] == after["order_reviews"]
    # another declared type, and a table whose write broke off, are read again
    wide = {**RETAIL_SCHEMAS, "category_translation": StructType([StructField("product_category_name", StringType())])}
    _, typed = run(wide)
    assert [t for t in later if later[t] != typed[t]] == ["category_translation"]
    lake_folders.remove(spark, f"{scratch}/raw/{csv.MANIFEST}/order_reviews")
    _, last = run(wide)
    assert [t for t in typed if typed[t] != last[t]] == ["order_reviews"]


def test_landing_keeps_text_and_microseconds(spark, scratch):
    rows = [(" pad ", T(2018, 1, 5, 10).replace(microsecond=123456), "a\nb"), ("x ", None, 'q"x"'), (None, T(2018, 1, 5), ",")]
    df = spark.createDataFrame(rows, "a string, t timestamp_ntz, b string")
    csv.write_csv(df, f"{scratch}/text")
    back = csv.read_csv(spark, f"{scratch}/text", df.schema, multiline=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_null_groups_drop_from_report_forms(spark):
    lake = _star_lake(
        spark,
        items=[_item("o1", 1, "p1", 10.0), _item("o1", 2, "p1", 99.0)],
        orders=[_order("o1", T(2018, 1, 5, 10))],
    )
    sales = lake.model("fact_sales").withColumn(
        "seller_id", F.when(F.col("price") < 50, F.col("seller_id"))
    )
    pay = spark.createDataFrame(
        [("o1", 20180105, T(2018, 1, 5).date(), None, 5.0), ("o1", 20180105, T(2018, 1, 5).date(), "card", 7.0)],
        "order_id string, date_key int, purchase_date date, payment_type string, payment_value double",
    )
    sellers = spark.createDataFrame([("s1", "x", "SP")], "seller_id string, seller_city string, seller_state string")
    built = Lake({}, pinned={"fact_sales": sales, "fact_payments": pay, "dim_seller": sellers})
    assert [r.seller_id for r in kpis.sellers_top10(built).collect()] == ["s1"]
    assert [(r.payment_type, r.payment_value) for r in kpis.payment_totals(built).collect()] == [("card", 7.0)]
    assert [tuple(r) for r in kpis.payment_recent_months(built).collect()] == [("2018-01", "card", 7.0)]


def test_key_tests_ignore_null_for_unique_and_count_it_for_not_null(spark):
    customers = frame(
        spark,
        "customers",
        [("c1", "u", "1", "x", "SP"), ("c1", "u", "1", "x", "SP"), (None, "u", "1", "x", "SP"),
         (None, "u", "1", "x", "SP"), ("c2", "u", "1", "x", "RJ")],
    )
    empty = "order_id string, revenue double"
    lake = Lake(
        {"customers": customers},
        pinned={
            "fact_sales": spark.createDataFrame([], empty),
            "fact_orders": spark.createDataFrame([], empty),
            "dim_seller": spark.createDataFrame([("s1",)], "seller_id string"),
            "dim_product": spark.createDataFrame([("p1",)], "product_id string"),
        },
    )
    got = {(r.test_name, r.model, r.column_name): (r.failures, r.status)
           for r in quality.test_summary(lake).collect()}
    assert got[("unique", "dim_customer", "customer_id")] == (1, "fail")   # c1 twice; NULLs ignored
    assert got[("not_null", "dim_customer", "customer_id")] == (2, "fail")
    assert got[("unique", "dim_seller", "seller_id")] == (0, "pass")
    assert len(got) == 10
