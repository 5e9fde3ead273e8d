"""CSV records that span lines, cut at byte ranges anywhere."""

from __future__ import annotations

import csv
import io
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.sources.csv import CSV_OPTIONS, read_csv, read_text_cells
from strata.sources.records import lines, records
from strata.sources.schemas import RETAIL_SCHEMAS
from pyspark.sql.types import StringType, StructField, StructType

TEXT = StructType([StructField(c, StringType()) for c in ("id", "title", "message", "score")])


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of 1,000 bytes, so that a small file is many."""
    keys = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _file(seed: int, rows: int, eol: str) -> str:
    rng = random.Random(seed)
    bits = ["word", "a,b", 'say ""hi""', "\n", "\n\n", '""', ",", " ", "é", '"",""\n1,x', "  "]
    out = ["id,title,message,score"]
    for k in range(rows):
        field = lambda n: '"' + "".join(rng.choice(bits) for _ in range(rng.randint(0, n))) + '"'
        message = field(400) if rng.random() < 0.02 else field(12) if rng.random() < 0.8 else ""
        out.append(f"{k},{field(4)},{message},{rng.randint(1, 5)}")
        if rng.random() < 0.05:
            out.append("")
    return eol.join(out) + (eol if rng.random() < 0.5 else "")


def _rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_records_of_small_ranges_are_those_of_one_task(spark, scratch, small_ranges, seed):
    folder = Path(scratch.removeprefix("file:"))
    folder.mkdir(parents=True)
    eol = "\r\n" if seed == 3 else "\n"
    texts = {f"f{k}.csv": _file(10 * seed + k, 150, eol) for k in range(2)}
    for name, text in texts.items():
        (folder / name).write_bytes(("\ufeff" * (seed == 2) + text).encode())
    one = spark.read.schema(TEXT).options(**CSV_OPTIONS, multiLine="true").csv(scratch)
    many = read_text_cells(spark, scratch, TEXT, multiline=True)
    assert lines(spark, scratch).select("file", "range_start").distinct().count() > 10
    want = [
        tuple(x or None for x in r)
        for text in texts.values()
        for r in list(csv.reader(io.StringIO(text.replace("\r\n", "\n"), newline="")))[1:]
        if r
    ]
    assert _rows(many) == sorted(want, key=str)
    got, same = _rows(many), _rows(one)
    assert got == same


def test_one_file_of_quoted_newlines_is_many_tasks(spark, scratch):
    """A review file of 12 MB in ranges of 1 MB."""
    folder = Path(scratch.removeprefix("file:"))
    folder.mkdir(parents=True)
    names = RETAIL_SCHEMAS["order_reviews"].names
    body = "\n".join(
        f'r{k},o{k},{k % 5 + 1},"title ""{k}""","line one of {k}\nline two, with ""quotes""\n\nline {"x" * (k % 300)}",'
        "2017-10-11 00:00:00,2017-10-12 03:43:48"
        for k in range(40_000)
    )
    (folder / "reviews.csv").write_text(",".join(names) + "\n" + body + "\n")
    schema = RETAIL_SCHEMAS["order_reviews"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert lines(spark, scratch).rdd.getNumPartitions() > 8
        many = read_csv(spark, scratch, schema, multiline=True)
        digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*schema.names).cast("decimal(38,0)"))).first()
        one = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(scratch)
        assert digest(many) == digest(one) and digest(many)[0] == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_other_headers_are_refused(spark, scratch):
    folder = Path(scratch.removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('id,title,message,score\n1,"a\nb",,5\n')
    (folder / "b.csv").write_text("id,message,title,score\n2,x,y,5\n")
    with pytest.raises(PySparkException, match="header differs"):
        read_text_cells(spark, scratch, TEXT, multiline=True).collect()


def test_short_long_and_header_only_files(spark, scratch):
    folder = Path(scratch.removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,title,message,score\n")
    assert read_text_cells(spark, scratch, TEXT, multiline=True).collect() == []
    assert records(spark, scratch).count() == 1
    (folder / "b.csv").write_text('id,title,message,score\n1,"only\ntwo"\n2,a,b,c,d,e\n')
    got = _rows(read_text_cells(spark, scratch, TEXT, multiline=True))
    assert got == [("1", "only\ntwo", None, None), ("2", "a", "b", "c")]
