"""CSV records that may span lines, read by many tasks.

Whether a line break ends a record depends on all quotes before it in the
file: it does where their number is even.  So the lines of every byte range
are read side by side, the quotes of each range are counted first, and the
running sum of these counts over a file's ranges tells each range whether it
starts inside a quoted field.  Inside a range the running sum goes on line by
line.  Only the pieces of records that cross a range border are put together
afterwards, at most two pieces a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Where a record begins: its file (hashed: paths are long), the first byte of its range and its place there.
PLACE = ("file", "range_start", "place")


def file_hash() -> Column:
    """A file by the hash of its path, as a file source sees it."""
    return F.xxhash64("_metadata.file_path")


def _quotes(line: str) -> Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, range_start, place, line)``: physical lines, ``place`` rising inside a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        file_hash().alias("file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def _blank() -> Column:
    return F.col("line").isin("", "\r")


def _range_states(spark: SparkSession, path: str) -> DataFrame:
    """``(file, range_start, open, plain, first)``: a row a range.

    ``open``: whether it starts inside a quoted field; ``plain``: whether all
    its lines are records; ``first``: the place of its first line that is not
    blank.
    """
    quotes = _quotes("line")
    counts = lines(spark, path).groupBy("file", "range_start").agg(
        F.sum(quotes).alias("quotes"),
        F.max(quotes % 2).alias("odd"),
        F.min(F.when(~_blank(), F.col("place"))).alias("first"),
    )
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    return counts.select("file", "range_start", opened.alias("open"), "odd", "first").withColumn(
        "plain", (F.col("open") == 0) & (F.col("odd") == 0)
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, range_start, place, is_first, record)``: records of RFC 4180 CSV files, line breaks kept inside quotes.

    A quote opens or closes a quoted field, or stands doubled inside one; files
    with lone quotes in unquoted fields are not RFC 4180 and have no defined
    records here.  Empty lines are no records; a carriage return before the
    line break that ends a record is not part of it, nor is a byte order mark.
    A range without a line of oddly many quotes passes as it is.  The lines of
    another range are sorted in one task, as large as
    ``spark.sql.files.maxPartitionBytes`` makes ranges, and only lines of longer
    records are grouped.  Ranges must not change between the two scans of a
    query; if they do (their size follows the cluster's cores where there are
    fewer bytes than cores), the query fails and can be run again.

    The states of the ranges are broadcast: a row a range, fewer bytes than the
    list of files that the driver holds for the scan.
    """
    in_order = Window.partitionBy("file", "range_start").orderBy("place")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    changed = F.raise_error(F.lit("the byte ranges of the files changed while they were read")).cast("boolean")
    stated = (
        lines(spark, path)
        .join(F.broadcast(_range_states(spark, path)), ["file", "range_start"], "left")
        .withColumn("is_first", (F.col("range_start") == 0) & F.coalesce(F.col("place") == F.col("first"), F.lit(False)))
    )
    plain = stated.where(F.coalesce("plain", changed)).select(*PLACE, "is_first", F.col("line").alias("record"))
    closed = (F.col("open") + F.sum(_quotes("line")).over(upto)) % 2 == 0
    numbered = (
        stated.where(~F.coalesce("plain", changed))
        .select(*PLACE, "line", "is_first", closed.alias("ends"), (F.col("open") == 0).alias("clean"))
        .withColumn("starts", F.coalesce(F.lag("ends").over(in_order), F.col("clean")))
    )
    alone = numbered.where(F.col("starts") & F.col("ends")).select(*PLACE, "is_first", F.col("line").alias("record"))
    # the lines of longer records: pieces inside a range, numbered by the starts so far
    pieces = (
        numbered.where(~(F.col("starts") & F.col("ends")))
        .withColumn("piece", F.sum(F.col("starts").cast("long")).over(upto))
        .groupBy("file", "range_start", "piece")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "line"))).alias("p"),
            F.bool_or("is_first").alias("is_first"),
            F.bool_or("ends").alias("ends"),
            F.bool_or("starts").alias("starts"),
        )
        .select(
            "file",
            "range_start",
            F.col("p")[0]["place"].alias("place"),
            "is_first",
            F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("record"),
            "starts",
            "ends",
        )
    )
    inside = pieces.where(F.col("starts") & F.col("ends")).select(*PLACE, "is_first", "record")
    # records that cross ranges: the open end of a range, whole ranges inside a field, and the rest
    in_file = Window.partitionBy("file").orderBy("range_start", "place").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("p")[0]
    crossing = (
        pieces.where(~(F.col("starts") & F.col("ends")))
        .withColumn("chain", F.sum(F.col("starts").cast("long")).over(in_file))
        .groupBy("file", "chain")
        .agg(F.sort_array(F.collect_list(F.struct("range_start", "place", "is_first", "record"))).alias("p"))
        .select(
            "file",
            *[first[c].alias(c) for c in ("range_start", "place", "is_first")],
            F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"),
        )
    )
    record = F.col("record")
    unended = F.when(F.endswith(record, F.lit("\r")), F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)
    unmarked = F.when(F.col("is_first") & F.startswith(record, F.lit("\ufeff")), F.substring(record, 2, 2**31 - 1))
    return (
        plain.unionByName(alone)
        .unionByName(inside)
        .unionByName(crossing)
        .withColumn("record", unended)
        .withColumn("record", unmarked.otherwise(record))
        .where("record <> ''")
    )


def parsed(records: DataFrame, schema: StructType, header: list[str], options: dict[str, str], file_as: str | None = None) -> DataFrame:
    """The records' fields as columns of ``schema`` (text), without the header record of each file.

    ``file_as``: name of a further column, the file's hash.

    A file's first record is its header and must hold the names in ``header``, in this order;
    another header is an error.
    """
    fields = F.from_csv("record", ", ".join(f"`{c}` string" for c in schema.names), options)
    rows = records.withColumn("fields", fields)
    names = F.concat_ws("\u0001", *[F.coalesce(F.col("fields")[c], F.lit("")) for c in schema.names])
    wrong = F.raise_error(F.concat(F.lit("The header differs from the other files': "), F.col("record")))
    is_data = F.when(~F.col("is_first"), F.lit(True)).otherwise(
        F.when(names == "\u0001".join(header), F.lit(False)).otherwise(wrong.cast("boolean"))
    )
    file = [F.col("file").alias(file_as)] if file_as else []
    return rows.where(is_data).select(*[F.col("fields")[c].alias(c) for c in schema.names], *file)
