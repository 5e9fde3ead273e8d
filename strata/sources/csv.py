"""CSV landing and ingest: typed CSV → Parquet.

Files are parsed as RFC 4180: fields may be quoted, a quote inside a
quoted field is doubled, and (for the free-text table) a quoted field may
span lines.  Record borders of that table are found by quote parity
(``strata.sources.records``), so one file is read by many tasks.

Columns are bound by the names in the header, whatever their order, and
every file's header is checked against them.  Cells are read as text and
cast, so a malformed cell becomes NULL and is counted.  An empty cell, quoted
or not, is NULL.

A row with malformed cells carries them in its own file, in a further column
that is null in all other rows and that the declared schema leaves out; the
table of rejected cells is taken from there, so the landing is read once.
A manifest of the landed files lets the next ingest pass over tables whose
files have not changed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators import content_digest, union_all
from strata.parallel import DEFAULT_THREADS, run_all
from strata.sources import lake, records
from strata.sources.schemas import LANDING_FILES, RETAIL_SCHEMAS, LandingFile

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CELL_OPTIONS = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
#: Column of a raw file that holds a row's malformed cells; no reader by the declared schema sees it.
REJECTED = "_rejected"
REJECTED_TYPE = "struct<file: bigint, record: string, cells: array<struct<column_name: string, cell: string>>>"
REJECTS = "rejected_cells"
MANIFEST = "landed_files"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str) -> None:
    """Land a DataFrame as a headed, RFC 4180 quoted CSV dataset, a file per partition."""
    (
        df.write.mode("overwrite")
        .options(**CSV_OPTIONS, timestampNTZFormat=TIMESTAMP_FORMAT, timestampFormat=TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_text_cells(
    spark: SparkSession, path: str, schema: StructType, multiline: bool = False, file_as: str | None = None
) -> DataFrame:
    """The declared columns of a landing CSV as text, bound by header name.

    Other columns are left out; a declared one that is missing is an error,
    as is a file whose header differs from the others'.  ``file_as``: name of
    a further column, the hash of the row's file.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multiline).lower()}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    text = StructType([StructField(c, StringType(), True) for c in header])
    if multiline:
        cells = records.parsed(records.records(spark, path), text, header, CELL_OPTIONS, file_as)
        return cells.select(*schema.names, *([file_as] if file_as else []))
    cells = spark.read.schema(text).options(**options, enforceSchema="false").csv(path)
    return cells.select(*schema.names, *([records.file_hash().alias(file_as)] if file_as else []))


def _typed(field: StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def _is_bad(field: StructField) -> Column:
    """Whether a cell is text that its declared type does not take."""
    return F.col(field.name).isNotNull() & _typed(field).isNull()


def _malformed(schema: StructType) -> Column:
    """How many cells of a row are malformed."""
    bad = [_is_bad(f).cast("long") for f in schema if f.dataType != StringType()]
    return reduce(Column.__add__, bad, F.lit(0).cast("long"))


def _rejected(schema: StructType, file: str) -> Column:
    """File, record (its declared cells as JSON) and malformed cells of a row; null where none is malformed."""
    cells = [
        F.when(_is_bad(f), F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("cell")))
        for f in schema
        if f.dataType != StringType()
    ]
    if not cells:
        return F.lit(None).cast(REJECTED_TYPE)
    bad = F.filter(F.array(*cells), lambda c: c.isNotNull())
    record = F.to_json(F.struct(*schema.names))
    return F.when(_malformed(schema) > 0, F.struct(F.col(file).alias("file"), record.alias("record"), bad.alias("cells")))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multiline: bool = False,
    observation: Observation | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Read a landing CSV with a declared schema (no inference); malformed cells are NULL.

    ``observation`` gets ``malformed``, the count of those cells, when the
    result is written.  ``rejects`` adds the column ``REJECTED``, which holds
    the malformed cells of a row.
    """
    if rejects and REJECTED in schema.names:
        raise ValueError(f"{path}: a declared column is named {REJECTED}")
    cells = read_text_cells(spark, path, schema, multiline, REJECTED if rejects else None)
    if observation is not None:
        cells = cells.observe(observation, F.coalesce(F.sum(_malformed(schema)), F.lit(0)).alias("malformed"))
    typed = [_typed(f).alias(f.name) for f in schema]
    return cells.select(*typed, *([_rejected(schema, REJECTED).alias(REJECTED)] if rejects else []))


def is_missing(err: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (err.getCondition() or "") or "Path does not exist" in str(err)


def land_tables(
    tables: Mapping[str, DataFrame],
    landing_dir: str,
    files: Sequence[LandingFile] = LANDING_FILES,
    threads: int = DEFAULT_THREADS,
) -> None:
    """Write each table as its landing CSV under ``landing_dir``."""
    run_all(
        [
            lambda f=f: write_csv(tables[f.table], f"{landing_dir}/{f.file_name}")
            for f in files
            if f.table in tables
        ],
        threads,
    )


def raw_table(spark: SparkSession, raw_dir: str, table: str, schema: StructType) -> DataFrame:
    """An ingested table, by its declared columns."""
    return spark.read.schema(schema).parquet(f"{raw_dir}/{table}")


def rejected_cells(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``(table_name, file_name, record, column_name, cell)``: every malformed cell of the ingested files.

    ``record``: the declared cells of its row as JSON; two rows that are equal
    in a file are two rows here.
    """
    return spark.read.parquet(f"{raw_dir}/{REJECTS}")


def _rejects_of(spark: SparkSession, landing_dir: str, raw_dir: str, file: LandingFile) -> DataFrame:
    """The rejected cells of one table, from its written rows; the landing is only listed."""
    held = spark.read.schema(f"{REJECTED} {REJECTED_TYPE}").parquet(f"{raw_dir}/{file.table}")
    names = _listing(spark, f"{landing_dir}/{file.file_name}").select("file", "file_name")
    return (
        held.where(F.col(REJECTED)["file"].isNotNull())
        .select(f"{REJECTED}.*")
        .join(names, "file", "left")
        .select(F.lit(file.table).alias("table_name"), "file_name", "record", F.explode("cells").alias("c"))
        .select("table_name", "file_name", "record", "c.*")
    )


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """``(file, file_name, length, modified)`` of landed files; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(
        records.file_hash().alias("file"),
        F.col("_metadata.file_path").alias("file_name"),
        "length",
        F.unix_millis("modificationTime").alias("modified"),
    )


def _read_manifest(spark: SparkSession, raw_dir: str, table: str) -> Row | None:
    try:
        return spark.read.parquet(f"{raw_dir}/{MANIFEST}/{table}").first()
    except AnalysisException as err:
        if is_missing(err):
            return None
        raise


def _ingest_file(
    spark: SparkSession, landing_dir: str, raw_dir: str, file: LandingFile, schema: StructType
) -> tuple[LandingFile, int, bool] | None:
    """(file, malformed cells, whether it was read) of one landing file; None where it is absent.

    The manifest goes before the table is written and comes back after it, so
    a table whose write broke off is never taken for a whole one.  It holds
    the listing from before the read: a file that changes meanwhile is read
    again by the next ingest.
    """
    path = f"{landing_dir}/{file.file_name}"
    try:
        listing = _listing(spark, path)
        landed = listing.agg(*content_digest(listing)).first()
        old = _read_manifest(spark, raw_dir, file.table)
        state = {**landed.asDict(), "declared": schema.json()}
        if old and all(old[k] == v for k, v in state.items()):
            return file, old["malformed"], False
        seen = Observation(f"ingest_{file.table}")
        df = read_csv(spark, path, schema, file.multiline, seen, rejects=True)
    except AnalysisException as err:
        if is_missing(err):
            return None  # skip an absent file
        raise
    manifest = f"{raw_dir}/{MANIFEST}/{file.table}"
    lake.remove(spark, manifest)
    lake.write_table(df, f"{raw_dir}/{file.table}")
    malformed = seen.get["malformed"]
    row = [F.lit(v).alias(k) for k, v in {**state, "malformed": malformed}.items()]
    lake.write_table(spark.range(1).coalesce(1).select(*row), manifest)
    return file, malformed, True


def ingest(
    spark: SparkSession,
    landing_dir: str,
    raw_dir: str,
    schemas: Mapping[str, StructType] = RETAIL_SCHEMAS,
    files: Sequence[LandingFile] = LANDING_FILES,
    threads: int = DEFAULT_THREADS,
) -> DataFrame:
    """Convert every landing CSV to a Parquet table ``{raw_dir}/{table}``.

    A missing landing directory is an error; a missing file is skipped.
    Returns the registry of loaded tables (table_name, file_name, row_count,
    malformed_cells), with rows counted from the written Parquet.  Read the
    tables with ``raw_table`` and the malformed cells with ``rejected_cells``.

    Ingesting into the same ``raw_dir`` again reads only tables whose landed
    files (names, lengths, modification times) or declared schema differ from
    the last time; the others stay as they are.
    """
    try:
        spark.read.format("text").load(landing_dir)
    except AnalysisException as err:
        if is_missing(err):
            raise FileNotFoundError(f"landing directory not found: {landing_dir}") from err
        raise
    done = run_all([lambda f=f: _ingest_file(spark, landing_dir, raw_dir, f, schemas[f.table]) for f in files], threads)
    present = [d for d in done if d]
    if not present:
        raise FileNotFoundError(f"no landing file found in {landing_dir}")
    if any(read for _, _, read in present):
        none = spark.createDataFrame([], "table_name string, file_name string, record string, column_name string, cell string")
        bad = [_rejects_of(spark, landing_dir, raw_dir, f) for f, malformed, _ in present if malformed]
        lake.write_table(union_all([none, *bad]), f"{raw_dir}/{REJECTS}")
    return union_all(
        [
            spark.read.parquet(f"{raw_dir}/{f.table}").agg(
                F.lit(f.table).alias("table_name"),
                F.lit(f.file_name).alias("file_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(malformed).cast("long").alias("malformed_cells"),
            )
            for f, malformed, _ in present
        ]
    )
