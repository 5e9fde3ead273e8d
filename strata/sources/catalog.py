"""Catalog registration of lake folders as external Parquet tables.

Registration is idempotent: ``DROP TABLE IF EXISTS`` then ``CREATE TABLE
… USING PARQUET LOCATION``.  Dropping an external table keeps its files.
``publish`` is the form for tables that others read meanwhile: the table stays
and its location is switched in one step, so no reader meets a gap.
Names are always qualified (``db.table``), so no statement changes the
session's current database.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import content_digest, union_all
from strata.sources.lake import Written

# Database names of the raw and star tables.
RAW_DATABASE = "olist"
STAR_DATABASE = "olist_star"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def run_database(name: str, run: str) -> str:
    """The database of one run: concurrent runs do not meet."""
    return f"{name}__{run}"


def logical_name(database: Column) -> Column:
    """The database name without its run."""
    return F.substring_index(database, "__", 1)


def _columns(schema: StructType) -> str:
    return " (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")"


def registration_sql(
    database: str, locations: Mapping[str, str], schemas: Mapping[str, StructType] | None = None
) -> list[str]:
    """The statements that (re)register ``{table: location}`` in ``database``.

    ``schemas``: declared columns, for tables whose files hold more; by default those of the files.
    """
    statements = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    for table, location in locations.items():
        statements.append(f"DROP TABLE IF EXISTS {database}.{table}")
        columns = _columns(schemas[table]) if schemas else ""
        statements.append(
            f"CREATE TABLE {database}.{table}{columns} USING PARQUET LOCATION '{_quoted(location)}'"
        )
    return statements


def register(
    spark: SparkSession, database: str, locations: Mapping[str, str], schemas: Mapping[str, StructType] | None = None
) -> None:
    for statement in registration_sql(database, locations, schemas):
        spark.sql(statement)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish(spark: SparkSession, database: str, tables: Mapping[str, Written]) -> None:
    """Point ``{table: written folder}`` of ``database`` at new folders, each in one step.

    A table that exists with the same columns gets a new location: a query
    planned before the switch reads the old folder to its end, one planned
    after it the new folder, and none fails between.  A new table is created;
    only a table whose columns changed is dropped and created.  Call it after
    all writes, so that a failed build publishes nothing.  Sessions other than
    this one see the switch when they resolve the table anew
    (``REFRESH TABLE``, or a new session).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, written in tables.items():
        name = f"{database}.{table}"
        if spark.catalog.tableExists(name):
            if _shape(spark.table(name).schema) == _shape(written.schema):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(written.location)}'")
                continue
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=written.location, source="parquet", schema=written.schema)


def list_tables(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """``SHOW TABLES IN`` each database, stacked (K10), under the databases' logical names.

    ``SHOW TABLES`` also lists the session's temporary views under every
    database; only the registered tables of the database are kept.
    """
    listed = union_all([spark.sql(f"SHOW TABLES IN {db}") for db in databases])
    return listed.where(~F.col("isTemporary")).withColumn("namespace", logical_name(F.col("namespace")))


def table_digests(spark: SparkSession, database: str, tables: Sequence[str]) -> DataFrame:
    """(database_name, table_name, row_count, digest) of registered tables, read through the catalog."""
    frames = {t: spark.table(f"{database}.{t}") for t in tables}
    return union_all(
        [
            df.agg(
                logical_name(F.lit(database)).alias("database_name"),
                F.lit(t).alias("table_name"),
                *content_digest(df),
            )
            for t, df in frames.items()
        ]
    )


def source(spark: SparkSession, table: str, database: str = RAW_DATABASE) -> DataFrame:
    """A declared raw source read through the catalog."""
    return spark.table(f"{database}.{table}")
