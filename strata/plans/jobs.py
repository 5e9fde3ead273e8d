"""Jobs that write the lake: CSV ingest, the star-schema build, catalog
registration and the layered medallion build.

Everything written goes below a fresh folder of the shared root named by
``spark.checkpoint.dir`` (see ``strata.session.run_dir``), never to a
machine-local folder, and every write is an idempotent overwrite, so a
re-run (or a retried stage after a lost executor) replaces its output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import union_all
from strata.plans import medallion
from strata.plans.medallion import STAR_TABLES, Lake
from strata.session import run_dir
from strata.sources import catalog, csv, lake
from strata.sources.fixtures import RAW_TABLES
from strata.sources.schemas import LANDING_FILES, RETAIL_SCHEMAS


def ingest_tables(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    tables: tuple[str, ...] = RAW_TABLES,
    schemas: Mapping[str, StructType] | None = None,
) -> tuple[str, DataFrame]:
    """Land ``tables`` as CSV, ingest them to Parquet; returns (raw_dir, registry).

    ``schemas``: the declared types, by default those of ``raw`` itself.
    """
    root = run_dir(spark, "ingest")
    files = [f for f in LANDING_FILES if f.table in tables]
    csv.land_tables({t: raw[t] for t in tables}, f"{root}/landing", files)
    declared = schemas or {t: raw[t].schema for t in tables}
    registry = csv.ingest(spark, f"{root}/landing", f"{root}/raw", declared, files)
    return f"{root}/raw", registry


def write_star(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    star_dir: str,
    stage_dir: str | None = None,
) -> dict[str, lake.Written]:
    """Build and write the nine star tables (K2), with the digests of what was written.

    ``silver_orders`` feeds five of them.  When the sources are a computed
    lineage it is written once to ``stage_dir`` and read back, so the order
    enrichment runs once instead of once per table; over written raw tables
    it is a pruned scan of the orders and needs no stage.
    """
    models = Lake(sources)
    if stage_dir:
        stage = f"{stage_dir}/silver_orders"
        lake.write_table(models.model("silver_orders"), stage)
        models = Lake(sources, pinned={"silver_orders": spark.read.parquet(stage)})
    return lake.write_tables_digested({t: models.model(t) for t in STAR_TABLES}, star_dir)


@dataclass(frozen=True)
class Registration:
    """Raw and star tables of one run, registered in databases of their own."""

    raw_database: str
    star_database: str
    raw_tables: Mapping[str, lake.Written]
    star_tables: Mapping[str, lake.Written]

    def register(self, spark: SparkSession) -> None:
        """(Re)register the written folders; no table is written again (K7–K9)."""
        catalog.publish(spark, self.raw_database, self.raw_tables)
        catalog.publish(spark, self.star_database, self.star_tables)


def register_lake(spark: SparkSession, raw: Mapping[str, DataFrame]) -> Registration:
    """Write raw and star tables and register them in the catalog (K7–K9).

    The raw tables are written side by side and registered; the star is
    then built from the registered raw tables (as the star job reads raw
    Parquet), so its lineage starts at written tables: a lost executor
    during the star writes re-reads raw Parquet, not the upstream sources.
    """
    root = run_dir(spark, "catalog")
    run = root.rsplit("-", 1)[1]
    raw_database = catalog.run_database(catalog.RAW_DATABASE, run)
    raw_tables = lake.write_tables_digested(raw, f"{root}/raw")
    catalog.publish(spark, raw_database, raw_tables)
    written = {name: catalog.source(spark, name, raw_database) for name in raw_tables}
    star_tables = write_star(spark, written, f"{root}/star")
    done = Registration(raw_database, catalog.run_database(catalog.STAR_DATABASE, run), raw_tables, star_tables)
    catalog.publish(spark, done.star_database, star_tables)
    return done


def star_roundtrip(spark: SparkSession, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Write the star schema to Parquet and digest it (K2); row counts are read back.

    The digests are sums of the writes themselves; the count of the files read
    back comes from their footers.
    """
    root = run_dir(spark, "star")
    written = write_star(spark, raw, f"{root}/star", f"{root}/stage")
    back = lake.read_tables(spark, f"{root}/star", STAR_TABLES)
    return union_all(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(written[name].digest).alias("digest"),
            )
            for name, df in back.items()
        ]
    )


def medallion_build(spark: SparkSession, raw: Mapping[str, DataFrame], layers: Sequence[str | None] = (None,)):
    """Materialize the 26 models, or layer after layer, in a run's own databases; the last inventory."""
    root = run_dir(spark, "medallion")
    databases = medallion.run_databases(root.rsplit("-", 1)[1])
    for layer in layers:
        built = medallion.build(spark, raw, f"{root}/lake", layer=layer, databases=databases)
    return built


def publish_reports(
    spark: SparkSession,
    reports: Mapping[str, DataFrame],
    out_dir: str | None = None,
) -> dict[str, str]:
    """Report sink (K11): write every report section as its own Parquet table; their locations.

    Sections are independent and written side by side.
    """
    return lake.write_tables(dict(reports), out_dir or f"{run_dir(spark, 'reports')}/reports")


def run_from_landing(
    spark: SparkSession,
    landing_dir: str,
    root: str | None = None,
    schemas: Mapping[str, StructType] = RETAIL_SCHEMAS,
) -> DataFrame:
    """The whole lake from a folder of landing CSVs: ingest → register → build.

    Ingests every landing file present (declared schemas, default: the
    retail schemas), registers the raw tables as the catalog sources, then
    builds the bronze, silver and gold models whose sources are there.
    Returns the model inventory; the data tests and KPIs then read
    ``Lake.from_catalog(spark)``.
    """
    root = root or run_dir(spark, "lake")
    registry = csv.ingest(spark, landing_dir, f"{root}/raw", schemas)
    present = [r["table_name"] for r in registry.select("table_name").collect()]  # nine rows at most
    catalog.register(spark, catalog.RAW_DATABASE, {t: f"{root}/raw/{t}" for t in present}, schemas)
    sources = {t: catalog.source(spark, t) for t in present}
    return medallion.build(spark, sources, f"{root}/lake")
