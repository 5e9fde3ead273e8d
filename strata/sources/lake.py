"""Parquet lake folders: raw tables, the star schema and versioned layer tables (K1–K3)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from strata.operators import observed_digest, with_observed_digest
from strata.parallel import DEFAULT_THREADS, run_all

#: Versions of a table that stay: the published one and the one before it, whose readers may still run.
KEEP_VERSIONS = 2


#: Codec of the lake's Parquet files: smaller than snappy's, and no slower to write.
CODEC = "zstd"


@dataclass(frozen=True)
class Written:
    """A written folder with the row count and content digest taken while it was written."""

    location: str
    schema: StructType
    row_count: int
    digest: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.location)


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild of one lake table as Parquet."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_digested(df: DataFrame, path: str) -> Written:
    """``write_table`` whose own plan sums row count and digest: nothing is read again."""
    seen = Observation()
    write_table(with_observed_digest(df, seen), path)
    return Written(path, df.schema, *observed_digest(seen))


def write_tables(tables: Mapping[str, DataFrame], base: str, threads: int = DEFAULT_THREADS) -> dict[str, str]:
    """Write ``{name: df}`` below ``base`` (independent writes run side by side).

    Returns ``{name: location}``.
    """
    locations = {name: f"{base}/{name}" for name in tables}
    run_all([lambda n=name: write_table(tables[n], locations[n]) for name in tables], threads)
    return locations


def write_tables_digested(
    tables: Mapping[str, DataFrame], base: str, threads: int = DEFAULT_THREADS
) -> dict[str, Written]:
    """``write_tables`` with the content digest of every table."""
    done = run_all([lambda n=n, df=df: write_digested(df, f"{base}/{n}") for n, df in tables.items()], threads)
    return dict(zip(tables, done))


def read_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base}/{name}") for name in names}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_version() -> str:
    """A folder name that sorts after those of earlier versions."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def retire(spark: SparkSession, table_dir: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Remove all but the newest ``keep`` versions below ``table_dir``; the removed names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table_dir)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    old = [n for n in names if n.startswith("v")][:-keep]
    for name in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table_dir}/{name}"), True)
    return old
