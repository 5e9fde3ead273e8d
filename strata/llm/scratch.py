"""Intermediate tables of one run in the shared folder of the session."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from strata.session import run_dir


class Scratch:
    """Parquet tables below a fresh folder of ``spark.checkpoint.dir``.

    Writing a table cuts the lineage: a lost executor re-reads the table
    instead of recomputing what came before it.  Tables that no later plan
    reads can be dropped early.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = run_dir(spark, f"llm-{purpose}")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(taken: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``taken`` has (names compare without case)."""
    names = {c.lower() for c in taken.columns}
    while name.lower() in names:
        name = f"_{name}"
    return name


def sent(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of bounded size together with the classes of this subpackage that it needs."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(box: Broadcast):
    return pickle.loads(box.value)
