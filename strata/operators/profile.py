"""Profiling aggregates: row counts, duplicate counts and null counts.

Each check is one aggregation over the columns it needs (Catalyst prunes
the scan to them).  Distinct counts run as a two-level aggregation with
map-side partial aggregation, so a key that holds a third of the rows is
collapsed on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> Column:
    return F.count(F.lit(1))


def distinct_key_count(columns: Sequence[str]) -> Column:
    """Distinct values of the key tuple, a NULL key counted once (like pandas).

    A struct is never NULL even when its fields are, so ``count(DISTINCT
    struct(...))`` counts a NULL key as one value, unlike ``count(DISTINCT k)``.
    """
    return F.count_distinct(F.struct(*[F.col(c) for c in columns]))


def _key_hashes(tag: int, columns: Sequence[str]) -> list[Column]:
    """128 bits of a key tuple; NULL is a value of its own, unlike any other."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(f"{tag}-{half}"), *parts).alias(f"h{half}") for half in (1, 2)]


def duplicate_counts(
    checks: Sequence[tuple[DataFrame, Mapping[int, Sequence[str]]]],
) -> DataFrame:
    """``(tag, rows, duplicates)`` of key tuples ``{tag: columns}`` over several tables at once.

    Every key becomes a tag and 128 bits of hash, and all keys of all tables
    meet in one exchange: counted per tag and hash on the map side first, so a
    key that holds a third of the rows arrives as a row a task.  A repeated NULL
    key is a duplicate.  Two of ``n`` different keys share their 128 bits with
    a chance of about ``n**2 / 2**129``.  A tag whose table is empty has no row.
    """
    tagged = union_all(
        [
            df.select(
                F.inline(
                    F.array(
                        *[F.struct(F.lit(tag).alias("tag"), *_key_hashes(tag, cols)) for tag, cols in keys.items()]
                    )
                )
            )
            for df, keys in checks
        ]
    )
    return (
        tagged.groupBy("tag", "h1", "h2")
        .count()
        .groupBy("tag")
        .agg(F.sum("count").alias("rows"), (F.sum("count") - F.count(F.lit(1))).alias("duplicates"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``__rows`` and ``<col>`` = NULL count for each column."""
    return df.agg(
        row_count(df).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
