"""Ordering and top-k.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each task
keeps its own k best rows and only those are merged, so a top-k never
sorts or moves the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows by ``order`` (which should end in a unique tie-break)."""
    return df.orderBy(*order).limit(k)
