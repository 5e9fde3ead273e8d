"""Deterministic de-duplication.

``latest_per_key`` keeps one row per key: the newest by a timestamp, NULL
timestamps losing, then a total tie-break.  It is written as
``row_number() = 1``, which Spark plans as a *partial* ``WindowGroupLimit``
before the shuffle and a final one after it: every map task forwards at most
one row per key, so a key that holds a third of all rows still reaches its
reducer as one row per map task, not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__strata_rn"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per ``keys``: latest ``ts`` (NULL loses), then ``tie_break`` ascending."""
    order: list[Column] = [F.col(ts).desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in tie_break if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full-row de-duplication over ``columns`` (all when omitted)."""
    if columns:
        df = df.select(*columns)
    return df.distinct()
