"""Enrichment of a frame that is small by construction.

Joins in the library are written plainly and planned by Catalyst and AQE:
static size estimates and measured shuffle sizes decide on broadcasts, and
skewed partitions are split.  The one hint is for the keys of a ``limit(k)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows that the keys of an enrichment may have.
MOST_KEYS = 10_000


def enrich_bounded(best: DataFrame, k: int, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach ``table`` columns to the first ``k`` rows of ``best`` (a sorted or limited frame).

    The limit is applied here, so the broadcast keys are ``k`` rows at most.
    ``table`` is filtered by a broadcast semi-join on them (a map-only pass),
    and the remaining rows are joined back; every row of ``best`` stays in a
    left join.
    """
    if not 0 < k <= MOST_KEYS:
        raise ValueError(f"an enrichment takes 1 to {MOST_KEYS} rows, not {k}")
    best = best.limit(k)
    keys = F.broadcast(best.select(key).distinct())
    return best.join(table.join(keys, key, "left_semi"), key, how)
