"""Relational building blocks composed from DataFrame operations."""

from strata.operators.dedupe import distinct_rows, latest_per_key
from strata.operators.digest import content_digest, observed_digest, with_observed_digest
from strata.operators.joins import enrich_bounded
from strata.operators.profile import distinct_key_count, duplicate_counts, null_counts, union_all
from strata.operators.topk import top_k

__all__ = [
    "content_digest",
    "distinct_key_count",
    "distinct_rows",
    "duplicate_counts",
    "enrich_bounded",
    "latest_per_key",
    "null_counts",
    "observed_digest",
    "top_k",
    "union_all",
    "with_observed_digest",
]
