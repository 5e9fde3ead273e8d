"""Display expressions of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's report text.
MISSING_LABEL = "(missing)"
ELLIPSIS = "…"


def missing_label(c: str | Column) -> Column:
    """NULL or empty → ``(missing)``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(MISSING_LABEL))


def id_prefix(c: str | Column, n: int = 8) -> Column:
    """First ``n`` characters of an id followed by an ellipsis."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(c.cast("string"), 1, n), F.lit(ELLIPSIS))


def thousands(c: str | Column, decimals: int = 2) -> Column:
    """``1,234.56`` style number text."""
    return F.format_number(c, decimals)


def percent_text(c: str | Column, decimals: int = 1) -> Column:
    """``12.3%`` style text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.format_number(c, decimals), F.lit("%"))
