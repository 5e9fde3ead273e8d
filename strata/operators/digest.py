"""Order-free digest of a table's content, to compare written tables by value.

The digest is a sum over rows, so it can be taken anywhere: by an aggregate
over a table (``content_digest``), or while the table is written, as observed
sums of the writer's own plan that merge over tasks (``with_observed_digest``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

HEX_DIGITS = 12
#: Text of fractions: eight decimal places.
FRACTION = "decimal(28,8)"
#: A row's value is summed in two halves of this many bits, which stay exact in a long for 2**39 rows.
HALF = 24
_VALUE = "__strata_digest"


def _fraction(value: Column) -> Column:
    """``value.cast(FRACTION)``, over whole 10**-8 parts in a long where that surely rounds alike.

    Below 10**7 a double's text and its product with 10**8 are off by less than
    0.16 parts together, so a product within 0.25 of a whole number rounds to
    it.  The cast through the double's text, for all others, takes longer.
    """
    parts = value.cast("double") * F.lit(1e8)
    whole = F.rint(parts)
    sure = (F.abs(whole) < F.lit(1e15)) & (F.abs(parts - whole) < F.lit(0.25))
    return F.when(sure, (whole.cast("long").cast("decimal(18,0)") * F.lit(Decimal("1E-8"))).cast(FRACTION)).otherwise(value.cast(FRACTION))


def _text(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        value = _fraction(value)
    return F.coalesce(value.cast("string"), F.lit("~"))


def _row_value(df: DataFrame) -> Column:
    """The first hex digits of the row text's MD5, as a number."""
    row = F.concat_ws("|", *[_text(df, c) for c in sorted(df.columns)])
    return F.conv(F.substring(F.md5(row), 1, HEX_DIGITS), 16, 10).cast("long")


def _sums(value: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.shiftright(value, HALF)), F.lit(0)).alias("high"),
        F.coalesce(F.sum(value.bitwiseAND((1 << HALF) - 1)), F.lit(0)).alias("low"),
    ]


def content_digest(df: DataFrame) -> list[Column]:
    """Aggregates ``row_count`` and ``digest``: the sum over rows of the row values."""
    rows, high, low = _sums(_row_value(df))
    total = high.cast("decimal(38,0)") * F.lit(1 << HALF) + low
    return [rows, total.cast("decimal(38,0)").cast("string").alias("digest")]


def with_observed_digest(df: DataFrame, observation: Observation) -> DataFrame:
    """``df`` whose next action also sums its row count and digest into ``observation``.

    Each result task's sums count once, however often the task was tried, so
    an action that writes ``df`` leaves the digest of what it wrote without
    reading it again.
    """
    return (
        df.withColumn(_VALUE, _row_value(df)).observe(observation, *_sums(F.col(_VALUE))).drop(_VALUE)
    )


def observed_digest(observation: Observation) -> tuple[int, str]:
    """``(row_count, digest)`` of the finished action."""
    got = observation.get
    return got["row_count"], str((got["high"] << HALF) + got["low"])
