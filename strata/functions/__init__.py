"""Column expressions: built-in Spark functions only, so every expression
stays inside whole-stage code generation (no Python UDFs)."""

from strata.functions.dates import (
    date_key,
    elapsed_days,
    elapsed_seconds,
    month_name,
    purchase_date,
    year_month,
)
from strata.functions.labels import id_prefix, missing_label, percent_text, thousands
from strata.functions.measures import (
    cents_of_days,
    money,
    money_sum,
    rounded_ratio,
    to_money_double,
)

__all__ = [
    "cents_of_days",
    "date_key",
    "elapsed_days",
    "elapsed_seconds",
    "id_prefix",
    "missing_label",
    "money",
    "money_sum",
    "month_name",
    "percent_text",
    "purchase_date",
    "rounded_ratio",
    "thousands",
    "to_money_double",
    "year_month",
]
