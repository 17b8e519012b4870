"""Column expressions: built-in functions only, so whole-stage codegen holds."""

from stratalake.functions.dates import (
    date_parts,
    date_text,
    day_first_date,
    day_of,
    iso_date,
    iso_timestamp,
    month_label,
    month_label_date,
    month_start,
    price_timestamp,
)
from stratalake.functions.messages import parse_records, record_json, records_json
from stratalake.functions.numbers import (
    decimal_comma,
    fixed_mean,
    fixed_sum,
    numeric,
    without_nan,
)
from stratalake.functions.states import state_code

__all__ = [
    "date_parts",
    "date_text",
    "day_first_date",
    "day_of",
    "decimal_comma",
    "fixed_mean",
    "fixed_sum",
    "iso_date",
    "iso_timestamp",
    "month_label",
    "month_label_date",
    "month_start",
    "numeric",
    "parse_records",
    "price_timestamp",
    "record_json",
    "records_json",
    "state_code",
    "without_nan",
]
