from tallyline.functions.dates import (
    day_of,
    dow_sunday_zero,
    minutes_between,
    parse_date_text,
    parse_time_text,
    year_month,
)
from tallyline.functions.numbers import mean, money, percent, ratio
from tallyline.functions.text import concat_nulls_as_empty, list_ids, list_length, null_if_sentinel, strip_unit

__all__ = [
    "concat_nulls_as_empty",
    "day_of",
    "dow_sunday_zero",
    "list_ids",
    "list_length",
    "mean",
    "minutes_between",
    "money",
    "null_if_sentinel",
    "parse_date_text",
    "parse_time_text",
    "percent",
    "ratio",
    "strip_unit",
    "year_month",
]
