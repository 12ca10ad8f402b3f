from marquee.functions.columns import (
    as_col,
    between_dates,
    blank_to_null,
    cast_columns,
    contains_any,
    ends_with,
    flag_name,
    has_value,
    json_field,
    not_future,
    null_sentinel,
    null_to_false,
    split_list,
    variant_field,
    without,
)
from marquee.functions.keys import scd_id, surrogate_key

__all__ = [
    "as_col", "between_dates", "blank_to_null", "cast_columns", "contains_any", "ends_with",
    "flag_name", "has_value", "json_field", "not_future", "null_sentinel", "null_to_false",
    "split_list", "variant_field", "without", "scd_id", "surrogate_key",
]
