from marquee.operators.joins import (
    anti_by_registry,
    append_new,
    array_match_join,
    distinct_elements,
    distinct_values,
    fanout_join,
    flatten,
    groups_of_size,
    join_feeds,
    left_lookup,
    rated_titles,
    skew_join,
    unique_rows,
)
from marquee.operators.onehot import one_hot
from marquee.operators.scd2 import (
    META_COLS,
    as_of,
    as_of_join,
    current,
    dedupe_latest,
    scd2_history,
    snapshot_check,
    snapshot_timestamp,
)

__all__ = [
    "anti_by_registry", "append_new", "array_match_join",
    "distinct_elements", "distinct_values", "fanout_join", "flatten",
    "groups_of_size", "join_feeds", "left_lookup", "rated_titles", "skew_join", "unique_rows",
    "one_hot", "META_COLS", "as_of", "as_of_join", "current", "dedupe_latest",
    "scd2_history", "snapshot_check", "snapshot_timestamp",
]
