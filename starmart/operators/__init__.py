from .columns import (
    add_calendar, add_constant, drop_sparse, normalise_names, project, rename,
    rename_positional, replace_columns, split_columns,
)
from .joins import (
    city_of_port, climate_by_arrival, code_text, enrich_countries, enrich_places, join_on_uid,
    join_places, lookup, matched_rows, orphan_rows, orphans,
)
from .kept import Bracketing, bracketing, column_profiles, null_shares, refreshed_profiles
from .keys import dense_id, number_staged, require_unique, sparse_id, tag_rows
from .prefilter import KeyFilter, key_filter
from .profile import duplicate_rows, profile, row_count, sparse_columns, value_range
from .quantiles import exact_quantiles
from .rows import (
    dedupe, dedupe_report, distinct_rows, drop_missing, equal_to, in_range, last_wins,
    missing_report, survivor_order,
)
from .sketches import distinct_sketches, estimated_distinct, merged_sketches, refreshed_sketches

__all__ = [
    "Bracketing", "bracketing", "column_profiles", "null_shares", "refreshed_profiles", "KeyFilter", "key_filter",
    "distinct_sketches", "estimated_distinct", "merged_sketches", "refreshed_sketches",
    "add_calendar", "add_constant", "drop_sparse", "normalise_names", "project", "rename",
    "rename_positional", "replace_columns", "split_columns", "city_of_port", "climate_by_arrival",
    "code_text", "enrich_countries", "enrich_places", "join_on_uid", "join_places", "lookup",
    "matched_rows", "orphan_rows", "orphans", "dense_id", "number_staged",
    "require_unique", "sparse_id", "tag_rows", "duplicate_rows", "profile", "row_count", "sparse_columns", "value_range",
    "exact_quantiles", "dedupe", "dedupe_report", "distinct_rows", "drop_missing", "equal_to",
    "in_range", "last_wins", "missing_report", "survivor_order",
]
