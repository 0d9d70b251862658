from .checks import (
    check_primary_key, check_not_null, check_types, check_unique, check_foreign_key,
    failed_casts, outliers, outlier_bounds, repeated_keys, row_balance, schema_drift,
)
from .report import check_mart, check_table

__all__ = [
    "check_primary_key", "check_not_null", "check_types", "check_unique", "check_foreign_key",
    "failed_casts", "outliers", "outlier_bounds", "repeated_keys", "row_balance", "schema_drift",
    "check_mart", "check_table",
]
