from .aligned import Layout, UnevenBuckets, append_aligned, layout_of, read_aligned, write_aligned
from .stage import stage
from .tables import (
    create_table_sql, refresh_partitions, spread_for, write_bucketed, write_csv,
    write_table,
)
from .versions import (
    current_version, files_of, key_ranges, look_up, point_to, publish, read_files, remove_unused, repeated_keys,
)

__all__ = [
    "Layout", "UnevenBuckets", "append_aligned", "layout_of", "read_aligned", "write_aligned",
    "current_version", "files_of", "key_ranges", "look_up", "point_to", "publish", "read_files", "remove_unused", "repeated_keys",
    "stage", "create_table_sql", "refresh_partitions", "spread_for",
    "write_bucketed", "write_csv", "write_table",
]
