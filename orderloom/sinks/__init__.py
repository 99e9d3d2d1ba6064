from orderloom.sinks.tables import (
    append_table,
    cluster_table,
    compact_table,
    create_database,
    drop_table,
    refresh_table,
    refresh_with_rejects,
    remove_old_versions,
)
from orderloom.sinks.topic import publish

__all__ = [
    "append_table",
    "cluster_table",
    "compact_table",
    "create_database",
    "drop_table",
    "publish",
    "refresh_table",
    "refresh_with_rejects",
    "remove_old_versions",
]
