from .versioned import ChangedMeanwhile, VersionedTable
from .writers import (
    save_table, upsert_partitions, write_current, write_one_file_each, write_partitions,
    write_quarantine, write_snapshot,
)

__all__ = [
    "ChangedMeanwhile", "VersionedTable", "save_table", "upsert_partitions", "write_current", "write_one_file_each",
    "write_partitions", "write_quarantine", "write_snapshot",
]
