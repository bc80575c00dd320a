"""Writers: message directories, checked batches, the index table, metric tables."""

from pagevane.sinks.index import (
    append_index,
    create_index,
    index_dim,
    index_exists,
    read_index,
    read_rejected,
)
from pagevane.sinks.tables import (
    batch_path,
    checked_path,
    emit_metric,
    emit_metrics,
    write_checked,
    write_messages,
    write_metrics,
    write_trace,
)

__all__ = [
    "append_index",
    "batch_path",
    "checked_path",
    "create_index",
    "emit_metric",
    "emit_metrics",
    "index_dim",
    "index_exists",
    "read_index",
    "read_rejected",
    "write_checked",
    "write_messages",
    "write_metrics",
    "write_trace",
]
