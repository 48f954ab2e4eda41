"""Scans: delimited text, Parquet, catalog tables, documents, local rows, streams."""

from .batch import (
    local_rows, preview, profile_schema, read_daily_logs, read_delimited, read_documents,
    read_multiline, read_parquet, read_table, stage_delimited,
)
from .streams import (
    log_json_stream, log_line_stream, message_stream, observation_pull, table_stream,
)

__all__ = [
    "local_rows", "log_json_stream", "log_line_stream", "message_stream",
    "observation_pull", "preview", "profile_schema", "read_daily_logs", "read_delimited",
    "read_documents", "read_multiline", "read_parquet", "read_table", "stage_delimited", "table_stream",
]
