from orderloom.sources.files import read_landing, read_raw_csv, read_raw_csv_with_rejects
from orderloom.sources.tables import list_columns, preview, read_table
from orderloom.sources.topic import Topic, read_topic, stream_topic

__all__ = [
    "Topic",
    "list_columns",
    "preview",
    "read_landing",
    "read_raw_csv",
    "read_raw_csv_with_rejects",
    "read_table",
    "read_topic",
    "stream_topic",
]
