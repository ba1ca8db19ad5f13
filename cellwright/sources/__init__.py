"""Readers, partitioned sinks and storage maintenance."""

from .commits import CommitLog, Files  # noqa: F401
from .compaction import compact, planned, recover  # noqa: F401
from .footers import column_footers, footers, list_files  # noqa: F401
from .keyed import KeyedTable  # noqa: F401
from .readers import path_exists, read_annotated_csv, read_recording, read_store, scoped, with_source_file  # noqa: F401
from .sinks import merge_current, open_folders, partition_columns, publish_hot, read_hot, with_event_date, write_store  # noqa: F401
from .storage import file_intervals, file_stats, layout_sizes, retention, storage_stats, trim_store, wire_ratio  # noqa: F401
