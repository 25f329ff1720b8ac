from changeloom.sources.archive import clean_archive, merge_archive
from changeloom.sources.filelog import FileLog
from changeloom.sources.files import (
    read_archive,
    read_dead_letters,
    read_key_values,
    read_table,
    stream_table,
)
from changeloom.sources.kafka import Broker, read_changes
from changeloom.sources.layout import write_indexed, write_sorted

__all__ = [
    "Broker",
    "FileLog",
    "clean_archive",
    "merge_archive",
    "read_archive",
    "read_changes",
    "read_dead_letters",
    "read_key_values",
    "read_table",
    "stream_table",
    "write_indexed",
    "write_sorted",
]
