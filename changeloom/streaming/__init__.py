from changeloom.streaming.lifecycle import await_all, drain
from changeloom.streaming.progress import ProgressListener, progress_table, recorded
from changeloom.streaming.rollup import compact_rollup, read_rollup, start_rollup
from changeloom.streaming.segments import clean_segments, expire, fold_segments, merge_segments, read_segments
from changeloom.streaming.serving import compact_serving, follow_records, read_serving, start_serving
from changeloom.streaming.sinks import (
    FanOutTargets,
    FileSink,
    KafkaSink,
    fan_out,
    start_archive,
    start_dead_letters,
    start_key_values,
)
from changeloom.streaming.status import compact_status, read_status, start_status
from changeloom.streaming.tables import compact, read_upserts, start_upserts, vacuum

__all__ = [
    "FanOutTargets",
    "FileSink",
    "KafkaSink",
    "ProgressListener",
    "await_all",
    "clean_segments",
    "compact",
    "compact_rollup",
    "compact_serving",
    "compact_status",
    "drain",
    "expire",
    "fan_out",
    "fold_segments",
    "follow_records",
    "merge_segments",
    "progress_table",
    "read_rollup",
    "read_segments",
    "read_serving",
    "read_status",
    "read_upserts",
    "recorded",
    "start_archive",
    "start_dead_letters",
    "start_key_values",
    "start_rollup",
    "start_serving",
    "start_status",
    "start_upserts",
    "vacuum",
]
