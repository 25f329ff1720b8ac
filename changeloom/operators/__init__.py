from changeloom.operators.envelope import (
    after_images,
    rejects,
    route,
    route_counts,
    split,
    unreadable_envelopes,
)
from changeloom.operators.join import heavy_keys, lookup
from changeloom.operators.keyvalue import from_key_value, to_key_value
from changeloom.operators.serving import null_defaults, serving_projection, serving_table
from changeloom.operators.status import stamp_status
from changeloom.operators.upsert import fold, latest, latest_stream, retain, retained_latest

__all__ = [
    "after_images",
    "fold",
    "from_key_value",
    "heavy_keys",
    "latest",
    "latest_stream",
    "lookup",
    "null_defaults",
    "rejects",
    "retain",
    "retained_latest",
    "route",
    "route_counts",
    "serving_projection",
    "serving_table",
    "split",
    "stamp_status",
    "to_key_value",
    "unreadable_envelopes",
]
