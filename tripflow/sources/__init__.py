from tripflow.sources.fixture import load_trips, trips_from_lineitem
from tripflow.sources.io import (
    SchemaError,
    check_schema,
    committed,
    land,
    content_checksum,
    local_frame,
    preview,
    read_layer,
    read_merged,
    small_result,
    verify_write,
    write_layer,
)
from tripflow.sources.layout import Layout

__all__ = [
    "Layout",
    "SchemaError",
    "check_schema",
    "committed",
    "content_checksum",
    "land",
    "load_trips",
    "local_frame",
    "preview",
    "read_layer",
    "read_merged",
    "small_result",
    "trips_from_lineitem",
    "verify_write",
    "write_layer",
]
