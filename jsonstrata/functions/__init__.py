from jsonstrata.functions.names import (
    DuplicateNameError,
    clean_type,
    quoted,
    split_names,
    strip_prefix,
)
from jsonstrata.functions.scalars import (
    event_time,
    message_base_name,
    message_id,
    parse_event_time,
    upper_trimmed,
)

__all__ = [
    "DuplicateNameError",
    "clean_type",
    "event_time",
    "message_base_name",
    "message_id",
    "parse_event_time",
    "quoted",
    "split_names",
    "strip_prefix",
    "upper_trimmed",
]
