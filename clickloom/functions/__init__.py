from clickloom.functions.hashing import poly_hash
from clickloom.functions.time import (
    calendar_day,
    display_shift,
    epoch_ms,
    format_ms,
    java_timestamp_text,
    millis,
    next_midnight_ms,
    slot_start,
    with_event_time,
)

__all__ = [
    "calendar_day",
    "display_shift",
    "epoch_ms",
    "format_ms",
    "java_timestamp_text",
    "millis",
    "next_midnight_ms",
    "poly_hash",
    "slot_start",
    "with_event_time",
]
