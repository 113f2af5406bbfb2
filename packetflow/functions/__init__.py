"""Column functions."""

from packetflow.functions.columns import (
    bytes_to_text,
    count_as_int,
    epoch_millis_literal,
    epoch_seconds_to_local,
    is_known_charset,
    jvm_charsets,
    iso_local_text,
    iso_offset_to_epoch_millis,
    local_as_utc_instant,
    unsigned32,
    zero_to_null,
)

__all__ = [
    "bytes_to_text", "count_as_int", "epoch_millis_literal", "epoch_seconds_to_local",
    "is_known_charset", "jvm_charsets", "iso_local_text", "iso_offset_to_epoch_millis",
    "local_as_utc_instant", "unsigned32", "zero_to_null",
]
