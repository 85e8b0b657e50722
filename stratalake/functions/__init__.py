"""Scalar expressions shared by the operators."""

from stratalake.functions.keys import composite_key, hash_key, packed, packed_max, record_hash, unpacked
from stratalake.functions.values import (
    iso_text,
    json_map,
    normalized,
    or_na,
    state_cursor,
    state_watermark,
    to_amount,
    to_day,
    to_instant,
    minutes_before,
)

__all__ = [
    "composite_key",
    "hash_key",
    "packed",
    "packed_max",
    "unpacked",
    "record_hash",
    "iso_text",
    "json_map",
    "normalized",
    "or_na",
    "state_cursor",
    "state_watermark",
    "to_amount",
    "to_day",
    "to_instant",
    "minutes_before",
]
