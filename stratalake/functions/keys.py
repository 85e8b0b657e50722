"""Surrogate keys and record hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fields stay when NULL, and times keep their microseconds.
_HASHED_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hash_key(business_key: str | Column) -> Column:
    """SHA-256 hex of the key's text form; a NULL key gives a NULL surrogate."""
    return F.sha2(as_column(business_key).cast("string"), 256)


def composite_key(*parts: str | Column, separator: str = "|") -> Column:
    """SHA-256 hex of the parts joined by ``separator``. NULL parts are skipped."""
    return F.sha2(F.concat_ws(separator, *[as_column(p).cast("string") for p in parts]), 256)


def _is_hex(text: Column) -> Column:
    return F.coalesce(F.lower(F.hex(F.unhex(text))) == text, F.lit(False))


def packed(key: str | Column) -> Column:
    """A text key as a struct that takes half the room while it travels, if it is hex digits as surrogate keys are; any other text stays as it is."""
    text = as_column(key)
    return F.struct(F.when(_is_hex(text), F.unhex(text)).alias("bytes"), F.when(~_is_hex(text), text).alias("text"))


def unpacked(key: str | Column) -> Column:
    key = as_column(key)
    return F.coalesce(F.lower(F.hex(key["bytes"])), key["text"])


def packed_max(key: str | Column) -> Column:
    """``max`` of a text key whose values travel packed: hex digits order as their bytes do."""
    text = as_column(key)
    greatest = F.max(F.when(_is_hex(text), F.unhex(text)))
    return F.greatest(F.lower(F.hex(greatest)), F.max(F.when(~_is_hex(text), text)))


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over a JSON rendering that keeps NULLs and field names apart.

    ``('a', NULL)`` and ``(NULL, 'a')`` differ, which plain concatenation would
    not guarantee.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    return F.sha2(F.to_json(row, _HASHED_JSON), 256)
