"""Typed casts, state accessors and text formatting.

Strict casts raise on bad input (ANSI mode); the lenient form gives NULL and
leaves the verdict to a data-quality rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.keys import as_column


def to_instant(value: str | Column, lenient: bool = False) -> Column:
    """ISO-8601 text to timestamp."""
    c = as_column(value)
    return F.try_to_timestamp(c) if lenient else F.to_timestamp(c)


def to_day(value: str | Column, lenient: bool = False) -> Column:
    """Text to date."""
    c = as_column(value)
    return c.try_cast("date") if lenient else F.to_date(c)


def to_amount(value: str | Column, precision: int = 18, scale: int = 2, lenient: bool = False) -> Column:
    """Number or text to a decimal amount."""
    c = as_column(value)
    target = f"decimal({precision},{scale})"
    return c.try_cast(target) if lenient else c.cast(target)


def iso_text(ts: str | Column) -> Column:
    """Timestamp to ISO text with milliseconds and zone."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def json_map(text: str | Column) -> Column:
    """JSON object text to a string map; NULL or blank text gives an empty map.

    Anything that is not an object raises.
    """
    c = F.trim(as_column(text))
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    parsed = F.from_json(c, "map<string,string>", {"mode": "FAILFAST"})
    return F.when(c.isNull() | (c == ""), empty).otherwise(parsed)


def normalized(value: str | Column, default: str) -> Column:
    """Upper-cased, trimmed setting with a default for NULL."""
    return F.upper(F.trim(F.coalesce(as_column(value), F.lit(default))))


def or_na(value: str | Column) -> Column:
    """Text form with ``N/A`` for NULL."""
    return F.coalesce(as_column(value).cast("string"), F.lit("N/A"))


def state_watermark(state_type: str | Column, state_value: str | Column) -> Column:
    """The timestamp held by WATERMARK state, else NULL."""
    # The value is only parsed when the type says it is a timestamp: a cursor
    # must not raise in ANSI mode.
    is_watermark = F.upper(as_column(state_type)) == "WATERMARK"
    return F.when(is_watermark, F.to_timestamp(F.when(is_watermark, as_column(state_value))))


def state_cursor(state_type: str | Column, state_value: str | Column) -> Column:
    """The token held by CURSOR state, else NULL."""
    return F.when(F.upper(as_column(state_type)) == "CURSOR", as_column(state_value))


def minutes_before(ts: str | Column, minutes: str | Column) -> Column:
    """``ts`` minus a non-negative number of minutes; NULL minutes means none."""
    back = F.greatest(F.coalesce(as_column(minutes), F.lit(0)), F.lit(0)).cast("int")
    return as_column(ts) - F.make_dt_interval(F.lit(0), F.lit(0), back)
