"""Date readers. Bad text gives null, never an error; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.text import col

ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
NO_SECONDS = r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})$"


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 date or date-time, with ``Z`` or a numeric offset."""
    # the cast wants seconds before a zone
    full = F.regexp_replace(col(c), NO_SECONDS, "$1:00$2")
    return F.when(col(c).rlike(ISO_SHAPE), full.try_cast("timestamp"))


def iso_or_day(c: Column | str) -> Column:
    return F.coalesce(iso_timestamp(c), F.try_to_timestamp(col(c), F.lit("yyyy-MM-dd")))


def iso_or_utc_text(c: Column | str) -> Column:
    """ISO, else ``yyyy-MM-dd HH:mm:ss UTC``."""
    plain = F.regexp_replace(col(c), " UTC", "")
    return F.coalesce(iso_timestamp(c), F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss")))


def epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds as a UTC timestamp; 0 and null mean missing."""
    ms = col(c).try_cast("bigint")
    return F.when(ms != 0, F.timestamp_millis(ms))


def one_year_later(day: Column | str) -> Column:
    """Same day next year; 29 February becomes 28 February."""
    return F.add_months(col(day), 12)
