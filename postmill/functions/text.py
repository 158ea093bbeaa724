"""Text, hash, number and formatting rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----
SNIPPET_CHARS = 500
ID_CHARS = 12
YEARS_PATTERN = r"(\d+)\+?\s*years?"
JOB_COUNT_PATTERN = r"(?i)(\d[\d,]*)\s*JOBS?\s*FOUND"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def is_filled(c: Column | str) -> Column:
    """True for a non-empty string, false (never null) otherwise."""
    return F.coalesce(F.length(col(c)) > 0, F.lit(False))


def snippet(c: Column | str) -> Column:
    return F.when(is_filled(c), F.substring(col(c), 1, SNIPPET_CHARS))


def text_hash(c: Column | str) -> Column:
    """md5 hex of the whole text, null when it is empty."""
    return F.when(is_filled(c), F.md5(col(c)))


def short_id(*parts: Column | str) -> Column:
    whole = F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])
    return F.substring(F.md5(whole), 1, ID_CHARS)


def clean_text(c: Column | str) -> Column:
    """Collapse every run of Unicode white space to one space and trim."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))


def years_of(low: Column) -> Column:
    """First number before "year(s)" in a lowercase text; the word is sought first, as most
    texts lack it and a regex over them is slow.
    """
    digits = F.when(low.contains("year"), F.regexp_extract(low, YEARS_PATTERN, 1))
    return blank_to_null(digits).try_cast("int")


def first_years_match(c: Column | str) -> Column:
    """First number written before "year(s)"; in "3-5 years" that is 5."""
    return years_of(F.lower(col(c)))


def join_filled(separator: str, *parts: Column | str) -> Column:
    """Join the non-empty parts; null when there is none."""
    return blank_to_null(F.concat_ws(separator, *[blank_to_null(p) for p in parts]))


def percent(share: Column) -> Column:
    """0.1234 -> '12.3%' (half-even on the exact value)."""
    return F.concat(F.format_number(share * 100, 1), F.lit("%"))


def total_jobs_in_text(c: Column | str) -> Column:
    digits = F.regexp_extract(col(c), JOB_COUNT_PATTERN, 1)
    return blank_to_null(F.regexp_replace(digits, ",", "")).try_cast("bigint")


def page_count(total: Column | str, page_size: int = 20) -> Column:
    return F.greatest(F.lit(1), F.ceil(col(total) / page_size)).cast("bigint")


def first_name(c: Column | str) -> Column:
    words = F.split(F.trim(F.coalesce(col(c), F.lit(""))), r"\s+")
    return F.coalesce(blank_to_null(F.get(words, F.lit(0))), F.lit("Valued"))


def last_name(c: Column | str) -> Column:
    words = F.split(F.trim(F.coalesce(col(c), F.lit(""))), r"\s+")
    rest = F.concat_ws(" ", F.slice(words, 2, F.greatest(F.size(words), F.lit(1))))
    return F.coalesce(blank_to_null(rest), F.lit("Client"))
