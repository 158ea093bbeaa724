"""Ordered keyword classifiers: the first group that occurs wins.

The words match as substrings on purpose ("cto" is found in "director"): that is
the contract of the labels, and it makes the order of the groups matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.text import col, is_filled

# ---- fixed values: label -> words, in order of precedence ----
EXPERIENCE_LEVELS = {
    "entry_level": ["intern", "entry", "junior"],
    "mid_level": ["mid", "associate"],
    "senior_level": ["senior", "lead", "principal"],
    "executive": ["director", "vp", "head"],
}
EMPLOYMENT_TYPES = {
    "full_time": ["full", "permanent"],
    "part_time": ["part"],
    "contract": ["contract", "temporary"],
    "internship": ["intern"],
}
MANAGEMENT_LEVELS = {
    "executive": ["ceo", "cto", "cfo", "president", "director"],
    "manager": ["manager", "head of", "lead", "supervisor"],
    "senior_individual": ["senior", "principal", "staff"],
}
EDUCATION_LEVELS = {
    "doctorate": ["phd", "doctorate"],
    "masters": ["master", "m.s."],
    "bachelors": ["bachelor", "b.s."],
    "associate": ["associate"],
}


def has_any(low: Column, words: list[str]) -> Column:
    """Any word occurs; byte search is several times faster than a regex on long texts."""
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def first_label(low: Column, labels: dict[str, list[str]], default: str) -> Column:
    """Label of the first group with a word in the (lowercase) text."""
    expr = F
    for label, words in labels.items():
        expr = expr.when(has_any(low, words), label)
    return expr.otherwise(default)


def experience_level(c: Column | str) -> Column:
    return F.when(is_filled(c), first_label(F.lower(col(c)), EXPERIENCE_LEVELS, "not_specified"))


def employment_type(c: Column | str) -> Column:
    """Employment type of a type label; the job type is the same function."""
    return F.when(is_filled(c), first_label(F.lower(col(c)), EMPLOYMENT_TYPES, "not_specified"))


def education_of(low: Column) -> Column:
    """Education level of a text that is already lowercase."""
    return F.when(is_filled(low), first_label(low, EDUCATION_LEVELS, "not_specified"))


def education_level(c: Column | str) -> Column:
    return education_of(F.lower(col(c)))


def title_and_text(title: Column | str, description: Column | str) -> Column:
    """The lowercase text the management level is read from."""
    return F.lower(
        F.concat_ws(" ", F.coalesce(col(title), F.lit("")), F.coalesce(col(description), F.lit("")))
    )


def management_of(low: Column) -> Column:
    return first_label(low, MANAGEMENT_LEVELS, "individual_contributor")


def management_level(title: Column | str, description: Column | str) -> Column:
    return management_of(title_and_text(title, description))
