"""Location parsing, classing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.classify import has_any
from postmill.functions.text import blank_to_null, col, is_filled, join_filled

# ---- fixed values ----
WORKPLACE_TYPES = {"Remote": "remote", "Hybrid": "hybrid", "On-site": "on-site"}


def location_part(c: Column | str, position: int) -> Column:
    """Comma part 0 (city), 1 (state) or 2 (country), trimmed; later parts are ignored."""
    return F.when(is_filled(c), F.trim(F.get(F.split(col(c), ","), F.lit(position))))


def work_location_type(c: Column | str) -> Column:
    low = F.lower(col(c))
    return (
        F.when(low.contains("remote"), "remote")
        .when(low.contains("hybrid"), "hybrid")
        .when(has_any(low, ["office", "on-site", "onsite"]), "on-site")
        .otherwise("not_specified")
    )


def workplace_type(c: Column | str) -> Column:
    """Exact-case provider label; anything else is not_specified."""
    expr = F
    for label, value in WORKPLACE_TYPES.items():
        expr = expr.when(col(c) == label, value)
    return expr.otherwise("not_specified")


def remote_scope(c: Column | str) -> Column:
    low = F.lower(col(c))
    return F.when(
        low.contains("remote"),
        F.when(has_any(low, ["anywhere", "global"]), "anywhere")
        .when(low.contains("same country"), "same_country")
        .when(low.contains("same timezone"), "same_timezone")
        .otherwise("anywhere"),
    )


def format_location(city: Column, region: Column, country: Column, remote: Column) -> Column:
    """``city, region, country (Remote)``; null when nothing is known."""
    places = F.coalesce(join_filled(", ", city, region, country), F.lit(""))
    return blank_to_null(F.concat(places, F.when(remote, " (Remote)").otherwise("")))


def city_state_country(city: Column, state: Column, country: Column) -> Column:
    return join_filled(", ", city, state, country)


def city_country_or_remote(city: Column, country: Column) -> Column:
    return F.coalesce(join_filled(", ", city, country), F.lit("Remote"))
