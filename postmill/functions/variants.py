"""Reading polymorphic JSON held as VARIANT.

``try_variant_get(.., 'string')`` returns the JSON text of an object, so the
helpers below look at the node kind first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(body: Column | str) -> Column:
    """Parse JSON text once; malformed text gives null."""
    return F.try_parse_json(body)


def node(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "variant")


def kind(v: Column, path: str = "$") -> Column:
    """Node kind such as ``STRING`` or ``OBJECT<..>``; null when the key is missing."""
    return F.schema_of_variant(node(v, path))


def has(v: Column, path: str) -> Column:
    """Key is present, even when its value is JSON null."""
    return kind(v, path).isNotNull()


def is_object(v: Column, path: str = "$") -> Column:
    return F.coalesce(kind(v, path).startswith("OBJECT"), F.lit(False))


def is_string(v: Column, path: str = "$") -> Column:
    return F.coalesce(kind(v, path) == "STRING", F.lit(False))


def text(v: Column, path: str) -> Column:
    """Scalar node as text (numbers and booleans included)."""
    return F.try_variant_get(v, path, "string")


def string(v: Column, path: str) -> Column:
    """Text of a string node; null for every other kind."""
    return F.when(is_string(v, path), text(v, path))


def filled(v: Column, path: str) -> Column:
    """Scalar text, with the empty string read as missing."""
    return F.nullif(text(v, path), F.lit(""))


def array(v: Column, path: str = "$", element: str = "variant") -> Column:
    return F.try_variant_get(v, path, f"array<{element}>")


def objects(v: Column, path: str = "$") -> Column:
    """Object elements of an array node; an empty array for anything else."""
    none = F.array().cast("array<variant>")
    return F.filter(F.coalesce(array(v, path), none), lambda x: is_object(x))


def fields(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "map<string,variant>")


def truthy(v: Column, path: str) -> Column:
    """Non-empty, non-zero, non-false node."""
    t = text(v, path)
    return F.coalesce(~F.lower(t).isin("", "false", "0", "0.0", "{}", "[]"), F.lit(False))
