"""Spans found in a text and the digests that queries derive from them.

A span is (kind, start, end): code points, end exclusive.
"""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def in_order(spans: list[Span], kinds: list[str]) -> list[Span]:
    """By start, then kind in the order of ``kinds``."""
    place = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], place[s[0]], s[2]))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(shown(spans).encode()).hexdigest()


def columns(found: list[list[Span]], base: list[str], kinds: list[str]) -> dict[str, list]:
    """n_<kind> per base kind, base_sha256 and spans."""
    found = [in_order(spans, kinds) for spans in found]
    own = [[s for s in spans if s[0] in base] for spans in found]
    out: dict[str, list] = {f"n_{k}": [sum(s[0] == k for s in spans) for spans in own] for k in base}
    return out | {"base_sha256": [digest(s) for s in own], "spans": [shown(s) for s in found]}
