"""Provider registry: name -> where its postings lie and how they map.

This is the extension point: add a ``Provider`` to ``PROVIDERS`` (or pass your own
dict to the jobs) and every job handles it in the same single pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

from postmill.operators import mappings as M

Mapping = Callable[[Column, M.Context], dict[str, Column]]


@dataclass(frozen=True)
class Provider:
    name: str
    list_paths: tuple[str, ...]  # JSON paths that may hold the posting array, in order
    posting: Mapping | None = None  # item -> POSTING fields, from the provider's feed
    captured: Mapping | None = None  # item -> POSTING fields, from a captured response
    needs_base_url: bool = False
    id_required: bool = True


PROVIDERS: dict[str, Provider] = {
    p.name: p
    for p in [
        Provider("greenhouse", ("$.jobs",), M.greenhouse, M.greenhouse_captured),
        Provider("lever", ("$",), M.lever, M.lever_captured),
        Provider("ashby", ("$.jobs",), M.ashby),
        Provider(
            "workday",
            ("$.jobPostings",),
            M.workday,
            M.workday_captured,
            needs_base_url=True,
            id_required=False,
        ),
        Provider("smartrecruiters", ("$.content",), M.smartrecruiters),
        Provider("comeet", ("$", "$.data")),
        Provider("recruitee", ("$.offers",)),
    ]
}
