"""Named queries: a Spark plan and, where SQL can say it, the equal DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.plans.views import table, view, with_views


@dataclass(frozen=True)
class Inputs:
    """What a query reads: whole tables and the views derived from them."""

    spark: SparkSession
    sf_dir: str

    def view(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def discovered(self) -> DataFrame:
        return self.view("postings").filter("source = 'linkedin'")

    @property
    def fetched(self) -> DataFrame:
        return self.view("postings").filter("source = 'ats'")


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, views: list[str] | None = None, sql: str | None = None):
    """Register a plan under a name with the inventory rows it covers."""

    def register(run: Callable[[Inputs], DataFrame]):
        text = with_views(views, sql) if sql and views else sql
        QUERIES[name] = Query(run, text, covers)
        return run

    return register


def stamp(c: str) -> Column:
    """Timestamps as text, so both engines print them alike."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
