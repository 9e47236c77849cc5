"""Query registration, table access and the shared view texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from string import Formatter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from codeloom.catalog.views import VIEWS
from codeloom.session import stage
from codeloom.sources.survey import input_tasks, spread_input

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# tables that grow with the data, and the column that identifies their rows
LARGE = {"orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "embeddings": "vec_id"}
# tables that are joined by that column are dealt alike, by the rows of the largest
DEALT_BY = {"orders": "lineitem"}


def references(template: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(template) if name})


@dataclass
class Tables:
    """Parquet tables of one directory, and the views over them."""

    spark: SparkSession
    folder: str
    opened: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self.opened:
            self.opened[name] = self.table(name) if name in TABLES else self.sql(VIEWS[name])
        return self.opened[name]

    def table(self, name: str) -> DataFrame:
        scan = self.scan(name)
        return spread_input(scan, LARGE[name], self.tasks(name)) if name in LARGE else scan

    def tasks(self, name: str) -> int:
        try:
            return input_tasks(self.scan(DEALT_BY.get(name, name)))
        except AnalysisException:  # the folder holds this table alone
            return input_tasks(self.scan(name))

    def scan(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def keep(self, name: str) -> None:
        """Stage a view that a query reads several times, so that its joins are done once."""
        self.opened[name] = stage(getattr(self, name), name)

    def sql(self, template: str) -> DataFrame:
        """Run SQL whose ``{name}`` fields are tables or views."""
        return self.spark.sql(template, **{name: getattr(self, name) for name in references(template)})


def with_views(template: str, extra: dict[str, str] | None = None) -> str:
    """The same SQL for another engine: views become common table expressions, tables keep their names."""
    local = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in local and name not in order:
            for needed in references(local[name]):
                visit(needed)
            order.append(name)

    for name in references(template):
        visit(name)

    def plain(text: str) -> str:
        return text.format(**{name: name for name in references(text)})

    ctes = ",\n".join(f"{name} as materialized ({plain(local[name])})" for name in order)
    return (f"with recursive {ctes}\n" if ctes else "") + plain(template)


@dataclass
class Query:
    run: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register a query. ``oracle`` is SQL for the comparison engine, with ``{view}`` fields."""
    def register(function: Callable[[Tables], DataFrame]):
        REGISTRY[name] = Query(function, with_views(oracle, extra) if oracle else None)
        return function
    return register
