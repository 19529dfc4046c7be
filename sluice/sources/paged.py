"""Paged sources, such as the tabs of a sheet or a run search: a partition a tab, page tokens followed to the end."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from sluice.checks import CheckError
from sluice.shared import files_at

#: A condition that goes to the source: column, comparison, value.
Where = tuple[str, str, Any]
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}


class Client(Protocol):
    """What a source must offer; it is sent to the executors. filters: the columns whose conditions it applies itself."""

    filters: tuple[str, ...]

    def page(self, tab: str, token: str | None, where: list[Where]) -> tuple[list[dict], str | None]:
        """The rows of the page behind a token (None: the first) that meet all conditions, and the next page's token (None: there is none)."""


@dataclass
class Tab(InputPartition):
    name: str


class PagedReader(DataSourceReader):
    def __init__(self, client: Client, tabs: list[str], names: list[str], tries: int, wait: float) -> None:
        self.client, self.tabs, self.names, self.tries, self.wait = client, tabs, names, tries, wait
        self.where: list[Where] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Conditions on tab choose partitions, those that the client knows go to it; Spark applies the others."""
        for f in filters:
            column, how = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None, COMPARED.get(type(f))
            if column == "tab" and how in ("=", "in"):
                self.tabs = [t for t in self.tabs if (t == f.value if how == "=" else t in f.value)]
            elif column in self.client.filters and how:
                self.where.append((column, how, f.value))
            elif not (isinstance(f, IsNotNull) and (column == "tab" or any(column == c for c, *_ in self.where))):
                yield f

    def partitions(self) -> list[Tab]:
        return [Tab(t) for t in self.tabs] or [Tab("")]

    def fetched(self, tab: str, token: str | None) -> tuple[list[dict], str | None]:
        for attempt in range(self.tries):
            try:
                return self.client.page(tab, token, self.where)
            except OSError:
                if attempt + 1 == self.tries:
                    raise
                time.sleep(self.wait * 2**attempt)
        raise AssertionError

    def read(self, partition: Tab) -> Iterator[tuple]:
        token, seen = None, set()
        while partition.name:
            rows, token = self.fetched(partition.name, token)
            for row in rows:
                yield tuple(partition.name if c == "tab" else row.get(c) for c in self.names)
            if token is None:
                return
            if token in seen:
                raise CheckError(f"{partition.name}: the page token {token} came twice")
            seen.add(token)


def paged(spark: SparkSession, client: Client, tabs: list[str], columns: str, name: str = "paged", tries: int = 4, wait: float = 0.5) -> DataFrame:
    """tab and the columns (a schema as text) of all rows of all pages of the tabs.

    A tab is one task's, since its pages can only be had one after another. A page that fails by an OSError is asked for again, up to ``tries``
    times with growing pauses. Fields that a row lacks are null. A token that comes twice is an error.
    """
    full = f"tab string, {columns}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return full

        def reader(self, schema: T.StructType) -> PagedReader:
            return PagedReader(client, tabs, schema.names, tries, wait)

    spark.dataSource.register(Source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(name).load()


MEETS = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "in": lambda a, b: a in b}


@dataclass(frozen=True)
class FolderClient:
    """Pages that were exported to a folder, as ``export`` writes them: <tab>/<token>.json, the first is start.json."""

    folder: str
    filters: tuple[str, ...] = ()

    def page(self, tab: str, token: str | None, where: list[Where]) -> tuple[list[dict], str | None]:
        fs, root = files_at(self.folder)
        with fs.open_input_stream(f"{root}/{tab}/{token or 'start'}.json") as f:
            page = json.loads(f.read())
        return [r for r in page["rows"] if all(r.get(c) is not None and MEETS[how](r[c], v) for c, how, v in where)], page["next"]


def export(rows: DataFrame, folder: str, tab: str, page: str) -> None:
    """Writes rows as pages for a FolderClient; page: a number, a page is one task's, those of a tab follow by it. tab isn't among a row's fields."""
    pages = rows.select(F.col(tab).alias("__tab"), F.col(page).alias("__page")).distinct()
    by = Window.partitionBy("__tab").orderBy("__page")  # a row a page
    chain = pages.withColumns({"__next": F.lead("__page").over(by).cast("string"), "__first": F.lag("__page").over(by).isNull()})
    fields = [c for c in rows.columns if c not in (tab, page)]

    def run(group: pa.Table) -> pa.Table:
        name, number, after, first = (group[c][0].as_py() for c in ("__tab", "__page", "__next", "__first"))
        fs, root = files_at(folder)
        fs.create_dir(f"{root}/{name}", recursive=True)
        with fs.open_output_stream(f"{root}/{name}/{'start' if first else number}.json") as f:
            f.write(json.dumps({"rows": group.select(fields).to_pylist(), "next": after}, ensure_ascii=False).encode())
        return pa.table({"n": [group.num_rows]})

    joined = rows.withColumnsRenamed({tab: "__tab", page: "__page"}).join(chain, ["__tab", "__page"])
    joined.groupBy("__tab", "__page").applyInArrow(run, "n long").agg(F.sum("n")).collect()
