"""A Python data source over pages of JSON rows, as paged services hand them out.

    register(spark)
    spark.read.format("paged_json").schema("id long, dept string").options(path=folder, pages=12).load()

Each page is a partition. Pages come from a folder of page_<n>.json files (a
landed copy of the service, as the engine runs without a network) or from a
subclass that overrides fetch(). Equality and range filters on numbers and text
are pushed down and applied in the reader, as a service would apply them, to
values cast by the schema: what doesn't fit a column's type is missing. `limit`
counts rows that pass them: a page hands out at most so many, and scan() stops
the whole read there.
"""

from __future__ import annotations

import itertools
import json
import operator
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .features import CASTS, cast


class Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


#: What a service can be asked of a column; missing values pass none.
TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, In: lambda x, among: x in among}


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options, self.asked = schema, options, []
        self.kinds = {f.name: f.dataType for f in schema.fields}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = f.value if isinstance(f, In) else [getattr(f, "value", None)]
            if type(f) in TESTS and len(f.attribute) == 1 and all(type(v) in (int, float, str) for v in values):
                self.asked.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def value(self, row: dict, name: str):
        """A field as its column's type, missing where it doesn't fit it."""
        return cast(row.get(name), self.kinds[name]) if type(self.kinds.get(name)) in CASTS else row.get(name)

    def passes(self, row: dict) -> bool:
        return all((held := self.value(row, name)) is not None and TESTS[kind](held, value) for name, kind, value in self.asked)

    def partitions(self) -> list[Page]:
        return [Page(i) for i in range(int(self.options.get("pages") or len(list(Path(self.options["path"]).glob("page_*.json")))))]

    def fetch(self, number: int) -> list[dict]:
        file = Path(self.options["path"]) / f"page_{number}.json"
        return json.loads(file.read_text(encoding="utf-8")) if file.exists() else []

    def read(self, partition: Page) -> Iterator[tuple]:
        most, names = int(self.options.get("limit", 0)), [f.name for f in self.schema.fields]
        kept = filter(self.passes, self.fetch(partition.number))
        for row in itertools.islice(kept, most) if most else kept:
            yield tuple(self.value(row, k) for k in names)


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Registers the source and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedJson)


def scan(spark: SparkSession, schema: str, where: Column | str | None = None, limit: int | None = None, **options: str) -> DataFrame:
    """Rows of all pages that pass `where`, at most `limit` of them in all."""
    rows = spark.read.format("paged_json").schema(schema).options(**options, **({"limit": str(limit)} if limit else {})).load()
    rows = rows if where is None else rows.where(where)
    return rows.limit(limit) if limit else rows
