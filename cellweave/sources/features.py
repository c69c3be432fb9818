"""Features of map services: a scan by box or attributes that falls back and resumes, and GeoJSON files that grow.

    register(spark)
    spark.readStream.format("feature_pages").schema("id long, code string").options(path=folder, requests='[{"bbox": [0, 0, 5, 5]}, {"where": {"code": "25"}}]').load()
    append(features, folder, "id")

A service hands out pages of features {"attributes": {...}, "geometry": {"rings":
...}}; here they lie as page_<n>.json in a folder (the engine runs without a
network), or come from a subclass that overrides fetch() and pages(). Requests
are asked in turn: the next only if the one before finds nothing. A batch read
takes all pages; a stream takes those that are new, and its checkpoint says where
to go on, so an interrupted load adds each page once. A column named `geometry`
gets the rings as array<array<array<double>>>; other columns are attributes,
missing ones null, and values that don't fit the column's type are missing.

GeoJSON is written as valid FeatureCollections, one a task, in two phases.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType

from .commits import TwoPhaseWriter, listed, opened

CASTS = {LongType: int, IntegerType: int, DoubleType: float, FloatType: float, StringType: str, BooleanType: bool}


class Page(InputPartition):
    def __init__(self, request: int, number: int) -> None:
        self.request, self.number = request, number


def fits(feature: dict, request: dict) -> bool:
    """Whether a feature meets the request's box and has its attributes."""
    if box := request.get("bbox"):
        points = [p for ring in (feature.get("geometry") or {}).get("rings") or [] for p in ring]
        if not points or min(p[0] for p in points) > box[2] or max(p[0] for p in points) < box[0] or min(p[1] for p in points) > box[3] or max(p[1] for p in points) < box[1]:
            return False
    held = feature.get("attributes") or {}
    return all(str(held.get(k)) == str(v) for k, v in (request.get("where") or {}).items())


def cast(value, kind):
    """A value of a page as a column's type, missing where it doesn't fit."""
    to = CASTS[type(kind)]
    if value is None or type(value) is to:
        return value
    if to is bool:
        return {"true": True, "false": False}.get(str(value).lower())
    if to is str:
        return json.dumps(value) if isinstance(value, (dict, list, bool)) else str(value)
    try:
        return to(value)
    except (TypeError, ValueError, OverflowError):
        return None


class Service:
    """What both readers ask for."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.columns, self.options = schema, options
        self.requests = json.loads(options.get("requests", "[{}]"))

    def pages(self) -> list[int]:
        """Numbers of the pages that are there, in order."""
        numbers = [re.search(r"page_(\d+)\.json$", f) for f in listed(self.options["path"], r"^page_\d+\.json$")]
        return sorted(int(m[1]) for m in numbers if m)

    def fetch(self, request: dict, number: int) -> list[dict]:
        """A page's features that fit the request."""
        files, root = opened(self.options["path"])
        with files.open_input_stream(f"{root}/page_{number}.json") as f:
            return [x for x in json.loads(f.read())["features"] if fits(x, request)]

    def chosen(self, numbers: list[int]) -> int:
        """The first request that finds anything; later ones are not asked beyond that."""
        return next((i for i, r in enumerate(self.requests) if any(self.fetch(r, n) for n in numbers)), len(self.requests) - 1)

    def rows(self, page: Page) -> Iterator[tuple]:
        for feature in self.fetch(self.requests[page.request], page.number):
            held, rings = feature.get("attributes") or {}, (feature.get("geometry") or {}).get("rings")
            yield tuple(([[[float(v) for v in p] for p in ring] for ring in rings] if rings else None) if c.name == "geometry" else cast(held.get(c.name), c.dataType) for c in self.columns.fields)


class PageReader(DataSourceReader):
    def __init__(self, service: Service) -> None:
        self.service = service

    def partitions(self) -> list[Page]:
        numbers = self.service.pages()
        request = self.service.chosen(numbers)
        return [Page(request, n) for n in numbers]

    def read(self, partition: Page) -> Iterator[tuple]:
        return self.service.rows(partition)


class PageStream(DataSourceStreamReader):
    """An offset is the last page taken, and the request that the load has settled on, -1 before any has found something."""

    def __init__(self, service: Service) -> None:
        self.service, self.settled = service, -1

    def initialOffset(self) -> dict:
        return {"page": -1, "request": -1}

    def latestOffset(self) -> dict:
        numbers = self.service.pages()
        if self.settled < 0 and numbers:
            self.settled = self.service.chosen(numbers)
        return {"page": numbers[-1] if numbers else -1, "request": self.settled}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        request = start["request"] if start["request"] >= 0 else end["request"]
        return [Page(request, n) for n in self.service.pages() if start["page"] < n <= end["page"]]

    def read(self, partition: Page) -> Iterator[tuple]:
        return self.service.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class FeaturePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feature_pages"

    def schema(self) -> str:
        return "geometry array<array<array<double>>>"

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(Service(schema, dict(self.options)))

    def streamReader(self, schema: StructType) -> PageStream:
        return PageStream(Service(schema, dict(self.options)))


class PageWriter(TwoPhaseWriter):
    """Rows (n, value): a page's number and text."""

    def made(self, rows: Iterator[Row]) -> Iterator[tuple[str, bytes]]:
        for row in rows:
            yield f"page_{row['n']}.json", row["value"].encode()


class CollectionWriter(TwoPhaseWriter):
    """Rows (value: a feature as JSON text), one collection a task."""

    def made(self, rows: Iterator[Row]) -> Iterator[tuple[str, bytes]]:
        texts = [r["value"] for r in rows if r["value"] is not None]
        if texts:
            yield f"features-{uuid.uuid4().hex}.geojson", ('{"type":"FeatureCollection","features":[' + ",\n".join(texts) + "]}").encode()


class GeoJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geojson_collections"

    def writer(self, schema: StructType, overwrite: bool) -> CollectionWriter:
        return CollectionWriter(dict(self.options), overwrite)


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def writer(self, schema: StructType, overwrite: bool) -> PageWriter:
        return PageWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    for source in (FeaturePages, GeoJson, LandedPages):
        spark.dataSource.register(source)


def landed(pages: DataFrame, path: str) -> None:
    """Lands pages (n, value) as the files that feature_pages reads."""
    register(pages.sparkSession)
    pages.select("n", "value").write.format("landed_pages").mode("append").option("path", path).save()


def append(features: DataFrame, path: str, key: str, rings: str = "rings", properties: list[str] | None = None, rows: int = 100_000) -> None:
    """Adds the features whose key no file of the folder has yet, so a load that is run again adds none twice; about `rows` of them a file.

    Of rows with one key in `features` one is written. A null key is never taken
    for known and is written each time.
    """
    from . import readers, sinks

    spark = features.sparkSession
    register(spark)
    names = properties or [c for c in features.columns if c != rings]
    files, root = opened(path)
    new = features.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(features.where(F.col(key).isNull()))
    if files.get_file_info(root).type == fs.FileType.Directory and listed(path, r"\.geojson$"):
        known = readers.geojson(spark, f"{path}/*.geojson").select(F.col("properties")[key].cast(features.schema[key].dataType).alias(key)).distinct()
        new = new.join(known, key, "left_anti")
    value = sinks.features(new, rings, names)
    count = value.count()
    value.repartition(max(1, -(-count // rows))).write.format("geojson_collections").mode("append").option("path", path).save()
