"""A Python data source for rasters in the ESRI ASCII grid format, read as cells by bands of rows.

    spark.dataSource.register(AsciiGrid)
    spark.read.format("ascii_grid").option("path", file).option("bbox", "w,s,e,n").load()

Rows: layer, row, col, x, y, value; NoData is missing, cells outside the box are
not read. Other raster codecs need libraries that the engine doesn't ask for:
their cells come in as Parquet.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

STEP = 256


class Band(InputPartition):
    def __init__(self, file: str, first: int, last: int) -> None:
        self.file, self.first, self.last = file, first, last


def opened(file: str):
    return gzip.open(file, "rt") if file.endswith(".gz") else open(file, encoding="ascii")


def header(file: str) -> dict[str, float]:
    with opened(file) as f:
        return {k.lower(): float(v) for k, v in (next(f).split() for _ in range(6))}


class GridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Band]:
        path = Path(self.options["path"])
        files = sorted(str(p) for p in path.glob("*.asc*")) if path.is_dir() else [str(path)]
        return [Band(f, a, min(a + STEP, int(h["nrows"]))) for f in files for h in [header(f)] for a in range(0, int(h["nrows"]), STEP)]

    def read(self, partition: Band) -> Iterator[pa.RecordBatch]:
        h = header(partition.file)
        size, west, north, nodata = h["cellsize"], h["xllcorner"], h["yllcorner"] + h["nrows"] * h["cellsize"], h["nodata_value"]
        box = [float(x) for x in self.options["bbox"].split(",")] if self.options.get("bbox") else None
        layer = Path(partition.file).name.split(".")[0]
        with opened(partition.file) as f:
            for n, line in enumerate(f):
                row = n - 6
                if row < partition.first:
                    continue
                if row >= partition.last:
                    break
                y = north - (row + 0.5) * size
                if box and not box[1] <= y <= box[3]:
                    continue
                kept = [(c, west + (c + 0.5) * size, float(v)) for c, v in enumerate(line.split())]
                kept = [k for k in kept if not box or box[0] <= k[1] <= box[2]]
                n_kept = len(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([layer] * n_kept), pa.array([row] * n_kept, pa.int32()), pa.array([k[0] for k in kept], pa.int32()), pa.array([k[1] for k in kept], pa.float64()), pa.array([y] * n_kept, pa.float64()), pa.array([None if k[2] == nodata or k[2] != k[2] else k[2] for k in kept], pa.float64())],
                    ["layer", "row", "col", "x", "y", "value"])


class AsciiGrid(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ascii_grid"

    def schema(self) -> str:
        return "layer string, row int, col int, x double, y double, value double"

    def reader(self, schema: StructType) -> GridReader:
        return GridReader(dict(self.options))
