"""A Python data source and sink for rasters in TIFF files, with bands, georeference and NoData.

    register(spark)
    spark.read.format("tiff").option("path", folder).option("bands", "1,3").option("bbox", "w,s,e,n").load()
    tiles_of(cells, ["ndvi", "evi"], 512).write.format("tiff").mode("append").options(path=folder, west=..., north=..., size=30).save()

Reading: rows (layer, band, row, col, x, y, value), NoData is missing. Headers
tell where strips or tiles lie; each partition reads the byte ranges of about
`CELLS` cells, of the strips that meet the box only. Classic and big TIFF, both
byte orders, strips and tiles, bands side by side or apart, integers and floats,
no compression, deflate and LZW, with either predictor.

Writing: one file for each row (layer, row, col, height, width, bands) of a
table of tiles. Tasks write under a temporary name; what a failed or repeated
task wrote is removed, and files get their names when the whole write commits.

Paths are those of a file system that all executors see; local paths work in
local mode.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.semantics import NODATA
from ..operators.tiles import framed
from .commits import TwoPhaseWriter, listed, opened

CELLS = 4_000_000
#: Fixed values of the format: fields, their types' struct letters, sample kinds and compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, KIND, PIXEL, TIE, MISSING = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339, 33550, 33922, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
KINDS = {1: "u", 2: "i", 3: "f"}
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
CODES = {"none": NONE, "lzw": LZW, "deflate": DEFLATE}


def unlzw(data: bytes) -> bytes:
    """LZW with codes of 9 to 12 bits, highest bit first, widened one code early."""
    out, table, width, previous = [], [], 9, b""
    held, bits = 0, 0
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, previous = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else previous + previous[:1]
        out.append(entry)
        if previous:
            table.append(previous + entry[:1])
        previous = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    """The inverse of unlzw."""
    out, held, bits = bytearray(), 0, 0

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    table, width, run = {bytes([i]): i for i in range(256)}, 9, b""
    put(256, 9)
    for i in range(len(data)):
        longer = run + data[i : i + 1]
        if longer in table:
            run = longer
            continue
        put(table[run], width)
        table[longer] = len(table) + 2
        run = data[i : i + 1]
        size = len(table) + 2
        if size == 4094:
            put(256, width)
            table, width = {bytes([i]): i for i in range(256)}, 9
        else:
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    if run:
        put(table[run], width)
        size = len(table) + 3
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257, width)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


@dataclass
class Header:
    """What a file says of itself; blocks are strips or tiles, in rows, then (bands apart) band by band."""

    width: int
    height: int
    samples: int
    dtype: np.dtype
    compression: int
    predictor: int
    apart: bool
    block: tuple[int, int]
    offsets: tuple[int, ...]
    counts: tuple[int, ...]
    west: float
    north: float
    size: tuple[float, float]
    nodata: float | None

    @property
    def across(self) -> int:
        return -(-self.width // self.block[1])

    @property
    def down(self) -> int:
        return -(-self.height // self.block[0])

    def decoded(self, data: bytes) -> np.ndarray:
        """(rows, columns, samples of the block) of one block, as stored."""
        if self.compression in (DEFLATE, OLD_DEFLATE):
            data = zlib.decompress(data)
        elif self.compression == LZW:
            data = unlzw(data)
        elif self.compression != NONE:
            raise ValueError(f"compression {self.compression} is not read")
        samples, size = 1 if self.apart else self.samples, self.dtype.itemsize
        line = self.block[1] * samples * size
        rows = min(self.block[0], len(data) // line)
        if self.predictor == 3:  # bytes of a line by significance, each the difference from the one `samples` before
            steps = np.frombuffer(data[: rows * line], np.uint8).reshape(rows, -1, samples).cumsum(1, dtype=np.uint8)
            return np.ascontiguousarray(steps.reshape(rows, size, -1).transpose(0, 2, 1)).view(f">f{size}").reshape(rows, -1, samples)
        out = np.frombuffer(data[: rows * line], self.dtype).reshape(rows, self.block[1], samples)
        return out.astype(self.dtype.newbyteorder("=")).cumsum(1, dtype=self.dtype.newbyteorder("=")) if self.predictor == 2 else out


def header(source) -> Header:
    """Reads the first directory of an open file, a few small ranges."""
    first = source.read_at(16, 0)
    order = {b"II": "<", b"MM": ">"}[first[:2]]
    big = struct.unpack_from(order + "H", first, 2)[0] == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), first, 8 if big else 4)[0]
    n = struct.unpack(order + ("Q" if big else "H"), source.read_at(8 if big else 2, at))[0]
    entry, inline, at = (20, 8, at + 8) if big else (12, 4, at + 2)
    listed, tags = source.read_at(n * entry, at), {}
    for i in range(n):
        tag, kind = struct.unpack_from(order + "HH", listed, i * entry)
        count = struct.unpack_from(order + ("Q" if big else "I"), listed, i * entry + 4)[0]
        if kind not in TYPES:
            continue
        form = f"{order}{count}{TYPES[kind]}"
        where = i * entry + (12 if big else 8)
        raw = listed[where : where + inline] if struct.calcsize(form) <= inline else source.read_at(struct.calcsize(form), struct.unpack_from(order + ("Q" if big else "I"), listed, where)[0])
        tags[tag] = struct.unpack_from(form, raw)
    samples = tags.get(SAMPLES, (1,))[0]
    dtype = np.dtype(f"{order}{KINDS[tags.get(KIND, (1,))[0]]}{tags[BITS][0] // 8}")
    tiled = TILE_OFFSETS in tags
    block = (tags[TILE_HEIGHT][0], tags[TILE_WIDTH][0]) if tiled else (min(tags.get(ROWS, (1 << 31,))[0], tags[HEIGHT][0]), tags[WIDTH][0])
    size, tie = tags.get(PIXEL, (1.0, 1.0, 0.0)), tags.get(TIE, (0.0,) * 6)
    missing = tags[MISSING][0].split(b"\0")[0].strip() if MISSING in tags else b""
    return Header(tags[WIDTH][0], tags[HEIGHT][0], samples, dtype, tags.get(COMPRESSION, (1,))[0], tags.get(PREDICTOR, (1,))[0], tags.get(PLANAR, (1,))[0] == 2 and samples > 1, block, tags[TILE_OFFSETS if tiled else OFFSETS], tags[TILE_COUNTS if tiled else COUNTS], tie[3] - tie[0] * size[0], tie[4] + tie[1] * size[1], (size[0], size[1]), float(missing) if missing else None)


def encoded(bands: Sequence[np.ndarray], west: float, north: float, size: float, dtype: str = "float32", compress: str = "deflate", predictor: int = 1, nodata: float = NODATA, strip: int = 64) -> bytes:
    """A little-endian TIFF of strips, bands side by side; NaN becomes NoData."""
    kind = np.dtype(dtype).newbyteorder("<")
    data = np.stack([np.where(np.isnan(b), nodata, b) for b in bands], 2).astype(kind)
    rows, cols, samples = data.shape
    strips = []
    for a in range(0, rows, strip):
        part = data[a : a + strip]
        if predictor == 2:
            part = np.concatenate([part[:, :1], np.diff(part, axis=1)], 1)
        raw = part.tobytes()
        if predictor == 3:
            line = np.ascontiguousarray(part.astype(kind.newbyteorder(">"))).reshape(len(part), -1).view(np.uint8).reshape(len(part), -1, kind.itemsize).transpose(0, 2, 1).reshape(len(part), -1, samples)
            raw = np.concatenate([line[:, :1], np.diff(line, axis=1)], 1).tobytes()
        strips.append({"none": lambda v: v, "deflate": zlib.compress, "lzw": lzw}[compress](raw))
    ends = np.cumsum([8, *map(len, strips)]).tolist()
    fields = [(WIDTH, "I", [cols]), (HEIGHT, "I", [rows]), (BITS, "H", [kind.itemsize * 8] * samples), (COMPRESSION, "H", [CODES[compress]]), (262, "H", [1]), (OFFSETS, "I", ends[:-1]), (SAMPLES, "H", [samples]), (ROWS, "I", [strip]), (COUNTS, "I", list(map(len, strips))), (PLANAR, "H", [1]), (PREDICTOR, "H", [predictor]), (KIND, "H", [{v: k for k, v in KINDS.items()}[kind.kind]] * samples), (PIXEL, "d", [size, size, 0.0]), (TIE, "d", [0.0, 0.0, 0.0, west, north, 0.0]), (MISSING, "s", [f"{nodata:g}".encode() + b"\0"])]
    if samples > 1:
        fields.insert(-4, (338, "H", [0] * (samples - 1)))
    body, at = b"", ends[-1] + ends[-1] % 2
    table, more = b"", at + 2 + 12 * len(fields) + 4
    for tag, letter, values in sorted(fields):
        raw = values[0] if letter == "s" else struct.pack(f"<{len(values)}{letter}", *values)
        head = struct.pack("<HHI", tag, {"H": 3, "I": 4, "d": 12, "s": 2}[letter], len(raw) if letter == "s" else len(values))
        if len(raw) <= 4:
            table += head + raw.ljust(4, b"\0")
        else:
            table += head + struct.pack("<I", more + len(body))
            body += raw + b"\0" * (len(raw) % 2)
    return b"II*\0" + struct.pack("<I", at) + b"".join(strips) + b"\0" * (ends[-1] % 2) + struct.pack("<H", len(fields)) + table + b"\0" * 4 + body


class Blocks(InputPartition):
    def __init__(self, file: str, first: int, last: int) -> None:
        self.file, self.first, self.last = file, first, last


class TiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.box = [float(v) for v in options["bbox"].split(",")] if options.get("bbox") else None

    def partitions(self) -> list[Blocks]:
        """Runs of block rows of each file that meet the box."""
        files, _ = opened(self.options["path"])
        names = listed(self.options["path"], r"\.tiff?$")
        out = []
        for name in names:
            with files.open_input_file(name) as source:
                h = header(source)
            each = max(1, CELLS // max(1, h.block[0] * h.width))
            meets = [i for i in range(h.down) if not self.box or (h.north - (i + 1) * h.block[0] * h.size[1] <= self.box[3] and h.north - i * h.block[0] * h.size[1] >= self.box[1])]
            out += [Blocks(name, meets[i], min(meets[i] + each, meets[-1] + 1)) for i in range(0, len(meets), each)]
        return out

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.options["path"])
        layer = re.sub(r"\.tiff?$", "", partition.file.rsplit("/", 1)[-1], flags=re.I)
        with files.open_input_file(partition.file) as source:
            h = header(source)
            asked = [int(b) for b in self.options["bands"].split(",")] if self.options.get("bands") else range(1, h.samples + 1)
            nodata = float(self.options["nodata"]) if self.options.get("nodata") else h.nodata
            for i in range(partition.first, partition.last):
                for j in range(h.across):
                    planes = {}
                    for b in asked:
                        if h.apart or not planes:
                            n = (i * h.across + j) + (b - 1) * h.across * h.down * h.apart
                            whole = h.decoded(source.read_at(h.counts[n], h.offsets[n])) if h.counts[n] else None
                        planes[b] = None if whole is None else whole[:, :, 0 if h.apart else b - 1]
                    yield from self.cells(h, layer, i, j, planes, nodata)

    def cells(self, h: Header, layer: str, i: int, j: int, planes: dict, nodata: float | None) -> Iterator[pa.RecordBatch]:
        rows, cols = np.arange(i * h.block[0], min((i + 1) * h.block[0], h.height)), np.arange(j * h.block[1], min((j + 1) * h.block[1], h.width))
        x, y = h.west + (cols + 0.5) * h.size[0], h.north - (rows + 0.5) * h.size[1]
        if self.box:
            kr, kc = (y >= self.box[1]) & (y <= self.box[3]), (x >= self.box[0]) & (x <= self.box[2])
        else:
            kr, kc = np.ones(len(rows), bool), np.ones(len(cols), bool)
        r, c = (v.ravel() for v in np.meshgrid(np.flatnonzero(kr), np.flatnonzero(kc), indexing="ij"))
        for b, plane in planes.items():
            v = np.full(len(r), np.nan) if plane is None else plane[r, c].astype(float)
            gap = np.isnan(v) if nodata is None else np.isnan(v) | (v == nodata)
            yield pa.RecordBatch.from_arrays([pa.array([layer] * len(r)), pa.array(np.full(len(r), b, np.int32)), pa.array(rows[r].astype(np.int32)), pa.array(cols[c].astype(np.int32)), pa.array(x[c]), pa.array(y[r]), pa.array(v, mask=gap)], ["layer", "band", "row", "col", "x", "y", "value"])


class TiffWriter(TwoPhaseWriter):
    def made(self, rows: Iterator[Row]) -> Iterator[tuple[str, bytes]]:
        o = self.options
        size = float(o.get("size", 1))
        for row in rows:
            bands = [np.array([np.nan if v is None else v for v in b], float).reshape(row["height"], row["width"]) for b in row["bands"]]
            data = encoded(bands, float(o.get("west", 0)) + row["col"] * size, float(o.get("north", 0)) - row["row"] * size, size, o.get("dtype", "float32"), o.get("compress", "deflate"), int(o.get("predictor", 1)), float(o.get("nodata", NODATA)), int(o.get("strip", 64)))
            yield f"{row['layer']}_{row['row']}_{row['col']}.tif", data


class Tiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> str:
        return "layer string, band int, row int, col int, x double, y double, value double"

    def reader(self, schema: StructType) -> TiffReader:
        return TiffReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> TiffWriter:
        return TiffWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Tiff)


def tiles_of(cells: DataFrame, bands: Sequence[str], side: int = 512, layer: str = "tile") -> DataFrame:
    """(layer, row, col, height, width, bands): square tiles of cells (row, col, bands), each for one file; (row, col) is a tile's first cell."""
    names = [f"_{i}" for i in range(len(bands))]

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        planes = [framed(part.rename(columns={n: "value"}), key[0], key[1], side, 0)[0] for n in names]
        height, width = int(part["row"].max()) - key[0] * side + 1, int(part["col"].max()) - key[1] * side + 1
        data = [[None if np.isnan(v) else v for v in p[:height, :width].ravel().tolist()] for p in planes]
        return pd.DataFrame([[layer, key[0] * side, key[1] * side, height, width, data]], columns=["layer", "row", "col", "height", "width", "bands"])

    rows = cells.select("row", "col", *[F.col(b).cast("double").alias(n) for b, n in zip(bands, names, strict=True)])
    at = [F.floor(F.col(c) / side).cast("int").alias(t) for c, t in (("row", "ti"), ("col", "tj"))]
    return rows.select(*at, "*").groupBy("ti", "tj").applyInPandas(run, "layer string, `row` int, col int, height int, width int, bands array<array<double>>")
