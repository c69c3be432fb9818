"""TIFF files out and in, of every kind that is read, and writes that fail."""

import struct
import zlib

import numpy as np
import pytest
from pyarrow import fs

from cellweave.operators import cuts
from cellweave.sources import commits, tiff


@pytest.mark.parametrize("compress", ["none", "deflate", "lzw"])
@pytest.mark.parametrize(("dtype", "predictor"), [("uint8", 1), ("int16", 2), ("uint16", 2), ("int32", 2), ("float32", 1), ("float32", 3), ("float64", 3)])
def test_encoded_bands_come_back(tmp_path, compress, dtype, predictor):
    rng = np.random.default_rng(1)
    bands = [rng.integers(0, 200, (33, 21)).astype(float) + (0.25 if dtype.startswith("f") else 0) for _ in range(3)]
    bands[1][4, 5] = np.nan
    path = tmp_path / "a.tif"
    path.write_bytes(tiff.encoded(bands, 10.0, 90.0, 2.0, dtype, compress, predictor, 255.0, 8))
    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        h = tiff.header(f)
    assert (h.width, h.height, h.samples, h.nodata, h.west, h.north, h.size, h.block) == (21, 33, 3, 255.0, 10.0, 90.0, (2.0, 2.0), (8, 21))
    got = np.full((3, 33, 21), -1.0)
    for part in (p for b in tiff.TiffReader({"path": str(path)}).partitions() for p in tiff.TiffReader({"path": str(path)}).read(b)):
        d = part.to_pydict()
        for b, r, c, v in zip(d["band"], d["row"], d["col"], d["value"], strict=True):
            got[b - 1, r, c] = np.nan if v is None else v
    assert np.array_equal(got, np.stack(bands), equal_nan=True)


@pytest.mark.parametrize("data", [b"", b"a", b"aaaaaaaaaa" * 900, bytes(range(256)) * 80, np.random.default_rng(0).integers(0, 256, 40_000, np.uint8).tobytes(), np.random.default_rng(0).integers(0, 4, 60_000, np.uint8).tobytes()])
def test_lzw_both_ways(data):
    assert tiff.unlzw(tiff.lzw(data)) == data


def test_lzw_of_another_encoder():
    """Codes 256, 7, 258, 8, 8, 258, 6, 257 of the format's own example stand for 7 7 7 8 8 7 7 6."""
    bits = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 257))
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.unlzw(data) == bytes([7, 7, 7, 8, 8, 7, 7, 6])


def tiled_file(order, big):
    """Two bands apart, in tiles of 16 x 16, of 20 x 18 cells, one tile of them absent."""
    z = np.arange(2 * 18 * 20).reshape(2, 18, 20).astype(f"{order}i2")
    blocks, at = [], 16
    for b in range(2):
        for i in range(0, 18, 16):
            for j in range(0, 20, 16):
                t = np.zeros((16, 16), f"{order}i2")
                part = z[b, i : i + 16, j : j + 16]
                t[: part.shape[0], : part.shape[1]] = part
                blocks.append(b"" if (b, i, j) == (1, 16, 16) else zlib.compress(t.tobytes()))
    offsets = np.cumsum([at, *map(len, blocks)]).tolist()
    letter, number = ("Q", 16) if big else ("I", 4)
    fields = [(256, 3, [20]), (257, 3, [18]), (258, 3, [16, 16]), (259, 3, [8]), (277, 3, [2]), (284, 3, [2]), (322, 3, [16]), (323, 3, [16]), (324, number, offsets[:-1]), (325, number, list(map(len, blocks))), (339, 3, [2, 2])]
    start = offsets[-1]
    entry, inline = (20, 8) if big else (12, 4)
    more, table, body = start + (8 if big else 2) + entry * len(fields) + (8 if big else 4), b"", b""
    for tag, kind, values in fields:
        raw = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else letter}", *values)
        table += struct.pack(f"{order}HH{letter}", tag, kind, len(values))
        if len(raw) <= inline:
            table += raw.ljust(inline, b"\0")
        else:
            table += struct.pack(order + letter, more + len(body))
            body += raw
    head = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, start) if big else struct.pack(order + "HI", 42, start)).ljust(14, b"\0")
    return z, head + b"".join(blocks) + struct.pack(order + ("Q" if big else "H"), len(fields)) + table + b"\0" * (8 if big else 4) + body


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("big", [False, True])
def test_tiles_of_other_writers(spark, tmp_path, order, big):
    z, data = tiled_file(order, big)
    (tmp_path / "t.tif").write_bytes(data)
    tiff.register(spark)
    rows = spark.read.format("tiff").option("path", str(tmp_path)).option("bands", "2").load().collect()
    got = {(r["row"], r["col"]): r["value"] for r in rows}
    assert len(got) == 18 * 20 and {r["band"] for r in rows} == {2}
    assert all(got[r, c] == (None if r >= 16 and c >= 16 else float(z[1, r, c])) for r in range(18) for c in range(20))


@pytest.fixture(scope="module")
def cells(spark):
    return spark.range(50 * 30).selectExpr("cast(id div 30 as int) as row", "cast(id % 30 as int) as col", "id * 0.5 as a", "if(id % 7 = 0, null, id * 2.0) as b")


def test_write_and_read_in_tiles(spark, cells):
    tiff.register(spark)
    path = cuts.fresh_folder(spark, "tiff")
    write = lambda df, mode: tiff.tiles_of(df, ["a", "b"], 16, "dem").write.format("tiff").mode(mode).options(path=path, west=100.0, north=500.0, size=10.0, dtype="float64", predictor=3).save()
    write(cells, "append")
    read = spark.read.format("tiff").option("path", path).load()
    assert read.select("layer").distinct().count() == 8
    want = {(r["col"] * 10 + 105.0, 495.0 - r["row"] * 10, b, r["ab"[b - 1]]) for r in cells.collect() for b in (1, 2)}
    assert {(r["x"], r["y"], r["band"], r["value"]) for r in read.collect()} == want and read.count() == len(want)
    box = spark.read.format("tiff").options(path=path, bbox="100,300,200,420", bands="1").load()
    assert {(r["x"], r["y"]) for r in box.collect()} == {(x, y) for x, y, b, _ in want if b == 1 and x <= 200 and 300 <= y <= 420}
    write(cells.where("row < 16 and col < 16"), "overwrite")
    assert spark.read.format("tiff").option("path", path).load().count() == 2 * 16 * 16


def test_a_failed_write_leaves_nothing(spark, cells):
    tiff.register(spark)
    path = cuts.fresh_folder(spark, "tiff")
    bad = tiff.tiles_of(cells, ["a"], 16).selectExpr("layer", "row", "col", "if(row > 16, height + 1, height) as height", "width", "bands")
    with pytest.raises(Exception, match="reshape"):
        bad.write.format("tiff").mode("append").options(path=path).save()
    files, root = commits.opened(path)
    assert [f.path for f in files.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file] == []
    with pytest.raises(Exception, match="FileNotFound|not found|NotFound"):
        spark.read.format("tiff").option("path", path + "-none").load().count()
