"""Feature pages that fall back and resume, GeoJSON files that grow."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellweave.operators import cuts
from cellweave.sources import commits, features, readers

SCHEMA = "id long, code string, area double, geometry array<array<array<double>>>"


def square(x):
    return [[[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 0.0]]]


def page(numbers):
    return json.dumps({"features": [{"attributes": {"id": i, "code": f"c{i % 3}", "area": "bad" if i == 2 else str(i)}, "geometry": {"rings": square(float(i))} if i != 5 else None} for i in numbers]})


@pytest.fixture
def folder(spark):
    features.register(spark)
    return cuts.fresh_folder(spark, "pages")


def land(spark, folder, **pages):
    features.landed(spark.createDataFrame([(int(n[1:]), page(v)) for n, v in pages.items()], "n int, value string"), folder)


def test_scan_by_box_and_attributes(spark, folder):
    land(spark, folder, p0=range(0, 4), p1=range(4, 8), p10=range(8, 12))
    load = lambda requests: spark.read.format("feature_pages").schema(SCHEMA).options(path=folder, requests=json.dumps(requests)).load()
    everything = {r["id"]: r for r in load([{}]).collect()}
    assert len(everything) == 12 and everything[2]["area"] is None and everything[3]["area"] == 3.0 and everything[5]["geometry"] is None and everything[4]["geometry"] == square(4.0)
    assert {r["id"] for r in load([{"bbox": [2.5, 0, 4.5, 1]}]).collect()} == {2, 3, 4}
    assert {r["id"] for r in load([{"bbox": [90, 0, 91, 1]}, {"where": {"code": "c1"}}, {}]).collect()} == {1, 4, 7, 10}
    assert load([{"where": {"code": "none"}}]).count() == 0


def test_later_requests_are_asked_only_if_the_first_finds_nothing(monkeypatch):
    asked = []
    service = features.Service(StructType(), {"path": "/none", "requests": '[{"n": 1}, {"n": 2}, {"n": 3}]'})
    monkeypatch.setattr(features.Service, "fetch", lambda self, r, n: asked.append((r["n"], n)) or (["x"] if r["n"] == 2 and n == 1 else []))
    assert service.chosen([0, 1, 2]) == 1 and asked == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]


def test_a_stopped_load_goes_on_where_it_was(spark, folder):
    out = cuts.fresh_folder(spark, "load")

    def load(fail=False):
        rows = spark.readStream.format("feature_pages").schema("id long").options(path=folder, requests='[{"bbox": [90, 0, 91, 1]}, {}]').load()
        if fail:
            rows = rows.withColumn("id", F.when(F.col("id") == 9, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
        rows.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{out}-at").start(out).awaitTermination()

    land(spark, folder, p0=range(0, 4), p1=range(4, 8))
    load()
    land(spark, folder, p2=range(8, 12))
    with pytest.raises(Exception, match="lost"):
        load(fail=True)
    load()
    load()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(12))
    # the request that the load has settled on stays, though the first would find something now
    land(spark, folder, p3=range(88, 92))
    load()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [*range(12), *range(88, 92)]


def test_collections_grow_without_doubles(spark):
    path = cuts.fresh_folder(spark, "geojson")
    rows = spark.createDataFrame([(i, f"n{i}", square(float(i))) for i in range(25)] + [(3, "again", square(3.0))], "id int, name string, rings array<array<array<double>>>")
    features.append(rows.where("id < 10"), path, "id", rows=4)
    features.append(rows, path, "id", rows=4)
    features.append(rows, path, "id", rows=4)
    files, _ = commits.opened(path)
    names = commits.listed(path, r"\.geojson$")
    found = [x for n in names for x in json.loads(files.open_input_stream(n).read())["features"]]
    assert sorted(x["properties"]["id"] for x in found) == list(range(25)) and len(names) > 4
    back = readers.polygons(readers.geojson(spark, f"{path}/*.geojson"))
    assert back.count() == 25 and all(len(r["rings"][0]) == 4 for r in back.collect())


def test_an_aborted_write_adds_no_feature(spark):
    path = cuts.fresh_folder(spark, "geojson")
    features.register(spark)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 90, F.raise_error(F.lit("lost"))).otherwise(F.lit("{}")).alias("value"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("geojson_collections").mode("append").option("path", path).save()
    files, root = commits.opened(path)
    assert commits.listed(path, ".") == [] and all(not f.is_file for f in files.get_file_info(commits.fs.FileSelector(root, recursive=True)))
