"""Files in and out, and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from cellweave.operators import statistics
from cellweave.plans import recommend
from cellweave.sources import paged, readers, sinks
from cellweave.sources.ascii_grid import AsciiGrid
from cellweave.streaming import windows


def test_registries(spark, tmp_path):
    (tmp_path / "new.csv").write_text(",".join(readers.NEW_COLUMNS[:-1]) + "\n5001,2020,Café,1.5,10,12\n25,x,Papa,bad,1,1\n")
    (tmp_path / "old.csv").write_text(",".join(readers.OLD_COLUMNS) + "\n11001,2012,Maíz,2,3,4,Permanente\n")
    new = readers.registry(spark, str(tmp_path / "new.csv"), readers.NEW_COLUMNS)
    old = readers.registry(spark, str(tmp_path / "old.csv"), readers.OLD_COLUMNS)
    rows = readers.registries(new, old).orderBy("cod_mun", "semestre").collect()
    assert len(rows) == 6 and {r["cultivo_norm"] for r in rows} == {"Cafe", "Papa", "Maiz"}
    bad = next(r for r in rows if r["cod_mun"] == "00025")
    assert bad["year"] is None and bad["rendimiento"] is None and bad["ciclo"] == "Transitorio"


def test_stations_and_the_last_day(spark, tmp_path):
    (tmp_path / "s.csv").write_text("codigoestacion,fechaobservacion,valorobservado,latitud,longitud\n1,2020-01-31T18:00:00,5,4,-74\n1,nonsense,-9999,4,-74\n")
    s = readers.stations(spark, str(tmp_path / "s.csv"))
    assert [(r["value"], r["altitude"]) for r in s.orderBy(F.desc_nulls_last("ts")).collect()] == [(5.0, None), (None, None)]
    assert s.where(readers.month_window("ts", 2020, 1)).count() == 1 and s.where(readers.month_window("ts", 2020, 1, quirk=True)).count() == 0


def test_geojson_round_trip(spark, tmp_path):
    ring = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]
    doc = {"type": "FeatureCollection", "features": [{"properties": {"MpCodigo": "25001", "MpNombre": "A"}, "geometry": {"type": "Polygon", "coordinates": ring}}, {"properties": {"mpio_ccnct": "5001"}, "geometry": {"type": "MultiPolygon", "coordinates": [ring, ring]}}]}
    (tmp_path / "monitoreo_papa_2023_s2.geojson").write_text(json.dumps(doc))
    f = readers.polygons(readers.geojson(spark, str(tmp_path / "*.geojson")))
    assert sorted(len(r["rings"]) for r in f.collect()) == [1, 2]
    assert readers.municipalities(f).select("cod_dane", "nombre_mpio").collect() == [("25001", "A")]
    crop, semester = readers.monitored(F.col("file"))
    assert set(f.select(crop, semester).collect()) == {("papa", "2023B")}
    text = sinks.features(f.select("rings", F.lit("x").alias("name")), "rings", ["name"]).first()["value"]
    assert json.loads(text)["geometry"]["coordinates"][0] == ring[0]


def test_file_names(spark):
    df = spark.createDataFrame([("a/chirps_2020_03.tif",), ("none.tif",)], "f string")
    assert [r[0] for r in df.select(readers.month_of(F.col("f"))).collect()] == ["2020_03", None]


def test_paged_source(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"page_{i}.json").write_text(json.dumps([{"id": i * 2 + k, "dept": "A" if k else "B"} for k in range(2)]))
    paged.register(spark)
    df = spark.read.format("paged_json").schema("id long, dept string").option("path", str(tmp_path)).load()
    assert df.count() == 6 and sorted(r["id"] for r in df.where("dept = 'A'").collect()) == [1, 3, 5]
    assert sorted(r["id"] for r in df.where("id between 2 and 4 and dept in ('A', 'B')").collect()) == [2, 3, 4]
    options = {"schema": "id long, dept string", "path": str(tmp_path)}
    assert paged.scan(spark, limit=2, **options).count() == 2 and [r["id"] for r in paged.scan(spark, where="id >= 5", limit=2, **options).collect()] == [5]
    reader = paged.PagedReader(df.schema, {"path": str(tmp_path), "limit": "1"})
    assert list(reader.pushFilters([paged.EqualTo(("dept",), "A"), paged.GreaterThan(("id",), 1)])) == [] and list(reader.read(paged.Page(1))) == [(3, "A")]


def test_paged_values_are_cast_before_they_are_tested(spark, tmp_path):
    held = [{"id": "7", "dept": 5}, {"id": "x", "dept": None}, {"id": 9.0, "dept": "5"}, {"id": None, "dept": True}, {}]
    (tmp_path / "page_0.json").write_text(json.dumps(held))
    paged.register(spark)
    df = spark.read.format("paged_json").schema("id long, dept string").option("path", str(tmp_path)).load()
    assert [r["id"] for r in df.where("id > 6").orderBy("id").collect()] == [7, 9] and df.where("id = 7").count() == 1
    assert df.where("dept = '5'").count() == 2 and df.where("id is null").count() == 3


def test_reports_are_short(spark):
    with pytest.raises(ValueError, match="more than 5 rows"):
        sinks.markdown(spark.range(6), "Too long", 5)


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "dem.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 10\nNODATA_value -9999\n1 2 -9999\n4 5 6\n")
    spark.dataSource.register(AsciiGrid)
    load = lambda **o: spark.read.format("ascii_grid").options(path=str(tmp_path / "dem.asc"), **o).load()
    assert load().where("value is null").select("row", "col").collect() == [(0, 2)]
    assert [r["value"] for r in load(bbox="0,0,15,10").orderBy("col").collect()] == [4.0, 5.0]
    lines = sinks.ascii_rows(load().select("row", "col", "value"), 3).orderBy("row").collect()
    assert lines[0]["value"] == "1.0 2.0 -9999.0"


def test_sinks(spark, sf, tmp_path):
    df = spark.createDataFrame([("2020A", 1), ("2020B", 2)], "semestre string, v int")
    sinks.parquet(df, str(tmp_path / "v"))
    sinks.parquet(df.limit(0), str(tmp_path / "v"))  # what is there stays
    assert readers.view(spark, str(tmp_path / "v")).where("semestre = '2020B'").count() == 1 and readers.landed(spark, str(tmp_path / "v")) == 2 and readers.landed(spark, str(tmp_path / "no")) == 0
    assert json.loads(sinks.json_object(df, "semestre", "v").first()["value"]) == {"2020A": 1, "2020B": 2}
    report = sinks.markdown(statistics.describe(df, ["v"]), "View")
    assert "| v | 2 | 1.5 |" in report and "<td>v</td>" in sinks.html_profile(df, "View")


def test_validation():
    with pytest.raises(ValueError, match="semester"):
        recommend.validated("1999A", [[[0, 0]] * 4], ("2020A",))
    with pytest.raises(ValueError, match="corners"):
        recommend.validated("2020A", [], ("2020A",))


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = windows.start(windows.tumbling(stream, ["event_type"], late="3650 days"), "daily", "update", str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select start, event_type, max(n) as n from daily group by all")
    want = windows.tumbling(events, ["event_type"]).select("start", "event_type", "n")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
