"""Given tables written by a sink and read back by its source; the SQL is the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cuts
from ..sources import features, readers, sinks, tiff
from .registry import CELLS_SQL, cells, query, r, table

BANDS_SQL = f"SELECT row, col, value, price, CASE WHEN (row + col) % 5 <> 0 THEN value / 4 END AS gaps FROM {CELLS_SQL}"


@query(f"SELECT row, col, CASE band WHEN 1 THEN value WHEN 2 THEN price ELSE gaps END AS value, band FROM ({BANDS_SQL}), (SELECT unnest([1, 2, 3])::INT AS band)")
def tiff_round_trip(spark, sf):
    """Three bands in TIFF tiles of 128 cells, read back as cells by their centres."""
    tiff.register(spark)
    bands = cells(spark, sf).withColumn("gaps", F.when((F.col("row") + F.col("col")) % 5 != 0, F.col("value") / 4))
    path = cuts.fresh_folder(spark, "tiff")
    tiff.tiles_of(bands, ["value", "price", "gaps"], 128, "part").write.format("tiff").mode("append").options(path=path, west=0.0, north=0.0, size=1.0, dtype="float64", predictor=3).save()
    back = spark.read.format("tiff").option("path", path).load().select(F.floor(-F.col("y")).cast("int").alias("row"), F.floor("x").cast("int").alias("col"), "value", "band")
    # a tile's last row may be longer than the table's
    return back.join(cells(spark, sf).select("row", "col"), ["row", "col"], "left_semi")


@query(f"SELECT row, col, price FROM {CELLS_SQL} WHERE row BETWEEN 2 AND 4 AND col BETWEEN 3 AND 10")
def tiff_window(spark, sf):
    """The second band of a TIFF raster inside a box."""
    tiff.register(spark)
    path = cuts.fresh_folder(spark, "tiff")
    tiff.tiles_of(cells(spark, sf), ["value", "price"], 64, "part").write.format("tiff").mode("append").options(path=path, dtype="float64", compress="lzw").save()
    back = spark.read.format("tiff").options(path=path, bbox="3,-5,11,-2", bands="2").load()
    return back.select(F.floor(-F.col("y")).cast("int").alias("row"), F.floor("x").cast("int").alias("col"), F.col("value").alias("price"))


def _squares(spark, sf):
    """A square for each customer."""
    x, y = F.pmod("c_custkey", F.lit(50)).cast("double"), F.floor(F.col("c_custkey") / 50).cast("double")
    corner = lambda a, b: F.array(x + a, y + b)
    ring = F.array(corner(0.0, 0.0), corner(1.0, 0.0), corner(1.0, 1.0), corner(0.0, 0.0))
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.array(ring).alias("rings"))


@query("SELECT c_custkey, c_mktsegment, (c_custkey % 50)::DOUBLE AS x, 4::INT AS corners FROM customer")
def geojson_appended(spark, sf):
    """Polygons of all customers in growing collections: half, then all of them, of which the half is there already."""
    path = cuts.fresh_folder(spark, "geojson")
    squares = _squares(spark, sf)
    features.append(squares.where("c_custkey % 2 = 0"), path, "c_custkey")
    features.append(squares, path, "c_custkey")
    back = readers.polygons(readers.geojson(spark, f"{path}/*.geojson"))
    return back.select(F.col("properties")["c_custkey"].cast("long").alias("c_custkey"), F.col("properties")["c_mktsegment"].alias("c_mktsegment"), F.col("rings")[0][0][0].alias("x"), F.size(F.col("rings")[0]).alias("corners"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 50 BETWEEN 9 AND 20 AND c_custkey // 50 BETWEEN 0 AND 6")
def feature_load(spark, sf):
    """A scan of map features inside a box in two goes, the second of which takes the pages that came meanwhile; the first request finds nothing."""
    features.register(spark)
    path, out = cuts.fresh_folder(spark, "pages"), cuts.fresh_folder(spark, "load")
    page = F.struct(F.collect_list(F.struct(F.struct("c_custkey", "c_mktsegment").alias("attributes"), F.struct("rings").alias("geometry"))).alias("features"))
    pages = _squares(spark, sf).groupBy(F.floor(F.col("c_custkey") / 500).alias("n")).agg(F.to_json(page).alias("value"))
    options = {"path": path, "requests": '[{"where": {"c_mktsegment": "none"}}, {"bbox": [10, 1, 20, 6]}]'}
    last = pages.agg(F.max("n")).first()[0]
    for part in ("n <= {0} / 2", "n > {0} / 2"):
        features.landed(pages.where(part.format(last)), path)
        stream = spark.readStream.format("feature_pages").schema("c_custkey long, c_mktsegment string").options(**options).load()
        stream.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{out}-at").start(out).awaitTermination()
    return spark.read.schema("c_custkey long, c_mktsegment string").parquet(out)


@query("SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS day, o_orderstatus FROM orders")
def csv_round_trip(spark, sf):
    """Orders as CSV and back, all text first, then cast."""
    path = cuts.fresh_folder(spark, "csv")
    sinks.csv(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderstatus"), path)
    back = readers.text_table(spark, path)
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), r(F.col("o_totalprice").cast("double")).alias("o_totalprice"), F.col("day").cast("date").alias("day"), "o_orderstatus")


@query("SELECT o_orderkey, year(o_orderdate)::INT AS year, o_totalprice FROM orders WHERE year(o_orderdate) = 1996")
def partitioned_view(spark, sf):
    """One year of a table that was written by years: only its folder is read."""
    path = cuts.fresh_folder(spark, "view")
    sinks.parquet(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")), path, by=("year",))
    return spark.read.parquet(path).where("year = 1996").select("o_orderkey", F.col("year").cast("int").alias("year"), "o_totalprice")
