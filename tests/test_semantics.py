"""Hand-checked cases of the pinned semantics."""

import math

import pytest
from pyspark.sql import functions as F

from cellweave.functions import agronomy, geometry, names, projection, semantics, vectors
from cellweave.operators import labels, sampling, statistics, temporal
from cellweave.plans import view


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_missing_values_are_skipped(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (-9999.0,)], "v double").select(semantics.valid("v").alias("v"))
    row = df.agg(F.avg("v"), semantics.std_pop("v"), semantics.nan_sum("v")).first()
    assert tuple(row) == (1.5, 0.5, 3.0)
    none = df.where("v is null").agg(semantics.nan_sum("v"), F.avg("v")).first()
    assert tuple(none) == (0.0, None)


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    q = df.agg(*[statistics.quantile("v", x) for x in (0.02, 0.5, 0.98)]).first()
    assert [round(x, 6) for x in q] == [1.06, 2.5, 9.58]


def test_scalars(spark):
    assert tuple(one(spark, semantics.number(F.lit("abc")), semantics.zero_padded(F.lit("25")), semantics.zero_padded(F.lit("1234567")))) == (None, "00025", "1234567")
    p = F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))
    assert tuple(one(spark, semantics.first_argmax(p), vectors.top_k(p, 1))) == (1, [2])
    levels = [one(spark, agronomy.altitude_class(F.lit(x).cast("double")))[0] for x in (999.9, 1000.0, 2000.0, 3000.0, None)]
    assert levels == [0, 1, 2, 3, None]
    aspects = [tuple(round(v, 9) for v in one(spark, *[c.alias(n) for c, n in zip(agronomy.aspect_parts(F.lit(a).cast("double")), "sc", strict=True)])) for a in (0.0, 90.0, -1.0, None)]
    assert aspects == [(0, 1), (1, 0), (0, 0), (0, 0)]
    assert one(spark, semantics.floored(F.lit(None).cast("double"), 3.0))[0] is None
    uniform = F.array_repeat(F.lit(0.05), 20)
    assert round(one(spark, vectors.entropy(uniform))[0], 4) == round(math.log(20), 4)


def test_crop_names(spark):
    cases = {"Tomate de árbol": "Tomate_Arbol", "Tomate chonto": "Hortalizas", "Habichuela": "Habichuela", "Haba": "Hortalizas", "Cebolla de rama": "Hortalizas", "Trigo": "Otros_cultivos", None: "Otros_cultivos"}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {r[0]: r[1] for r in df.select("n", names.crop_class("n")).collect()} == cases


def test_shares_and_labels(spark):
    df = spark.createDataFrame([("m", "a", 60.0), ("m", "a", 20.0), ("m", "b", 20.0), ("z", "a", 0.0)], "r string, k string, area double")
    s = labels.shares(df, ["r"], "k", "area")
    assert {(x["r"], x["k"]): x["share"] for x in s.collect()} == {("m", "a"): 0.8, ("m", "b"): 0.2, ("z", "a"): 0.0}
    assert labels.dominant(s.where("r = 'm'"), ["r"], "k").first()["k"] == "a"
    votes = [one(spark, labels.unfit(F.lit(v), F.lit(n).cast("double")))[0] for v, n in ((3, None), (2, 0.10), (2, None))]
    assert votes == [True, True, False]


def test_anomaly_floor_and_gaps(spark):
    df = spark.createDataFrame([("A", 10.0), ("A", 10.0), ("A", 10.0), ("B", 0.0), ("B", 6.0)], "t string, v double")
    z = sorted(x[0] for x in df.select(temporal.anomaly("v", ["t"])).collect())
    assert z == [-1.0, 0.0, 0.0, 0.0, 1.0]
    gaps = spark.createDataFrame([(1, None), (2, 70.0), (3, None), (4, 74.0), (5, None)], "d int, v double").withColumn("k", F.lit(1))
    assert [x[0] for x in gaps.select("d", temporal.filled("v", ["k"], "d").alias("v")).orderBy("d").select("v").collect()] == [70.0, 70.0, 72.0, 74.0, 74.0]


def test_soft_rows_are_strict(spark):
    df = spark.createDataFrame([(1, 0.05, 0.95, 1.0)], "id int, prob_a double, prob_b double, c double")
    assert [r["kind"] for r in labels.expanded(df, ["id"], {"a": "prob_a", "b": "prob_b"}, "c").collect()] == ["b"]


def test_polygons(spark):
    square = F.array(F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))]))
    found = [one(spark, geometry.inside(F.lit(x), F.lit(y), square))[0] for x, y in ((0.5, 0.5), (1.5, 0.5), (0.0, 0.5), (1.0, 1.0), (0.5, 0.0))]
    assert found == [True, False, False, False, False]


def test_projection_round_trip_and_origin(spark):
    x, y = one(spark, *projection.to_metres(F.lit(projection.LON0), F.lit(projection.LAT0)))
    assert abs(x - 1e6) < 1e-6 and abs(y - 1e6) < 1e-6
    df = spark.range(50).select((F.lit(-75.0) + F.col("id") * 0.04).alias("lon"), (F.lit(3.7) + F.col("id") * 0.04).alias("lat"))
    x, y = projection.to_metres("lon", "lat")
    lon, lat = projection.to_degrees("x", "y")
    miss = df.withColumn("x", x).withColumn("y", y).select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(miss) * 111000 < 1e-3


@pytest.mark.parametrize("k", [2, 5])
def test_folds_are_disjoint_and_whole(spark, k):
    groups = spark.range(37).select(F.col("id").alias("g"), (F.col("id") * 7 % 11 + 1).alias("n"))
    rows = sampling.folds(groups, "g", "n", k).collect()
    assert len(rows) == 37 and {r["fold"] for r in rows} == set(range(k))
    assert {r["fold"] for r in sampling.group_split(groups, "g").collect()} == {"train", "valid", "test"}


def test_every_stratum_is_sampled(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 3, "rare").otherwise("common").alias("s"))
    q = {r["s"]: r["quota"] for r in sampling.quotas(df, ["s"], 100).collect()}
    assert q == {"rare": 1, "common": 99}
    kept = sampling.stratified(df, ["s"], "id", 100, F.col("id") % 50 == 0)
    assert kept.where("id % 50 = 0").count() == 20 and kept.count() == kept.distinct().count()


def test_view_contract(spark, sf):
    from cellweave.plans.catalog import QUERIES

    v = QUERIES["minable_view"](spark, sf)
    assert len(view.COLUMNS) == 77 and tuple(v.columns) == view.COLUMNS
    mass = sum((F.col(c) for c in view.SOFT), F.lit(0.0))
    assert v.where((F.abs(mass - 1) > 1e-9) & (mass != 0)).count() == 0
    assert v.select("pixel_id").distinct().count() == v.count() == v.agg(F.max("pixel_id") + 1).first()[0]
