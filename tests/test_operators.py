"""Iterative operators against brute force, and grids."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.operators import grid, learning, metrics, ordered, statistics


@pytest.mark.parametrize("seed", range(5))
def test_assignment_is_optimal(seed):
    cost = np.random.default_rng(seed).random((5, 5))
    best = min(sum(cost[i, p[i]] for i in range(5)) for p in itertools.permutations(range(5)))
    assert abs(sum(cost[i, j] for i, j in enumerate(learning.assignment(cost))) - best) < 1e-12


def test_ward_keeps_clusters_together():
    points = np.array([[0.0], [10.0], [0.1], [10.1], [0.2]])
    order = learning.ward_order(points)
    assert sorted(order) == list(range(5)) and {frozenset(order[:3]), frozenset(order[:2])} & {frozenset({0, 2, 4}), frozenset({1, 3})}


def test_kriging_is_exact_at_stations_and_constant_for_constants(spark):
    rng = np.random.default_rng(3)
    xy = rng.random((12, 2)) * 10
    values = xy[:, 0] * 2 + rng.random(12)
    stations = spark.createDataFrame([("a", float(x), float(y), float(v)) for (x, y), v in zip(xy, values, strict=True)] + [("b", float(i), 0.0, 7.0) for i in range(5)] + [("c", 1.0, 1.0, 1.0)], "period string, x double, y double, value double")
    cells = spark.createDataFrame([(i, 0, float(x), float(y)) for i, (x, y) in enumerate(xy)], "row int, col int, x double, y double")
    out = {(r["period"], r["row"]): r["value"] for r in learning.kriged(stations, cells).collect()}
    assert {p for p, _ in out} == {"a", "b"}
    assert all(abs(out["a", i] - values[i]) < 1e-6 for i in range(12)) and all(abs(out["b", i] - 7) < 1e-9 for i in range(12))


def test_kriged_cells_are_dealt_to_all_tasks(spark):
    stations = spark.createDataFrame([(p, float(i % 3), float(i // 3), float((i * k) % 7)) for p, k in (("a", 3), ("b", 5)) for i in range(9)], "period string, x double, y double, value double")
    cells = spark.range(0, 1500, 1, 1).select((F.col("id") / 40).cast("int").alias("row"), (F.col("id") % 40).cast("int").alias("col"), (F.col("id") / 500).alias("x"), F.when(F.col("id") > 0, F.col("id") % 40 / 13).alias("y"))
    out = learning.kriged(stations, cells)
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    found = {(r["period"], r["row"], r["col"]): r["value"] for r in out.collect()}
    assert len(found) == out.count() == 3000 and found["a", 0, 0] != found["b", 0, 0]
    some = {(r["period"], r["row"], r["col"]): r["value"] for r in learning.kriged(stations, cells.where("col = 7"), block=1).collect()}
    assert len(some) == 76 and all(found[k] == v for k, v in some.items())


def test_wetness_grows_downhill():
    rows = [(r, c, float(10 - r + abs(c - 2))) for r in range(6) for c in range(5)]
    out = learning.wetness(pd.DataFrame(rows, columns=["row", "col", "value"]), 1.0)
    valley = out[out["col"] == 2].sort_values("row")["twi"].to_numpy()
    assert len(out) == 30 and valley[-2] > valley[0]


def test_terrain_of_planes(spark):
    plane = grid.grid(spark, 5, 5).select("row", "col", F.col("col").cast("double").alias("value"))
    t = grid.terrain(plane, 5, 5, 1.0).where("col between 1 and 3").select("slope_pct").distinct().collect()
    assert [round(r[0], 9) for r in t] == [100.0]
    flat = grid.terrain(plane.withColumn("value", F.lit(3.0)), 5, 5, 1.0)
    assert flat.select("aspect").distinct().collect()[0][0] == -1.0


def test_cubic_keeps_linear_fields(spark):
    source = grid.grid(spark, 8, 8).select("row", "col", (F.col("row") * 2.0 + F.col("col")).alias("value"))
    target = spark.createDataFrame([(3, 3)], "row int, col int")
    out = grid.resample_kernel(source, target, F.col("row") + 0.25, F.col("col") + 0.5, "cubic").first()["value"]
    assert abs(out - (3.25 * 2 + 3.5)) < 1e-9


def test_last_shape_wins(spark):
    ring = lambda a, b: [[[a, 0.0], [b, 0.0], [b, 10.0], [a, 10.0], [a, 0.0]]]
    shapes = spark.createDataFrame([(1, 1, ring(0.0, 6.0)), (2, 2, ring(4.0, 10.0))], "ord int, value int, rings array<array<array<double>>>")
    out = grid.burn(grid.grid(spark, 10, 10), shapes, 1.0, 0.0, 10.0).groupBy("value").count().collect()
    assert {r["value"]: r["count"] for r in out} == {1: 40, 2: 60}


def test_area_of_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    row = metrics.auc(df, "y", "p").first()
    assert abs(row["roc_auc"] - 0.875) < 1e-12 and abs(row["average_precision"] - (0.5 + 0.5 * 2 / 3)) < 1e-12


def test_pruning_drops_one_of_a_pair():
    assert statistics.pruned([("a", "b", 0.99), ("a", "c", 0.2), ("b", "c", 0.5)]) == ["b"]


def test_random_search_is_seeded():
    space = {"a": (1, 2, 3), "b": (0.1, 0.2)}
    assert learning.random_search(space, 10) == learning.random_search(space, 10) and len(learning.random_search(space, 10)) == 6


def test_new_rows_lie_between_neighbours_of_the_class(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "big", rng.normal(size=3).tolist()) for i in range(40)] + [(100 + i, "small", (rng.normal(size=3) + 9).tolist()) for i in range(13)] + [(200, "one", [5.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, "id long, kind string, x array<double>")
    near = {r["key"]: r["near"] for r in learning.nearest_of_kind(df, "kind", "id", "x", 5, block=4).collect()}
    small = {i: np.array(x) for i, k, x in rows if k == "small"}
    for i, x in small.items():
        want = sorted((((x - y) ** 2).sum(), j) for j, y in small.items() if j != i)[:5]
        assert np.allclose(near[i], [small[j] for _, j in want])
    made = learning.oversampled(df, "kind", "id", "x").collect()
    assert sorted({r["kind"] for r in made}) == ["one", "small"] and sum(r["kind"] == "small" for r in made) == 27 and sum(r["kind"] == "one" for r in made) == 39
    assert all(r["x"] == [5.0, 5.0, 5.0] for r in made if r["kind"] == "one")
    for r in made:
        if r["kind"] == "small":
            assert any(abs(np.linalg.norm(r["x"] - a) + np.linalg.norm(r["x"] - np.array(b)) - np.linalg.norm(a - np.array(b))) < 1e-9 for i, a in small.items() for b in near[i])
    assert sorted(map(str, made)) == sorted(map(str, learning.oversampled(df.repartition(5), "kind", "id", "x").collect()))


def test_a_search_goes_on_where_it_stopped(spark, tmp_path):
    asked = []
    score = lambda t: asked.append(t["a"]) or t["a"] / 10
    path = str(tmp_path / "study")
    assert learning.searched(spark, path, [{"a": 1}, {"a": 2}], score).count() == 2
    best = learning.searched(spark, path, [{"a": 1}, {"a": 2}, {"a": 3}], score).first()
    assert asked == [1, 2, 3] and best["score"] == 0.3


def test_encoder_chances_sum_to_one():
    p = learning.Encoder.random(6, (8, 8), 4).chances(np.array([[1, 2, np.nan, 0, 1, 2.0], [0] * 6]))
    assert np.allclose(p.sum(1), 1) and np.allclose(learning.orthogonal_prototypes(4, 8) @ learning.orthogonal_prototypes(4, 8).T, np.eye(4))


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    model, x = learning.Encoder.random(5, (7, 6, 4), 3, seed=2, tau=0.5), rng.normal(size=(9, 5))
    target, weight = rng.dirichlet(np.ones(3), 9), rng.random(9)
    _, slope = model.slopes(x, target, weight)
    flat = model.flat()
    for i in rng.choice(len(flat), 25, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-5
        up, down = (model.with_weights(flat + d * step).slopes(x, target, weight)[0] for d in (1, -1))
        assert abs((up - down) / 2e-5 - slope[i]) < 1e-5


def test_training_lowers_the_loss_and_models_reload(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) + 3 * np.eye(6)[i % 3]).tolist() if i % 50 else [float("nan")] * 6, np.eye(3)[i % 3].tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x array<double>, q array<double>").repartition(3)
    model, log = learning.train_encoder(df, "x", "q", F.lit(1.0), F.col("id") % 5 == 0, (16, 8), 12, peak=0.05)
    again = learning.train_encoder(df, "x", "q", F.lit(1.0), F.col("id") % 5 == 0, (16, 8), 12, peak=0.05)[1]
    assert log[-1][2] < 0.6 * log[0][2] and np.allclose([r[2] for r in log], [r[2] for r in again])
    model.save(spark, str(tmp_path / "m"))
    x = np.array([r[1] for r in rows])
    assert np.allclose(model.chances(x), learning.Encoder.load(spark, str(tmp_path / "m")).chances(x))
    found = learning.infer(df, "id", "x", model, "q")
    hits = [np.argmax(r["p"]) == np.argmax(r["q"]) for r in found.collect()]
    assert np.mean(hits) > 0.85 and found.columns == ["id", "p", "q"]
    assert [round(learning.learning_rate(e, 2, 6, 1.0), 3) for e in range(6)] == [0.5, 1.0, 1.0, 0.854, 0.5, 0.146]


def test_boosting_stops_by_precision_and_knows_several_classes(spark):
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b), float(a + 0.3 * b > 0), float((a > 0) + (b > 0.5))) for a, b in rng.normal(size=(400, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double, kind double")
    model = learning.boosted_binary(df, ["a", "b"], "y", rounds=3, depth=2)
    by = learning.boosted_stop(model, df, ["a", "b"], "y")
    assert len(by) == 3 and by[-1] > 0.9
    from pyspark.ml.functions import vector_to_array

    whole = learning.staged(model.transform(learning.assemble(df, ["a", "b"])).select("a", "b", vector_to_array("probability")[1].alias("want")), model, ["a", "b"])
    assert all(abs(r["chances"][-1] - r["want"]) < 1e-9 for r in whole.collect())
    several = learning.class_chances(df, learning.boosted_multiclass(df, ["a", "b"], "kind", 3, 3), ["a", "b"]).collect()
    assert all(abs(sum(r["p"]) - 1) < 1e-9 for r in several) and np.mean([np.argmax(r["p"]) == r["kind"] for r in several]) > 0.9


def test_families_of_features_are_augmented_apart(spark):
    families = F.array(*[F.lit(x) for x in ("topo", "clima", "s2", "rest")])
    df = spark.range(4000).select("id", learning.augmented_by_family(F.array(*[F.lit(10.0)] * 4), families, F.col("id")).alias("x"))
    x = np.array([r["x"] for r in df.orderBy("id").collect()])
    assert np.allclose((abs(x) < 5).mean(0), [0, 0.1, 0.2, 0.1], atol=0.02)
    assert np.allclose([x[:, i][x[:, i] > 5].std() for i in range(4)], [0.01, 0.05, 0.05, 0.025], rtol=0.1)


def test_an_outlier_leaves_the_buckets_even(spark):
    df = spark.range(20000).select(F.when(F.col("id") == 7, 1e15).otherwise(F.col("id").cast("double")).alias("v"), F.lit(1).alias("n"))
    at = ordered.running(df.withColumn("b", F.lit(0)), "v", {"upto": "n"}, buckets=50)
    assert [r["upto"] for r in at.orderBy("v").collect()] == list(range(1, 20001))
    edges = df.agg(F.percentile_approx("v", [i / 50 for i in range(1, 50)], 1000).alias("_e"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.slice("_e", i * 7 + 1, F.lit(7)))
    dealt = df.crossJoin(edges.select(blocks.alias("_blocks"))).groupBy(ordered._bucket(F.col("v"), "_blocks").alias("b")).count().collect()
    assert len(dealt) == 50 and max(r["count"] for r in dealt) < 2 * 400
    # brackets narrower than the group: the same quantiles as numpy's
    wide = df.select(F.lit("a").alias("name"), F.col("v").alias("value"))
    got = {r["q"]: r["value"] for r in ordered.quantiles(wide, [0.0, 0.3, 0.5, 0.999, 1.0], accuracy=500).collect()}
    values = np.arange(20000.0)
    values[7] = 1e15
    assert all(abs(v - np.quantile(values, q)) < 1e-6 * max(1, abs(v)) for q, v in got.items()) and len(got) == 5


def test_running_sums_and_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(size=400).round(2), "b": np.array([3.0]), "c": np.repeat([1.0, 2.0], 50)}
    df = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v] + [("a", None)], "name string, value double")
    wanted = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    found = {(r["name"], r["q"]): r["value"] for r in ordered.quantiles(df, wanted).collect()}
    assert all(abs(found[k, q] - np.quantile(v, q)) < 1e-9 for k, v in values.items() for q in wanted) and len(found) == 18
    scores = spark.createDataFrame([(float(x), 1) for x in np.unique(values["a"])], "s double, n int")
    for down in (False, True):
        rows = sorted(ordered.running(scores, "s", {"upto": "n"}, descending=down, buckets=7).collect(), key=lambda r: r["s"], reverse=down)
        assert [r["upto"] for r in rows] == list(range(1, len(rows) + 1))
    assert ordered.quantiles(df.limit(0), wanted).collect() == []


def test_nearest_of_kind_sends_keys_and_keeps_ties(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 4)) + 1e6, np.ones((40, 4)), [[np.inf, 0.0, 0.0, 0.0]]])  # far from 0, where products round, and many copies
    df = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(x)], "id long, kind string, x array<double>")
    for block in (16, 1000):
        out = learning.nearest_of_kind(df, "kind", "id", "x", 3, block)
        met = [line for line in out._jdf.queryExecution().analyzed().toString().splitlines() if "FlatMapGroupsInArrow" in line]
        assert met and all(line.rsplit("[", 1)[1].count("#") == 3 for line in met)  # one row of keys and distances for a row and a pair of blocks, no vectors
        near = {r["key"]: r["near"] for r in out.collect()}
        with np.errstate(invalid="ignore"):
            for i in range(100):
                want = sorted((((x[j] - x[i]) ** 2).sum(), j) for j in range(100) if j != i)[:3]
                assert near[i] == [x[j].tolist() for _, j in want]
        assert near[100] is None
