"""Learning from bag proportions and boosted trees with one softmax, against finite differences and plain versions."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import boosting, learning, metrics, proportions
from cellweave.operators.proportions import Network


def network(kinds=4, seed=3):
    rng = np.random.default_rng(seed)
    m = Network.random(6, (9, 7, 5), kinds, 0.3, 0.2, seed)
    return replace(m, flat=m.flat + rng.normal(0, 0.1, len(m.flat)), medians=rng.normal(size=6), mean=rng.normal(size=6), std=1 + rng.random(6))


def test_gradient_of_the_swapped_loss_equals_finite_differences():
    m, rng = network(), np.random.default_rng(0)
    views, w = [rng.normal(size=(11, 6)) for _ in range(2)], np.array([0.5, 0.3, 0.2, 0.0])
    assigned = [proportions.sinkhorn(m.scores(m.forward(v)[0]), w, m.eps) for v in views]
    weight = proportions.row_weights(assigned[0], w)
    for dropout in (0.0, 0.3):
        both = lambda x: x.swapped(views, assigned, weight, [np.random.default_rng(s) for s in (1, 2)], dropout)  # noqa: B023, E731
        _, slope = both(m)
        for f, s in ((both, slope), (lambda x: x.apart(), m.apart()[1])):
            for i in rng.choice(len(m.flat), 60, replace=False).tolist() + list(range(len(m.flat) - 20, len(m.flat))):
                step = np.zeros_like(m.flat)
                step[i] = 1e-6
                near = (f(replace(m, flat=m.flat + step))[0] - f(replace(m, flat=m.flat - step))[0]) / 2e-6
                assert math.isclose(near, s[i], rel_tol=1e-4, abs_tol=1e-7)


def test_assignments_have_the_bags_masses():
    rng = np.random.default_rng(1)
    q = proportions.sinkhorn(rng.normal(size=(500, 3)), np.array([0.6, 0.3, 0.1]), 0.5, 50)
    assert np.allclose(q.sum(1), 1) and np.allclose(q.mean(0), [0.6, 0.3, 0.1], atol=1e-6)
    weight = proportions.row_weights(q, np.array([0.6, 0.3, 0.1]))
    assert math.isclose(weight.mean(), 1) and weight[q[:, 2] > 0.5].mean() > weight[q[:, 0] > 0.5].mean()


def test_views_of_a_chunk_are_the_same_on_every_run():
    m, x = network(), np.random.default_rng(2).normal(size=(8, 6))
    x[2, 3] = np.nan
    one, two, other = (m.bag_slope(x, np.full(4, 0.25), ["s2"] * 6, [42, e, 7], 0.2) for e in (1, 1, 2))
    assert one[0] == two[0] and np.array_equal(one[1], two[1]) and one[0] != other[0] and np.isfinite(one[1]).all()


@pytest.fixture(scope="module")
def bags(spark):
    """Three classes around three points, in 12 bags of very different sizes and mixes, with awkward rows."""
    rng, rows, shares = np.random.default_rng(5), [], []
    centres = np.array([[4.0, 0, 0, 1], [0, 4.0, 0, 1], [0, 0, 4.0, 1]])
    for bag in range(12):
        mix = rng.dirichlet([0.5] * 3)
        kinds = rng.choice(3, 900 if bag == 3 else 60, p=mix)
        rows += [(bag, len(rows) + i, (centres[k] + rng.normal(size=4)).tolist(), int(k)) for i, k in enumerate(kinds)]
        shares.append((bag, [7 * float((kinds == k).mean()) for k in range(3)]))
    rows += [(0, 10_000, [None, float("nan"), 0.0, 1.0], 2), (None, 10_001, [0.0] * 4, 0), (1, 10_002, None, 0), (99, 10_003, [0.0] * 4, 0), (98, 10_004, [0.0] * 4, 0)]
    shares += [(98, [0.0, 0.0, 0.0])]
    return spark.createDataFrame(rows, "bag int, id long, x array<double>, kind int"), spark.createDataFrame(shares, "bag int, w array<double>")


def test_chunks_hold_each_row_once(bags):
    rows, shares = bags
    dealt = proportions.chunks(rows, shares, "bag", "id", "x", F.col("bag") == 2, 100).collect()
    assert sum(len(r["x"]) for r in dealt) == 900 + 11 * 60 + 1
    large = [len(r["x"]) for r in dealt if r["bag"] == 3]
    assert len(large) == 9 and max(large) < 150 and {r["chunks"] for r in dealt if r["bag"] == 3} == {9}
    assert all(math.isclose(sum(r["w"]), 1) for r in dealt) and {r["bag"] for r in dealt if r["held"]} == {2}


def test_proportions_teach_the_classes(spark, bags, tmp_path):
    rows, shares = bags
    train = lambda epochs, frozen: proportions.train(rows, shares, "bag", "id", "x", ["otro"] * 4, F.col("bag") % 4 == 2, (16, 8), epochs, 2, 200, 2, 0.03, 1e-3, 1e-4, 1.0, frozen, 0.2, 0.1, 0.05, 0.1)
    model, log, prior = train(10, 1)
    assert len(log) == 10 and min(e[3] for e in log) < 0.25 * prior and log[-1][2] < log[1][2]
    top = F.array_position("p", F.array_max("p")) - 1
    right = learning.infer(rows.where("bag is not null and x is not null"), "id", "x", model, "kind").agg(F.avg((top == F.col("kind")).cast("int"))).first()[0]
    assert right > 0.9
    path = str(tmp_path / "model")
    model.save(spark, path)
    x = np.random.default_rng(0).normal(size=(5, 4))
    assert np.array_equal(Network.load(spark, path).chances(x), model.chances(x))
    still, _, _ = train(2, 2)
    start = Network.random(4, (16, 8), 3, seed=42).arrays()
    assert np.array_equal(still.arrays()["prototypes"], start["prototypes"]) and not np.array_equal(still.arrays()["w0"], start["w0"])


def test_no_bag_to_learn_from_raises(bags):
    rows, shares = bags
    with pytest.raises(ValueError):
        proportions.train(rows.where("false"), shares, "bag", "id", "x", ["otro"] * 4, F.lit(False))


# boosted trees under one softmax


def plain_boosting(x, y, w, kinds, bounds, rounds, depth, rate, gamma, alpha, strength, least):
    """Margins after each round, by trying every split of every node."""
    f, out = np.zeros((len(x), kinds)), []
    soft = lambda g: math.copysign(max(abs(g) - alpha, 0), g)
    score = lambda g, h: soft(g) ** 2 / (h + strength)

    def grow(rows, g, h, level, change):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (gamma, None)
        if level < depth:
            for j in range(x.shape[1]):
                for b in bounds[j]:
                    for missing_left in (False, True):
                        go = np.where(np.isnan(x[rows, j]), missing_left, x[rows, j] < b)
                        left, right = rows[go], rows[~go]
                        if h[left].sum() < least or h[right].sum() < least:
                            continue
                        gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(gs, hs)
                        if gain > best[0] + 1e-9:
                            best = (gain, (left, right))
        if best[1] is None:
            change[rows] = -rate * soft(gs) / (hs + strength)
        else:
            for part in best[1]:
                grow(part, g, h, level + 1, change)

    for _ in range(rounds):
        p = np.exp(f - f.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = f.copy()
        for k in range(kinds):
            change = np.zeros(len(x))
            grow(np.arange(len(x)), w * (p[:, k] - (y == k)), 2 * w * p[:, k] * (1 - p[:, k]), 0, change)
            new[:, k] += change
        f = new
        out.append(f)
    return out


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = np.where(x[:, 0] * x[:, 1] > 0, np.where(x[:, 2] > 0.3, 2, 1), 0)
    x[rng.random(x.shape) < 0.1] = np.nan
    w = rng.integers(1, 4, 300) / 2
    rows = spark.createDataFrame([(i, [None if np.isnan(v) and i % 2 else float(v) for v in x[i]], int(y[i]), float(w[i])) for i in range(300)], "id long, x array<double>, y int, w double")
    return x, y, w, rows


def test_trees_equal_a_plain_version(classes):
    x, y, w, rows = classes
    settings = {"rounds": 3, "depth": 3, "rate": 0.3, "gamma": 0.4, "alpha": 0.2, "strength": 1.5, "least": 2.0}
    model, log = boosting.fit(rows.repartition(3), "x", "y", 3, "id", F.col("w"), bins=8, patience=10, cut_every=2, **settings)
    margins = plain_boosting(x, y, w, 3, model.bounds, **settings)
    assert np.allclose(model.margins(model.binned(x), model.trees), margins[-1], atol=1e-9) and len(model.trees) == 3
    logs = margins[-1] - np.log(np.exp(margins[-1]).sum(1, keepdims=True))
    assert math.isclose(log[-1][1], -(w * logs[np.arange(300), y]).sum() / w.sum(), rel_tol=1e-9)
    assert [e[0] for e in log] == [0, 1, 2, 3] and math.isclose(log[0][1], math.log(3))
    gains = model.gains()
    assert all(g > 0.4 * n for g, n in gains if n) and sum(n for _, n in gains) == sum(f >= 0 for t in sum(model.trees, []) for f in t.feature)


def test_fit_stops_on_held_out_rows_and_is_kept(spark, classes, tmp_path):
    x, y, _, rows = classes
    noisy = rows.withColumn("y", F.when(F.col("id") % 3 == 0, (F.col("id") % 3).cast("int")).otherwise(F.pmod(F.xxhash64("id"), F.lit(3)).cast("int")))
    model, log = boosting.fit(noisy, "x", "y", 3, "id", held=F.col("id") % 4 == 0, rounds=30, depth=4, patience=3, least=0.1, rows_share=0.7, columns_share=0.7)
    best = min(log, key=lambda e: e[2])[0]
    assert len(model.trees) == best and len(log) <= best + 4 < 30
    again, _ = boosting.fit(noisy, "x", "y", 3, "id", held=F.col("id") % 4 == 0, rounds=30, depth=4, patience=3, least=0.1, rows_share=0.7, columns_share=0.7)
    assert np.array_equal(again.chances(x), model.chances(x))
    good, _ = boosting.fit(rows, "x", "y", 3, "id", rounds=8, depth=4)
    assert (good.chances(x).argmax(1) == y).mean() > 0.95
    path = str(tmp_path / "trees")
    good.save(spark, path)
    assert np.array_equal(boosting.Boosted.load(spark, path).chances(x), good.chances(x))


def test_fit_stops_on_a_measure(classes):
    _, _, _, rows = classes
    two = rows.withColumn("y", (F.col("y") > 0).cast("int"))
    measure = lambda held: -metrics.auc(held.select("y", F.get("p", F.lit(1)).alias("s"), "w"), "y", "s", "w").first()["average_precision"]
    model, log = boosting.fit(two, "x", "y", 2, "id", held=F.col("id") % 3 == 0, rounds=4, depth=2, patience=2, measure=measure, class_weights=(1.0, 2.0))
    assert all(-1 <= e[2] <= 0 for e in log) and len(model.trees) == min(log, key=lambda e: e[2])[0]


def test_awkward_rows_of_boosting(spark, classes):
    _, _, _, rows = classes
    odd = spark.createDataFrame([(900, [1.0, 2.0, 3.0], None, 1.0), (901, None, 1, 1.0), (902, [1.0, 2.0, 3.0], 7, 1.0), (903, [1.0, 2.0, 3.0], 1, None), (904, [1.0, 2.0, 3.0], 1, 0.0)], rows.schema)
    fitted = lambda d: boosting.fit(d, "x", "y", 3, "id", F.col("w"), rounds=1, depth=2)[0]
    x = np.random.default_rng(1).normal(size=(20, 3))
    assert np.allclose(fitted(rows.unionByName(odd)).chances(x), fitted(rows).chances(x))
    flat = rows.withColumn("x", F.array(F.lit(1.0), F.lit(None).cast("double"), F.lit(float("nan"))))
    assert all(f == [-1] for t in boosting.fit(flat, "x", "y", 3, "id", rounds=1)[0].trees for f in [t[0].feature])
    with pytest.raises(ValueError):
        boosting.fit(rows.where("false"), "x", "y", 3, "id")


def test_letters_are_counted_once_in_whole_texts(spark, tmp_path):
    from cellweave.plans import learned

    texts = ["", None, "aAá ßß\U0001f600\ne", "\x00su" * 700, "ÃßŸ\u009fß", "dead"]
    spark.createDataFrame([(i, t, "es" if i < 5 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    found = learned.letters(spark, str(tmp_path))
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()  # nothing that follows reads the texts again
    rows = {r["doc_id"]: (r["kind"], r["x"]) for r in found.collect()}
    assert rows == {i: (2, [(t or "").count(c) / max(1, len(t or "")) for c in learned.LETTERS]) for i, t in enumerate(texts[:5])}
    assert learned.letters(spark, str(tmp_path)).where("false").count() == 0
