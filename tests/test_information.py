"""Neighbour information against plain loops, folds against going round."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import information


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def plain_information(rows, k):
    rows = [(v, c) for v, c in rows if v is not None and not math.isnan(v) and c is not None]
    of = Counter(c for _, c in rows)
    rows = [(v, c) for v, c in rows if of[c] > 1]
    if not rows:
        return None
    out = psi(len(rows))
    for i, (v, c) in enumerate(rows):
        mine = min(k, of[c] - 1)
        r = sorted(abs(w - v) for j, (w, d) in enumerate(rows) if d == c and j != i)[mine - 1]
        within = sum(v - r * (1 - 1e-9) <= w <= v + r * (1 - 1e-9) for w, _ in rows)
        out += (psi(mine) - psi(of[c]) - psi(within)) / len(rows)
    return max(0.0, out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("digits", [0, 3])
def test_information_equals_plain_loops(spark, monkeypatch, seed, digits):
    monkeypatch.setattr(information, "BLOCK", 7)
    rng = np.random.default_rng(seed)
    kinds = rng.integers(0, 3, 120)
    rows = [(float(v), int(c)) for v, c in zip(np.round(rng.normal(size=120) * 4 + kinds * seed, digits), kinds, strict=True)] + [(None, 1), (1.0, None), (float("nan"), 0), (2.0, 9), (5.0, 8), (6.0, 8)]
    df = spark.createDataFrame(rows, "v double, c int")
    for k in (1, 3):
        assert information.information(df, "v", "c", k).first()[0] == pytest.approx(plain_information(rows, k), abs=1e-9)


def test_information_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 1)], "v double, c int")
    assert information.information(df, "v", "c").first()[0] is None and information.information(df.where("false"), "v", "c").first()[0] is None


def test_digamma(spark):
    found = spark.range(1, 400).select("id", information.digamma(F.col("id").cast("double")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(psi(r["id"]), abs=1e-9) for r in found)


@pytest.mark.parametrize("shard", [4096, 40])
def test_folds_are_no_more_uneven_than_going_round(spark, shard):
    rng = np.random.default_rng(shard)
    counts = np.array([rng.multinomial(int(rng.pareto(1.1) * 20) + 1, rng.dirichlet([0.3] * 4)) for _ in range(120)])
    groups = spark.createDataFrame([(i, [None if v == 0 else int(v) for v in c]) for i, c in enumerate(counts)], "g int, counts array<int>")
    found = {r["g"]: r["fold"] for r in information.balanced_folds(groups, "g", "counts", 5, shard).collect()}
    assert set(found) == set(range(120)) and set(found.values()) == set(range(5))
    table = lambda fold: np.array([sum((counts[g] for g in range(120) if fold[g] == f), np.zeros(4)) for f in range(5)])
    order = sorted(range(120), key=lambda g: (counts[g].argmax(), -counts[g].sum()))
    round_ = {g: (i % 5 if i // 5 % 2 == 0 else 4 - i % 5) for i, g in enumerate(order)}
    assert information.spread(table(found)) <= information.spread(table(round_))
    assert {r["g"]: r["fold"] for r in information.balanced_folds(groups.orderBy("g"), "g", "counts", 5, shard).collect()} == found
    assert information.balanced_folds(groups.where("false"), "g", "counts", 5).count() == 0
