"""The search against a random one, its study across stops, pruning and seeding."""

import json
import math

import numpy as np
import pytest

from cellweave.operators import cuts, search
from cellweave.operators.search import Span

SPACE = {"x": Span(-5.0, 10.0), "rate": Span(1e-4, 1.0, log=True), "n": Span(1, 9, whole=True), "kind": ("a", "b", "c")}


def surface(p):
    """Best at x = 2, rate = 0.01, n = 4, kind = b."""
    return -((p["x"] - 2) ** 2) / 10 - math.log10(p["rate"] / 0.01) ** 2 - abs(p["n"] - 4) / 4 - (p["kind"] != "b")


def best_of(seed, trials, learn):
    done = []
    for i in range(trials):
        rng = np.random.default_rng([seed, i])
        p = search.suggested(done, SPACE, rng) if learn else search.drawn([], SPACE, rng)
        done.append((p, surface(p)))
    return max(v for _, v in done)


def test_it_beats_a_random_search():
    learned, random = ([best_of(seed, 60, learn) for seed in range(12)] for learn in (True, False))
    assert np.mean(learned) > np.mean(random) + 0.15 and sum(a > b for a, b in zip(learned, random, strict=True)) >= 9


def test_parameters_stay_in_their_spans():
    rng = np.random.default_rng(0)
    points = [{"x": 10.0, "rate": 1.0, "n": 9, "kind": "a"}, {"x": -5.0, "rate": 1e-4, "n": 1, "kind": "a"}]
    for _ in range(300):
        p = search.drawn(points, SPACE, rng)
        assert -5 <= p["x"] <= 10 and 1e-4 <= p["rate"] <= 1 and p["n"] in range(1, 10) and p["kind"] in "abc"


def test_densities_add_to_one():
    space = {"x": Span(0.0, 2.0), "kind": ("a", "b")}
    points = [{"x": 0.1, "kind": "a"}, {"x": 1.5, "kind": "b"}, {"x": 1.6, "kind": "b"}]
    grid = [{"x": (i + 0.5) / 500, "kind": k} for i in range(1000) for k in "ab"]
    assert np.exp(search.densities(points, space, grid)).sum() / 1000 == pytest.approx(1, abs=1e-3)
    assert np.exp(search.densities([], space, grid)).mean() == pytest.approx(0.5)


def test_a_stopped_study_goes_on_as_if_it_had_not(spark):
    def objective(p, report):
        for i in range(3):
            report(surface(p) - (2 - i) * 0.1)
        return surface(p)

    whole, parts = cuts.fresh_folder(spark, "study"), cuts.fresh_folder(spark, "study")
    one = search.optimized(spark, whole, SPACE, objective, 10).collect()
    search.optimized(spark, parts, SPACE, objective, 4)

    def fails(p, report):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        search.optimized(spark, parts, SPACE, fails, 10)
    assert search.optimized(spark, parts, SPACE, objective, 10).collect() == one
    assert [r["value"] for r in one] == sorted((r["value"] for r in one), reverse=True)
    assert {r["state"] for r in one} == {"complete", "pruned"} and all(len(r["steps"]) == 3 for r in one if r["state"] == "complete")
    newer = cuts.fresh_folder(spark, "study")
    taken = search.seeded(spark, newer, whole, "value < -0.5")
    assert taken == sum(r["state"] == "complete" and r["value"] < -0.5 for r in one) > 0 and search.seeded(spark, newer, whole) == 0
    assert search.optimized(spark, newer, SPACE, objective, taken + 1).count() == taken + 1
    assert set(json.loads(one[0]["parameters"])) == set(SPACE)


def test_pruning_needs_other_trials():
    others = [[1.0, 2.0], [3.0, 4.0], [5.0]]
    assert search.hopeless([2.0], others, 3) and not search.hopeless([3.0], others, 3) and not search.hopeless([0.0, 0.0], others, 3)
    assert search.hopeless([0.0, 2.5], others, 2) and not search.hopeless([3.5, 0.0], others, 2)
