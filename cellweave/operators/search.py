"""Search of parameters that learns from its trials: Parzen densities of good and other trials, pruning by the median, a stored study.

A study is a Parquet table with a row for each trial, written as trials end. A
trial's random choices follow from the seed and its number, so a search that is
stopped goes on as if it had not been. Trials of an older study can be taken
over first. Trials run one after another; each one's work is the caller's, in
Spark.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "trial int, parameters string, value double, state string, steps array<double>"


@dataclass(frozen=True)
class Span:
    """Numbers from low to high, whole ones or on a logarithmic scale if asked."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def inner(self, value: float) -> float:
        """The place in 0 .. 1."""
        a, b, v = (math.log(x) if self.log else x for x in (self.low, self.high, value))
        return (v - a) / (b - a) if b > a else 0.5

    def outer(self, place: float) -> float:
        a, b = (math.log(x) if self.log else x for x in (self.low, self.high))
        v = a + min(max(place, 0.0), 1.0) * (b - a)
        v = min(max(math.exp(v) if self.log else v, self.low), self.high)
        return int(round(v)) if self.whole else v


Space = dict[str, Span | Sequence]


class Pruned(Exception):
    """Raised by report() where a trial is not worth going on with."""


def densities(points: list[dict], space: Space, asked: list[dict]) -> np.ndarray:
    """Log density of each asked point under kernels around the points and a flat prior: products of cut normals and of smoothed shares."""
    n, width = len(points), 0.2 * max(len(points), 1) ** (-1 / (len(space) + 4))
    logs = np.zeros((len(asked), n + 1))
    for name, span in space.items():
        if isinstance(span, Span):
            x, at = np.array([span.inner(a[name]) for a in asked]), np.array([span.inner(p[name]) for p in points])
            normal = -0.5 * ((x[:, None] - at) / width) ** 2 - math.log(width * math.sqrt(2 * math.pi))
            erf = np.vectorize(math.erf, otypes=[float])
            inside = 0.5 * (erf((1 - at) / width / math.sqrt(2)) - erf(-at / width / math.sqrt(2))) if n else np.zeros(0)
            logs[:, :n] += normal - np.log(inside)
        else:
            same = np.array([[a[name] == p[name] for p in points] for a in asked], float).reshape(len(asked), n)
            logs[:, :n] += np.log((n * same + 1 / len(span)) / (n + 1)) if n else 0
            logs[:, n] -= math.log(len(span))
    top = logs.max(1)
    return top + np.log(np.exp(logs - top[:, None]).sum(1) / (n + 1))


def drawn(points: list[dict], space: Space, rng: np.random.Generator) -> dict:
    """A point from the kernels around the points, or from the flat prior."""
    n, width = len(points), 0.2 * max(len(points), 1) ** (-1 / (len(space) + 4))
    i, out = int(rng.integers(n + 1)), {}
    for name, span in space.items():
        if isinstance(span, Span):
            place = rng.random()
            if i < n:
                place = -1.0
                while not 0 <= place <= 1:
                    place = rng.normal(span.inner(points[i][name]), width)
            out[name] = span.outer(place)
        else:
            out[name] = points[i][name] if i < n and rng.random() < n / (n + 1) else span[int(rng.integers(len(span)))]
    return out


def suggested(done: list[tuple[dict, float]], space: Space, rng: np.random.Generator, startup: int = 5, candidates: int = 24) -> dict:
    """The next trial's parameters; done: parameters and values, larger ones better."""
    if len(done) < startup:
        return drawn([], space, rng)
    ranked = [p for p, _ in sorted(done, key=lambda d: -d[1])]
    good = ranked[: max(1, min(25, math.ceil(0.1 * len(ranked))))]
    asked = [drawn(good, space, rng) for _ in range(candidates)]
    gain = densities(good, space, asked) - densities(ranked[len(good) :], space, asked)
    return asked[int(gain.argmax())]


def hopeless(steps: list[float], others: list[list[float]], startup: int = 5) -> bool:
    """Whether the best value so far is under the median of what other trials had at this step."""
    reached = [o[len(steps) - 1] for o in others if len(o) >= len(steps)]
    return len(reached) >= startup and max(steps) < float(np.median(reached))


def study(spark: SparkSession, path: str) -> DataFrame:
    """All trials at path, the best first."""
    from ..sources import readers

    rows = spark.read.schema(SCHEMA).parquet(path) if readers.landed(spark, path) else spark.createDataFrame([], SCHEMA)
    return rows.orderBy(F.desc_nulls_last("value"), "trial")


def _kept(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def seeded(spark: SparkSession, path: str, older: str, where: str = "true") -> int:
    """Takes complete trials of an older study that pass `where` into an empty one; how many."""
    if study(spark, path).count():
        return 0
    rows = study(spark, older).where("state = 'complete'").where(where).orderBy("trial").collect()  # a row for each trial
    for i, r in enumerate(rows):
        _kept(spark, path, (i, r["parameters"], r["value"], "complete", r["steps"]))
    return len(rows)


def optimized(spark: SparkSession, path: str, space: Space, objective: Callable[[dict, Callable[[float], None]], float], trials: int, startup: int = 5, candidates: int = 24, seed: int = 42) -> DataFrame:
    """Runs trials until the study at path has `trials` of them, and returns it.

    objective(parameters, report) gives a value, the larger the better;
    report(value) tells of one on the way and raises Pruned below the median of
    the other trials there. Trials that raise anything else are not kept.
    """
    rows = [r.asDict() for r in study(spark, path).orderBy("trial").collect()]  # a row for each trial
    for number in range(len(rows), trials):
        done = [(json.loads(r["parameters"]), r["value"]) for r in rows if r["value"] is not None]
        parameters = suggested(done, space, np.random.default_rng([seed, number]), startup, candidates)
        steps: list[float] = []

        def report(value: float, steps: list[float] = steps) -> None:
            steps.append(float(value))
            if hopeless(steps, [r["steps"] for r in rows if r["state"] == "complete"], startup):
                raise Pruned

        try:
            value, state = float(objective(parameters, report)), "complete"
        except Pruned:
            value, state = max(steps), "pruned"
        row = {"trial": number, "parameters": json.dumps(parameters, sort_keys=True), "value": value, "state": state, "steps": steps}
        _kept(spark, path, tuple(row.values()))
        rows.append(row)
    return study(spark, path)
