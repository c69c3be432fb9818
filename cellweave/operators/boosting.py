"""Gradient-boosted trees for several classes under one softmax.

Each round grows one tree a class on the first and second derivatives of the
weighted softmax loss. Features are cut at quantiles of the training rows into
bins; in each level every task sums derivatives by (class, node, feature, bin)
over its rows in numpy, the sums are added in Spark, and the driver, which gets
about the square root of the tasks of them, picks the splits: at most
classes x nodes x features x bins pairs of numbers, whatever the rows. A split
must gain more than `gamma`; leaves are shrunk by an L1 (`alpha`) and an L2
(`strength`) penalty; missing values go to the side that gains more. Rows keep
their margins from round to round; every `cut_every` rounds they are written to
the shared folder.

Fitting stops `patience` rounds after the best one by the held-out rows' loss,
or by a `measure` of the held-out rows, and the trees up to the best one stay.

Defined cases: null and NaN features are missing; rows without label or weight,
or with a label outside 0 .. kinds - 1, take no part; weights of 0 count nothing;
no held-out rows: the training loss decides; no training rows raise; a feature of
one value is never split; a repeated row counts each time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cuts import cut
from .proportions import added, log_softmax

SCHEMA = "u long, x array<smallint>, y int, w double, held boolean, f array<double>"


@dataclass
class Tree:
    """Nodes in order of growth: `feature` -1 is a leaf; left if bin <= cut; the missing bin goes left where `missing_left`."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, missing_left: bool, gain: float) -> None:
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, at, missing_left, gain
        for side in (self.left, self.right):
            side[node] = len(self.feature)
            for name, empty in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", -1), ("right", -1), ("value", 0.0), ("gain", 0.0)):
                getattr(self, name).append(empty)

    def leaves(self, x: np.ndarray, missing: int) -> np.ndarray:
        """The node each row of bins ends in."""
        feature, at, left, right, miss = (np.array(v) for v in (self.feature, self.cut, self.left, self.right, self.missing_left))
        node = np.zeros(len(x), int)
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return node
            n = node[inner]
            b = x[inner, feature[n]]
            node[inner] = np.where(np.where(b == missing, miss[n], b <= at[n]), left[n], right[n])


@dataclass
class Boosted:
    """Trees by round and class, over features cut at `bounds`; a value lies in the bin of the bounds up to it."""

    bounds: list[np.ndarray]
    kinds: int
    trees: list[list[Tree]] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return max((len(b) for b in self.bounds), default=0) + 1

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.stack([np.searchsorted(b, x[:, j], "right") for j, b in enumerate(self.bounds)], 1).astype(np.int16)
        return np.where(np.isnan(x), np.int16(self.missing), out)

    def margins(self, bins: np.ndarray, trees: Sequence[Sequence[Tree]]) -> np.ndarray:
        out = np.zeros((len(bins), self.kinds))
        for grown in trees:
            for k, tree in enumerate(grown):
                out[:, k] += np.array(tree.value)[tree.leaves(bins, self.missing)]
        return out

    def chances(self, x: np.ndarray) -> np.ndarray:
        return np.exp(log_softmax(self.margins(self.binned(x), self.trees)))

    def gains(self) -> list[tuple[float, int]]:
        """For each feature the sum of its splits' gains, and how many there are."""
        out = [[0.0, 0] for _ in self.bounds]
        for tree in (t for grown in self.trees for t in grown):
            for j, g in zip(tree.feature, tree.gain, strict=True):
                if j >= 0:
                    out[j][0] += g
                    out[j][1] += 1
        return [(g, n) for g, n in out]

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row for each node, round -1 for the bounds."""
        rows = [(-1, j, 0, 0, 0, False, 0, 0, 0.0, 0.0, [float(v) for v in b]) for j, b in enumerate(self.bounds)]
        rows += [(r, k, i, t.feature[i], t.cut[i], t.missing_left[i], t.left[i], t.right[i], t.value[i], t.gain[i], []) for r, grown in enumerate(self.trees) for k, t in enumerate(grown) for i in range(len(t.feature))]
        rows += [(-2, self.kinds, 0, 0, 0, False, 0, 0, 0.0, 0.0, [])]
        spark.createDataFrame(rows, "round int, kind int, node int, feature int, cut int, missing_left boolean, `left` int, `right` int, value double, gain double, bounds array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["round"], r["kind"], r["node"]))  # a row for each node
        out = cls([np.array(r["bounds"]) for r in rows if r["round"] == -1], next(r["kind"] for r in rows if r["round"] == -2))
        grown: dict[tuple[int, int], Tree] = {}
        for r in rows:
            if r["round"] >= 0:
                tree = grown.setdefault((r["round"], r["kind"]), Tree([], [], [], [], [], [], []))
                for name in ("feature", "cut", "missing_left", "left", "right", "value", "gain"):
                    getattr(tree, name).append(r[name])
        out.trees = [[grown[r, k] for k in range(out.kinds)] for r in range(1 + max((r for r, _ in grown), default=-1))]
        return out


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_split(sums: np.ndarray, allowed: np.ndarray, cuts: np.ndarray, alpha: float, strength: float, least: float) -> tuple[float, int, int, bool]:
    """(gain, feature, cut, missing left) of one node; sums: (features, bins, 2), the last bin holds missing values; cuts: bounds of each feature."""
    whole = sums[0].sum(0)
    score = lambda s: soft(s[..., 0], alpha) ** 2 / (s[..., 1] + strength)
    before = np.cumsum(sums[:, :-1], 1)
    left = np.stack([before, before + sums[:, -1:]], 2)  # missing right, missing left
    right = whole - left
    gain = score(left) + score(right) - score(whole)
    fits = (np.arange(sums.shape[1] - 1)[None] < cuts[:, None])[..., None] & (left[..., 1] >= least) & (right[..., 1] >= least) & allowed[:, None, None]
    gain = np.where(fits, gain, -np.inf)
    feature, at, side = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[feature, at, side]), int(feature), int(at), bool(side)


def derivatives(f: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second derivatives of each row's weighted loss by its margins, and the loss."""
    logs = log_softmax(f)
    p = np.exp(logs)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1
    return w[:, None] * g, np.maximum(2 * w[:, None] * p * (1 - p), 1e-16), -w * logs[np.arange(len(y)), y]


def sampled(u: np.ndarray, turn: int, share: float) -> np.ndarray:
    """A share of the rows, others in each turn, the same on every run."""
    if share >= 1:
        return np.ones(len(u), bool)
    with np.errstate(over="ignore"):
        x = u.astype(np.uint64) + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) >> np.uint64(11) < np.uint64(int(share * (1 << 53)))


def quantile_bounds(rows: DataFrame, features: str, width: int, bins: int) -> list[np.ndarray]:
    known = [F.when(~F.isnan(c), c) for c in (F.get(features, F.lit(i)).cast("double") for i in range(width))]
    found = rows.agg(*[F.percentile_approx(c, [i / bins for i in range(1, bins)], 20 * bins).alias(f"q{i}") for i, c in enumerate(known)], *[F.min(c).alias(f"m{i}") for i, c in enumerate(known)]).first()
    return [np.array(sorted({v for v in found[f"q{i}"] or [] if v > found[f"m{i}"]}), float) for i in range(width)]


def fit(
    rows: DataFrame, features: str, label: str, kinds: int, key: str, weight: Column | None = None, held: Column | None = None, rounds: int = 50, depth: int = 4, rate: float = 0.3, bins: int = 64, gamma: float = 0.0, alpha: float = 0.0,
    strength: float = 1.0, least: float = 1.0, rows_share: float = 1.0, columns_share: float = 1.0, class_weights: Sequence[float] | None = None, patience: int = 10, measure: Callable[[DataFrame], float] | None = None, cut_every: int = 10, seed: int = 42,
) -> tuple[Boosted, list[tuple[int, float, float]]]:
    """The trees up to the best round, and (rounds, training loss, held-out loss or measure) from no round on.

    features: an array column. measure: from held-out rows (y, w, p) to a number
    that is better the smaller it is, such as an area's negative.
    """
    spark = rows.sparkSession
    w = (weight if weight is not None else F.lit(1.0)).cast("double")
    if class_weights is not None:
        w = w * F.get(F.array(*[F.lit(float(c)) for c in class_weights]), F.col(label).cast("int"))
    kept = rows.select(F.xxhash64(key).alias("u"), F.col(features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"), w.alias("w"), F.coalesce(held if held is not None else F.lit(False), F.lit(False)).alias("held"))
    kept = kept.where(f"y >= 0 and y < {kinds} and w is not null and x is not null")
    first = kept.where("not held").select("x").first()
    if first is None:
        raise ValueError("no rows to learn from")
    width = len(first["x"])
    model = Boosted(quantile_bounds(kept.where("not held"), "x", width, bins), kinds)
    cuts, size, rng = np.array([len(b) for b in model.bounds]), model.missing + 1, np.random.default_rng(seed)

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            x = np.array([[np.nan if v is None else v for v in r] for r in part["x"]], float).reshape(len(part), width)
            yield part.assign(x=list(model.binned(x)), f=list(np.zeros((len(part), kinds))))

    def advanced(grown: list[Tree]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                if len(part):
                    part["f"] = list(np.stack(part["f"]) + model.margins(np.stack(part["x"]), [grown]))
                yield part

        return run

    def sums_of(grown: list[Tree], active: list[list[int]], turn: int):
        """Losses, then derivatives by (class, active node, feature, bin)."""
        nodes = max(map(len, active))

        def run(batches: Iterator[pd.DataFrame]) -> np.ndarray | None:
            head, body = np.zeros(4), np.zeros((kinds, 2, width * nodes * size))
            for part in batches:
                if not len(part):
                    continue
                x, y, off = np.stack(part["x"]).astype(np.int64), part["y"].to_numpy(), part["held"].to_numpy(bool)
                g, h, loss = derivatives(np.stack(part["f"]), y, part["w"].to_numpy())
                head += [part["w"][~off].sum(), loss[~off].sum(), part["w"][off].sum(), loss[off].sum()]
                use = ~off & sampled(part["u"].to_numpy(), turn, rows_share)
                for k, tree in enumerate(grown):
                    place = np.full(len(tree.feature), -1)
                    place[active[k]] = np.arange(len(active[k]))
                    at = place[tree.leaves(x, size - 1)]
                    some = np.flatnonzero(use & (at >= 0))
                    cell = ((np.arange(width) * nodes + at[some, None]) * size + x[some]).ravel()
                    for i, d in enumerate((g, h)):
                        body[k, i] += np.bincount(cell, np.repeat(d[some, k], width), width * nodes * size)
            return np.concatenate([head, body.ravel()])

        return run, nodes

    current = kept.mapInPandas(start, SCHEMA).persist()
    log: list[tuple[int, float, float]] = []
    for turn in range(rounds + 1):
        grown = [Tree() for _ in range(kinds)]
        active = [[0] for _ in range(kinds)]
        run, nodes = sums_of(grown, active, turn)
        found = added(current, run)
        losses = found[1] / max(found[0], 1e-300), found[3] / found[2] if found[2] else found[1] / max(found[0], 1e-300)
        if measure is not None:
            losses = losses[0], float(measure(_with_chances(current.where("held"))))
        log.append((turn, float(losses[0]), float(losses[1])))
        best = min(log, key=lambda e: e[2])[0]
        if turn == rounds or turn - best >= patience:
            break
        allowed = np.zeros((kinds, width), bool)
        for k in range(kinds):
            allowed[k, rng.permutation(width)[: max(1, round(columns_share * width))]] = True
        for level in range(depth + 1):
            sums = found[4:].reshape(kinds, 2, width, nodes, size).transpose(0, 3, 2, 4, 1)
            following: list[list[int]] = [[] for _ in range(kinds)]
            for k, tree in enumerate(grown):
                for i, node in enumerate(active[k]):
                    g, h = sums[k, i, 0].sum(0)
                    tree.value[node] = float(-rate * soft(np.array(g), alpha) / (h + strength)) if h + strength > 0 else 0.0
                    gain, feature, at, missing_left = best_split(sums[k, i], allowed[k], cuts, alpha, strength, least)
                    if level < depth and gain > max(gamma, 1e-12):
                        tree.split(node, feature, at, missing_left, gain)
                        following[k] += [tree.left[node], tree.right[node]]
            active = following
            if not any(active):
                break
            run, nodes = sums_of(grown, active, turn)
            found = added(current, run)
        model.trees.append(grown)
        moved = current.mapInPandas(advanced(grown), SCHEMA)
        moved = cut(moved) if (turn + 1) % cut_every == 0 else moved.persist()
        moved.count()
        current.unpersist()
        current = moved
    current.unpersist()
    model.trees = model.trees[:best]
    return model, log


def _with_chances(rows: DataFrame) -> DataFrame:
    from ..functions import vectors

    return rows.select("y", "w", vectors.softmax("f").alias("p"))
