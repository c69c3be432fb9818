"""Models and iterative operators that no single expression holds.

Fits that the engine has (trees, logistic regression, principal components) are
pyspark.ml; small dense problems (assignment, linkage, kriging weights, QR) are
numpy on tables whose size is the number of classes or stations; balancing and
scoring run over the rows in Spark.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cuts import cut


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(df)


def boosted_binary(df: DataFrame, columns: Sequence[str], y: str, weight: str | None = None, validation: str | None = None, rounds: int = 20, depth: int = 4, seed: int = 42):
    """Boosted trees on weighted rows; with a validation flag rounds stop when its loss does."""
    from pyspark.ml.classification import GBTClassifier

    more = {k: v for k, v in (("weightCol", weight), ("validationIndicatorCol", validation)) if v}
    return GBTClassifier(labelCol=y, maxIter=rounds, maxDepth=depth, seed=seed, **more).fit(assemble(df, columns))


def staged(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """df with chances: the chance of label 1 by the first 1, 2, ... trees of a boosted model."""
    out = assemble(df, columns)
    for i, tree in enumerate(model.trees):
        out = tree.copy({tree.predictionCol: f"_t{i}"}).transform(out)
    margins = F.array(*[F.col(f"_t{i}") * float(w) for i, w in enumerate(model.treeWeights)])
    upto = F.transform(F.sequence(F.lit(1), F.size(margins)), lambda k: F.aggregate(F.slice(margins, F.lit(1), k), F.lit(0.0), lambda s, v: s + v))
    return out.select(*df.columns, F.transform(upto, lambda m: 1 / (1 + F.exp(-2 * m))).alias("chances"))


def boosted_stop(model, held: DataFrame, columns: Sequence[str], y: str) -> list[float]:
    """Average precision on held-out rows after each tree; the best number of trees is that of its first maximum."""
    from . import metrics

    points = staged(held, model, columns).select(y, F.posexplode("chances").alias("k", "p")).groupBy("k", "p").agg(F.sum(F.col(y).cast("double")).alias("_y"), F.count(F.lit(1)).alias("_n")).persist()
    each = lambda k: metrics.areas(metrics.summed_curve(points.where(F.col("k") == k).select(F.col("p").alias("score"), F.col("_y").alias("p"), (F.col("_n") - F.col("_y")).alias("n")))).first()["average_precision"]
    out = [float(each(k) or 0.0) for k in range(len(model.trees))]
    points.unpersist()
    return out


def boosted_multiclass(df: DataFrame, columns: Sequence[str], y: str, rounds: int = 10, depth: int = 4, weight: str | None = None, seed: int = 42):
    """Boosted trees for several classes 0 .. K - 1: one model for each against the rest."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest

    more = {"weightCol": weight} if weight else {}
    one = GBTClassifier(labelCol=y, maxIter=rounds, maxDepth=depth, seed=seed)
    return OneVsRest(classifier=one, labelCol=y, **more).fit(assemble(df, columns))


def class_chances(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """df with p: chances of all classes, the margins of the models against the rest through a softmax."""
    from pyspark.ml.functions import vector_to_array

    from ..functions import vectors

    scored = model.transform(assemble(df, columns))
    return scored.select(*df.columns, vectors.softmax(vector_to_array("rawPrediction")).alias("p"))


def forest(df: DataFrame, columns: Sequence[str], y: str, trees: int = 20, depth: int = 6, seed: int = 42):
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(labelCol=y, numTrees=trees, maxDepth=depth, seed=seed).fit(assemble(df, columns))


def logistic(df: DataFrame, columns: Sequence[str], y: str, strength: float = 0.01, l1: float = 0.0):
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(labelCol=y, regParam=strength, elasticNetParam=l1, standardization=True).fit(assemble(df, columns))


def components(df: DataFrame, columns: Sequence[str], k: int):
    from pyspark.ml.feature import PCA

    return PCA(k=k, inputCol="features", outputCol="projected").fit(assemble(df, columns))


def random_search(space: dict[str, Sequence], trials: int, seed: int = 42) -> list[dict]:
    """Seeded trials, each distinct."""
    rng, seen, out = np.random.default_rng(seed), set(), []
    most = math.prod(len(v) for v in space.values())
    while len(out) < min(trials, most):
        pick = tuple(int(rng.integers(len(v))) for v in space.values())
        if pick not in seen:
            seen.add(pick)
            out.append({k: v[i] for (k, v), i in zip(space.items(), pick, strict=True)})
    return out


def searched(spark: SparkSession, path: str, trials: Sequence[dict], score: Callable[[dict], float]) -> DataFrame:
    """(trial, score) of all trials, kept at path: those that an earlier run has scored are not run again."""
    from ..sources import readers

    done = {r["trial"] for r in spark.read.parquet(path).select("trial").collect()} if readers.landed(spark, path) else set()  # a row for each trial
    for trial in trials:
        if (name := json.dumps(trial, sort_keys=True)) not in done:
            spark.createDataFrame([(name, float(score(trial)))], "trial string, score double").write.mode("append").parquet(path)
    return spark.read.parquet(path).orderBy(F.desc("score"), "trial")


def orthogonal_prototypes(kinds: int, width: int, seed: int = 42) -> np.ndarray:
    """Unit rows, mutually orthogonal while kinds <= width."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return (q * np.sign(np.diag(r))).T[:kinds]


class Encoder:
    """Dense layers with layer normalisation and GELU, the output scaled to length 1 and compared with prototypes."""

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray]], medians: np.ndarray, mean: np.ndarray, std: np.ndarray, prototypes: np.ndarray, tau: float) -> None:
        self.layers, self.medians, self.mean, self.std, self.prototypes, self.tau = layers, medians, mean, np.where(std == 0, 1, std), prototypes, tau

    @classmethod
    def random(cls, width: int, hidden: Sequence[int], kinds: int, seed: int = 42, tau: float = 0.1) -> Encoder:
        rng, sizes = np.random.default_rng(seed), [width, *hidden]
        layers = [(rng.normal(0, 1 / math.sqrt(a), (a, b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:], strict=False)]
        return cls(layers, np.zeros(width), np.zeros(width), np.ones(width), orthogonal_prototypes(kinds, sizes[-1], seed), tau)

    def forward(self, x: np.ndarray) -> list[tuple]:
        """What each layer sees and makes: (input, normalised sums, their deviation) of hidden layers, (input, sums) of the last."""
        z, seen = (np.where(np.isnan(x), self.medians, x) - self.mean) / self.std, []
        for w, b in self.layers[:-1]:
            a = z @ w + b
            deviation = np.sqrt(a.var(1, keepdims=True) + 1e-5)
            n = (a - a.mean(1, keepdims=True)) / deviation
            seen.append((z, n, deviation))
            z = 0.5 * n * (1 + np.tanh(math.sqrt(2 / math.pi) * (n + 0.044715 * n**3)))
        w, b = self.layers[-1]
        return [*seen, (z, z @ w + b)]

    def encode(self, x: np.ndarray) -> np.ndarray:
        out = self.forward(x)[-1][1]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def chances(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.encode(x) @ self.prototypes.T / self.tau)

    def slopes(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Summed cross-entropy of soft targets and its gradient over all weights, flat."""
        seen = self.forward(x)
        z, out = seen[-1]
        size = np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
        unit = out / size
        p = _softmax(unit @ self.prototypes.T / self.tau)
        loss = float(-(weight[:, None] * target * np.log(np.maximum(p, 1e-12))).sum())
        back = ((p * target.sum(1, keepdims=True) - target) * weight[:, None]) @ self.prototypes / self.tau
        back = (back - unit * (unit * back).sum(1, keepdims=True)) / size
        grads = [(z.T @ back, back.sum(0))]
        for i in range(len(self.layers) - 2, -1, -1):
            z, n, deviation = seen[i]
            back = back @ self.layers[i + 1][0].T
            c = math.sqrt(2 / math.pi)
            t = np.tanh(c * (n + 0.044715 * n**3))
            back = back * (0.5 * (1 + t) + 0.5 * n * (1 - t**2) * c * (1 + 3 * 0.044715 * n**2))
            back = (back - back.mean(1, keepdims=True) - n * (back * n).mean(1, keepdims=True)) / deviation
            grads.append((z.T @ back, back.sum(0)))
        return loss, np.concatenate([g.ravel() for pair in reversed(grads) for g in pair])

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for pair in self.layers for w in pair])

    def with_weights(self, flat: np.ndarray) -> Encoder:
        layers, at = [], 0
        for w, b in self.layers:
            layers.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
            at += w.size + b.size
        return Encoder(layers, self.medians, self.mean, self.std, self.prototypes, self.tau)

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row for each array."""
        arrays = {"medians": self.medians, "mean": self.mean, "std": self.std, "prototypes": self.prototypes, "tau": np.array([self.tau])}
        arrays |= {f"{kind}{i}": w for i, pair in enumerate(self.layers) for kind, w in zip("wb", pair, strict=True)}
        spark.createDataFrame([(k, list(v.shape), v.astype(float).ravel().tolist()) for k, v in arrays.items()], "name string, shape array<int>, data array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoder:
        a = {r["name"]: np.array(r["data"]).reshape(r["shape"]) for r in spark.read.parquet(path).collect()}  # a row for each array of weights
        depth = sum(k.startswith("w") for k in a)
        return cls([(a[f"w{i}"], a[f"b{i}"]) for i in range(depth)], a["medians"], a["mean"], a["std"], a["prototypes"], float(a["tau"][0]))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def learning_rate(epoch: int, warm: int, total: int, peak: float) -> float:
    """Linear warm-up, then half a cosine down to nothing."""
    return peak * (epoch + 1) / warm if epoch < warm else peak * 0.5 * (1 + math.cos(math.pi * min(1.0, (epoch - warm) / max(1, total - warm))))


def train_encoder(df: DataFrame, features: str, target: str, weight: F.Column, held: F.Column, hidden: Sequence[int], epochs: int = 30, warm: int = 3, peak: float = 0.02, clip: float = 1.0, patience: int = 5, seed: int = 42) -> tuple[Encoder, list[tuple[int, float, float, float]]]:
    """The encoder of least loss on held-out rows, and (epoch, rate, loss, held-out loss) of each epoch.

    target is an array of class masses. Rows stay where they are: in each epoch
    every task sums the gradient of its rows, the sums are added up in a second
    step, and the driver moves the weights (Adam, the gradient's length cut to
    `clip`). It stops `patience` epochs after the best one.
    """
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(target).cast("array<double>").alias("q"), weight.cast("double").alias("w"), held.alias("h")).persist()
    width, kinds = rows.select(F.size("x"), F.size("q")).first()
    numbers = [F.get("x", F.lit(i)) for i in range(width)]
    known = [F.when(~F.isnan(c), c) for c in numbers]
    facts = rows.where("not h").agg(F.array(*[F.avg(c) for c in known]), F.array(*[F.stddev_pop(c) for c in known]), F.array(*[F.percentile_approx(c, 0.5) for c in known])).first()
    mean, std, medians = (np.array([v or 0.0 for v in part], float) for part in facts)
    start = Encoder.random(width, hidden, kinds, seed)
    model = Encoder(start.layers, medians, mean, std, start.prototypes, start.tau)
    parts = rows.rdd.getNumPartitions()

    def epoch_sums(current: Encoder) -> np.ndarray:
        shared = df.sparkSession.sparkContext.broadcast(current)

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(4 + len(shared.value.flat()))
            for part in batches:
                for a in range(0, len(part), 4096):
                    some = part.iloc[a : a + 4096]
                    x, q, w, h = np.stack(some["x"]).astype(float), np.stack(some["q"]).astype(float), some["w"].to_numpy(), some["h"].to_numpy(bool)
                    if (~h).any():
                        loss, slope = shared.value.slopes(x[~h], q[~h], w[~h])
                        total[:2] += loss, w[~h].sum()
                        total[4:] += slope
                    if h.any():
                        total[2:4] += shared.value.slopes(x[h], q[h], w[h])[0], w[h].sum()
            yield pd.DataFrame({"s": [total]})

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = [s for part in batches for s in part["s"]]
            yield pd.DataFrame({"s": [np.sum(found, 0)] if found else []})

        sums = rows.mapInPandas(local, "s array<double>").repartition(max(1, math.isqrt(parts))).mapInPandas(added, "s array<double>")
        out = np.sum([np.array(r["s"]) for r in sums.collect()], 0)  # about the square root of the tasks, each the size of the weights
        shared.unpersist()
        return out

    flat, first, second, best, log = model.flat(), 0.0, 0.0, (math.inf, model), []
    for epoch in range(epochs):
        sums, rate = epoch_sums(model), learning_rate(epoch, warm, epochs, peak)
        loss, held_loss = sums[0] / max(sums[1], 1e-12), sums[2] / sums[3] if sums[3] else sums[0] / max(sums[1], 1e-12)
        log.append((epoch, rate, float(loss), float(held_loss)))
        best = min(best, (float(held_loss), model), key=lambda x: x[0])
        if epoch - min(log, key=lambda x: x[3])[0] >= patience:
            break
        slope = sums[4:] / max(sums[1], 1e-12)
        slope = slope * min(1.0, clip / max(float(np.linalg.norm(slope)), 1e-12))
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        flat = flat - rate * (first / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(second / (1 - 0.999 ** (epoch + 1))) + 1e-8)
        model = model.with_weights(flat)
    rows.unpersist()
    return best[1], log


def infer(df: DataFrame, key: str, features: str, model: Encoder, *kept: str) -> DataFrame:
    """(key, p, kept columns): class chances of each row's feature array; imputes, scales, encodes, compares with prototypes."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            p = shared.value.chances(np.stack(part["x"].to_numpy()).astype(float)) if len(part) else np.zeros((0, 1))
            yield part[["_key"]].assign(p=list(p), **{k: part[k] for k in kept})

    chosen = df.select(F.col(key).alias("_key"), F.col(features).cast("array<double>").alias("x"), *kept)
    types = dict(chosen.dtypes)
    return chosen.mapInPandas(run, ", ".join([f"_key {types['_key']}", "p array<double>", *[f"`{k}` {types[k]}" for k in kept]])).withColumnRenamed("_key", key)


def augmented(values: F.Column, key: F.Column, noise: float = 0.05, drop: float = 0.1) -> F.Column:
    """An array with hash-seeded noise and dropped entries: the same for a key on every run."""
    unit = lambda i, salt: F.pmod(F.xxhash64(key, i, F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)
    return F.transform(values, lambda x, i: F.when(unit(i, 1) < drop, 0.0).otherwise(x * (1 + noise * (2 * unit(i, 2) - 1))))


#: Chance of a dropped entry and spread of the noise for each family of features.
FAMILIES = {"topo": (0.0, 0.01), "suelo": (0.0, 0.01), "clima": (0.10, 0.05), "s2": (0.20, 0.05), "otro": (0.10, 0.025)}


def augmented_by_family(values: F.Column, families: F.Column, key: F.Column) -> F.Column:
    """An array with entries dropped and normal noise added as each entry's family (an array of names) asks for, the same for a key on every run."""
    unit = lambda i, salt: (F.pmod(F.xxhash64(key, i, F.lit(salt)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    normal = lambda i: F.sqrt(-2 * F.ln(unit(i, 2))) * F.cos(2 * math.pi * unit(i, 3))
    table = F.create_map(*[x for name, (drop, noise) in FAMILIES.items() for x in (F.lit(name), F.array(F.lit(drop), F.lit(noise)))])
    rules = lambda i: F.coalesce(F.try_element_at(table, F.get(families, i)), F.array(*map(F.lit, FAMILIES["otro"])))
    return F.transform(values, lambda x, i: F.when(unit(i, 1) < rules(i)[0], 0.0).otherwise(x) + rules(i)[1] * normal(i))


def sinkhorn(scores: DataFrame, bag: str, row: str, kind: str, score: str, target: DataFrame, rounds: int = 5) -> DataFrame:
    """(bag, row, kind, q): exp(scores) scaled in turn to the bag's class masses and to 1 for each row.

    target: (bag, kind, w), proportions; a class's mass is w times the bag's
    rows. Rows are dealt by bag once, which serves every window of every round;
    a bag's rows must fit a task, as its size is bounded where bags are sampled.
    """
    from pyspark.sql import Window as W

    top = F.max(score).over(W.partitionBy(bag, row))
    counts = scores.groupBy(bag).agg(F.count_distinct(row).alias("_rows"))
    q = scores.join(target.join(counts, bag), [bag, kind]).repartition(bag).withColumn("q", F.exp(F.col(score) - top))
    for _ in range(rounds):
        q = q.withColumn("q", F.col("q") * F.try_divide(F.col("w") * F.col("_rows"), F.sum("q").over(W.partitionBy(bag, kind))))
        q = q.withColumn("q", F.try_divide(F.col("q"), F.sum("q").over(W.partitionBy(bag, row))))
    return q.select(bag, row, kind, "q")


def assignment(cost: np.ndarray) -> list[int]:
    """Columns of least total cost, one for each row (rows <= columns): shortest augmenting paths."""
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            free = np.flatnonzero(~used[1:]) + 1
            gap = cost[match[j0] - 1, free - 1] - u[match[j0]] - v[free]
            better = gap < least[free]
            least[free[better]], way[free[better]] = gap[better], j0
            j1 = free[np.argmin(least[free])]
            step = least[j1]
            u[match[used]] += step
            v[used] -= step
            least[~used] -= step
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [0] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def matched_accuracy(counts: DataFrame) -> tuple[float, dict]:
    """Best accuracy over all one-to-one readings of predicted clusters as classes; counts: (truth, predicted, n), classes squared rows."""
    rows = counts.collect()
    truths, predicted = sorted({r["truth"] for r in rows}), sorted({r["predicted"] for r in rows})
    size = max(len(truths), len(predicted))
    table = np.zeros((size, size))
    for r in rows:
        table[predicted.index(r["predicted"]), truths.index(r["truth"])] += r["n"]
    to = assignment(-table)
    hit = sum(table[i, j] for i, j in enumerate(to))
    return float(hit / table.sum()) if table.sum() else 0.0, {p: truths[to[i]] for i, p in enumerate(predicted) if to[i] < len(truths)}


def ward_order(points: np.ndarray) -> list[int]:
    """Leaf order of Ward's hierarchical clustering of a few points."""
    groups = {i: ([i], points[i].astype(float)) for i in range(len(points))}
    while len(groups) > 1:
        ids = sorted(groups)
        best = min(((len(groups[a][0]) * len(groups[b][0]) / (len(groups[a][0]) + len(groups[b][0])) * float(((groups[a][1] - groups[b][1]) ** 2).sum()), a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]), key=lambda x: x)
        (ma, ca), (mb, cb) = groups.pop(best[1]), groups.pop(best[2])
        groups[best[1]] = (ma + mb, (ca * len(ma) + cb * len(mb)) / (len(ma) + len(mb)))
    return next(iter(groups.values()))[0] if groups else []


def spherical(h: np.ndarray, nugget: float, sill: float, reach: float) -> np.ndarray:
    t = np.minimum(h / reach, 1)
    return np.where(h > 0, nugget + sill * (1.5 * t - 0.5 * t**3), 0.0)


def fit_variogram(xy: np.ndarray, z: np.ndarray, lags: int = 12) -> tuple[float, float, float]:
    """Nugget, partial sill and range of least squares over a fixed grid of ranges: deterministic, two linear parameters solved for each."""
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1))
    i, j = np.triu_indices(len(z), 1)
    h, g = d[i, j], 0.5 * (z[i] - z[j]) ** 2
    edges = np.linspace(0, h.max() + 1e-9, lags + 1)
    at = np.digitize(h, edges)
    lag = np.array([[h[at == k].mean(), g[at == k].mean(), (at == k).sum()] for k in range(1, lags + 1) if (at == k).any()])
    best = (np.inf, 0.0, float(z.var()), float(h.max()))
    for reach in h.max() * np.linspace(0.1, 1.5, 29):
        t = np.minimum(lag[:, 0] / reach, 1)
        base = np.stack([np.ones(len(lag)), 1.5 * t - 0.5 * t**3], 1)
        w = np.sqrt(lag[:, 2])
        c, *_ = np.linalg.lstsq(base * w[:, None], lag[:, 1] * w, rcond=None)
        c = np.maximum(c, 0)
        miss = float((((base @ c) - lag[:, 1]) ** 2 * lag[:, 2]).sum())
        if miss < best[0] and c[1] > 0:
            best = (miss, float(c[0]), float(c[1]), float(reach))
    return best[1:]


def kriged(stations: DataFrame, grid: DataFrame, period: str = "period", least: int = 4, block: int = 512) -> DataFrame:
    """(period, row, col, value): ordinary kriging of each period's stations (x, y, value) at the grid's cells (row, col, x, y).

    Stations of a period are tens of rows and are solved in one pandas group;
    the dual weights are then sent to the cells, which are dealt in blocks to as
    many tasks as a shuffle has, however few files they come from. Fewer than
    `least` stations leave the period out; a constant field is its mean; a cell
    without x or y takes the period's base.
    """
    schema = f"{period} string, sx array<double>, sy array<double>, w array<double>, base double, nugget double, sill double, reach double"

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.dropna(subset=["x", "y", "value"]).groupby(["x", "y"], as_index=False)["value"].mean()
        xy, z = part[["x", "y"]].to_numpy(float), part["value"].to_numpy(float)
        columns = [period, "sx", "sy", "w", "base", "nugget", "sill", "reach"]
        if len(z) < least:
            return pd.DataFrame(columns=columns)
        if z.std() < 1e-6 or z.std() / (abs(z.mean()) + 1e-9) < 0.01:
            return pd.DataFrame([["", xy[:, 0], xy[:, 1], np.zeros(len(z)), float(z.mean()), 0.0, 1.0, 1.0]], columns=columns)
        nugget, sill, reach = fit_variogram(xy, z)
        gamma = spherical(np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1)), nugget, sill, reach)
        system = np.block([[gamma, np.ones((len(z), 1))], [np.ones((1, len(z))), np.zeros((1, 1))]])
        dual = np.linalg.lstsq(system, np.append(z, 0.0), rcond=None)[0]
        return pd.DataFrame([["", xy[:, 0], xy[:, 1], dual[:-1], float(dual[-1]), nugget, sill, reach]], columns=columns)

    def keyed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = solve(part)
        out[period] = str(key[0])
        return out

    solved = cut(stations.select(F.col(period).cast("string").alias(period), "x", "y", "value").groupBy(period).applyInPandas(keyed, schema))
    held = solved.agg(F.coalesce(F.sum(F.size("w")), F.lit(0))).first()[0]
    types, spark = dict(grid.dtypes), grid.sparkSession

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, block):
                some = part.slice(at, block)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), c) for c in some.columns], names=["rows", "cols", "x", "y"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            numbers = lambda c, i, part=part: part.column(c)[i].values.to_numpy(zero_copy_only=False)
            facts = part.select([period, "base", "nugget", "sill", "reach"]).to_pylist()
            for i, f in enumerate(facts):
                x, y, value = numbers("x", i), numbers("y", i), np.zeros(len(part.column("x")[i]))
                sx, sy, w = (numbers(c, i)[:, None] for c in ("sx", "sy", "w"))
                for at in range(0, len(w), 64):  # so many stations at once
                    dx, dy = x - sx[at : at + 64], y - sy[at : at + 64]
                    h = np.sqrt(dx * dx + dy * dy)
                    t = np.minimum(h / f["reach"], 1.0)
                    for term in w[at : at + 64] * np.where(h > 0, f["nugget"] + f["sill"] * (1.5 * t - 0.5 * t * t * t), 0.0):
                        value += term
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(f[period], pa.string()), len(value)), part.column("rows")[i].values, part.column("cols")[i].values, pa.array(f["base"] + value)], names=[period, "row", "col", "value"])

    cells = grid.select("row", "col", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    blocks = cells.mapInArrow(packed, f"rows array<{types['row']}>, cols array<{types['col']}>, x array<double>, y array<double>").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    # every cell has a value for every period; weights of up to a million stations are some 24 MB
    return blocks.crossJoin(F.broadcast(solved) if held <= 1_000_000 else solved).mapInArrow(filled, f"{period} string, row {types['row']}, col {types['col']}, value double")


def wetness(part: pd.DataFrame, size: float) -> pd.DataFrame:
    """(row, col, twi) of one basin (row, col, value): pits filled, D8 flow, accumulation, ln(a / tan b). For a catchment that one task holds."""
    r0, c0 = part["row"].min(), part["col"].min()
    h = np.full((part["row"].max() - r0 + 1, part["col"].max() - c0 + 1), np.nan)
    h[part["row"] - r0, part["col"] - c0] = part["value"]
    rows, cols = h.shape
    import heapq

    steps = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]
    filled, done, queue = h.copy(), np.zeros(h.shape, bool), []
    for r in range(rows):
        for c in range(cols):
            if not np.isnan(h[r, c]) and (r in (0, rows - 1) or c in (0, cols - 1) or any(np.isnan(h[r + a, c + b]) for a, b in steps)):
                heapq.heappush(queue, (h[r, c], r, c))
                done[r, c] = True
    order, to = [], {}
    while queue:  # cells leave the queue from the outlets upwards, each draining to the one that reached it
        level, r, c = heapq.heappop(queue)
        order.append((r, c))
        for a, b in steps:
            y, x = r + a, c + b
            if 0 <= y < rows and 0 <= x < cols and not done[y, x] and not np.isnan(h[y, x]):
                filled[y, x] = max(h[y, x], level + 1e-6)
                done[y, x] = True
                to[(y, x)] = (r, c)
                heapq.heappush(queue, (filled[y, x], y, x))
    area = np.where(np.isnan(h), 0.0, 1.0)
    slope = np.full(h.shape, 1e-3)
    for y, x in reversed(order):
        best = to.get((y, x))
        steepest = 0.0
        for a, b in steps:
            r, c = y + a, x + b
            if 0 <= r < rows and 0 <= c < cols and not np.isnan(h[r, c]):
                fall = (filled[y, x] - filled[r, c]) / (size * math.hypot(a, b))
                if fall > steepest:
                    steepest, best = fall, (r, c)
        slope[y, x] = max(steepest, 1e-3)
        if best:
            area[best] += area[y, x]
    twi = np.log(area * size / slope)
    keep = ~np.isnan(h)
    r, c = np.nonzero(keep)
    return pd.DataFrame({"row": r + r0, "col": c + c0, "twi": twi[keep]})


def _nearest(own: np.ndarray, names: np.ndarray, held: np.ndarray, held_names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, squared distances) of the k nearest held rows of each own row, nearest first, ties to the first held; infinite where a key meets itself.

    Products pick a few rows more than k, whose distances are then taken in full;
    rows for which rounding could leave one out are compared with all.
    """
    most = min(k + 8, len(held))
    sizes, held_sizes = (own**2).sum(1), (held**2).sum(1)
    rough = sizes[:, None] + held_sizes - 2 * own @ held.T
    rough[names[:, None] == held_names] = np.inf
    near = np.sort(np.argpartition(rough, most - 1, axis=1)[:, :most], axis=1)
    d = ((held[near] - own[:, None]) ** 2).sum(2)
    d[names[:, None] == held_names[near]] = np.inf
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    place, best = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
    if most < len(held):
        edge = np.take_along_axis(rough, near, 1).max(1)
        for i in np.flatnonzero(~(best[:, -1] + 1e-12 * (sizes + held_sizes.max()) < edge)):
            d = ((held - own[i]) ** 2).sum(1)
            d[held_names == names[i]] = np.inf
            place[i] = np.argsort(d, kind="stable")[:k]
            best[i] = d[place[i]]
    return place, best


def nearest_of_kind(df: DataFrame, kind: str, key: str, x: str, k: int = 5, block: int = 8192) -> DataFrame:
    """(kind, key, x, near): the k nearest other rows of the same class, as arrays, nearest first, ties to the smaller key; a class's keys are unique.

    A class is cut into blocks by hash; each pair of its blocks meets in a task
    of its own and returns k keys and distances for each of one block's rows.
    The vectors of the nearest of all blocks are joined to them at the end.
    """
    rows = df.select(F.col(kind).alias("kind"), F.col(key).alias("key"), F.col(x).cast("array<double>").alias("x"))
    counts = rows.groupBy("kind").agg((F.floor(F.count(F.lit(1)) / block) + 1).cast("int").alias("blocks"))
    home = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    each = rows.join(counts, "kind").withColumn("_h", home).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = each.select("kind", F.col("_h").alias("i"), F.col("_o").alias("j"), F.lit(0).alias("side"), "key", "x").unionByName(each.select("kind", F.col("_o").alias("i"), F.col("_h").alias("j"), F.lit(1).alias("side"), "key", "x"))
    types = dict(rows.dtypes)

    def meet(part: pa.Table) -> pa.Table:
        side, names = part.column("side").to_numpy(), np.array(part.column("key").to_pylist())
        matrix = part.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(side), -1)
        held, own = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        held = held[np.argsort(names[held], kind="stable")]
        others, other_names, keys = matrix[held], names[held], part.column("key").combine_chunks()
        offsets, d, near = [np.zeros(1, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for at in range(0, len(own) if len(held) else 0, 256):
            some = own[at : at + 256]
            place, best = _nearest(matrix[some], names[some], others, other_names, k)
            there = np.isfinite(best)
            offsets.append(there.sum(1))
            d.append(best[there])
            near.append(held[place[there]])
        own = own if len(held) else own[:0]
        found = pa.StructArray.from_arrays([pa.array(np.concatenate(d)), keys.take(pa.array(np.concatenate(near)))], ["d", "near_key"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).cumsum(), pa.int32()), found)
        return pa.table({"kind": part.column("kind").take(pa.array(own)), "key": keys.take(pa.array(own)), "near": lists})

    found = sides.groupBy("kind", "i", "j").applyInArrow(meet, f"kind {types['kind']}, key {types['key']}, near array<struct<d: double, near_key: {types['key']}>>")
    best = found.groupBy("kind", "key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("_l"))
    each = best.select("kind", "key", F.posexplode("_l").alias("_n", "_s")).select("kind", F.col("key").alias("_key"), "_n", F.col("_s.near_key").alias("key")).join(rows, ["kind", "key"])
    lists = each.groupBy("kind", F.col("_key").alias("key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "x"))), lambda s: s["x"]).alias("near"))
    return rows.join(lists, ["kind", "key"], "left")


def oversampled(df: DataFrame, kind: str, key: str, x: str, k: int = 5) -> DataFrame:
    """(kind, x): new rows that bring every class to the size of the largest, each on the way from a row to one of its k nearest of the class.

    Which neighbour and how far follow from hashes of the key: reruns agree. A
    class of one row has no neighbours and gets copies of it.
    """
    from pyspark.sql import Window as W

    counts = df.groupBy(F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("most"))
    need = counts.crossJoin(F.broadcast(most)).where("most > n").select("kind", "n", (F.col("most") - F.col("n")).alias("need"))  # one row beside a row for each class
    few = df.join(need.select(F.col("kind").alias(kind)), kind, "left_semi")
    nth = F.row_number().over(W.partitionBy("kind", "_block").orderBy("key"))
    ranked = nearest_of_kind(few, kind, key, x, k).join(need, "kind").withColumn("_block", F.pmod(F.xxhash64("key"), F.floor(F.col("n") / 4096) + 1))
    sizes = ranked.groupBy("kind", "_block").agg(F.count(F.lit(1)).alias("_m"))
    before = sizes.select("kind", "_block", (F.sum("_m").over(W.partitionBy("kind").orderBy("_block")) - F.col("_m")).alias("_before"))
    each = ranked.join(before, ["kind", "_block"]).withColumn("_r", F.col("_before") + nth)
    copies = F.floor(F.col("need") / F.col("n")) + (F.col("_r") <= F.col("need") % F.col("n")).cast("long")
    made = each.withColumn("_c", copies).where("_c > 0").select("kind", "key", "x", "near", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"))).alias("_i"))
    part = lambda salt: F.pmod(F.xxhash64("key", "_i", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    other = F.coalesce(F.get("near", F.floor(part(1) * F.size("near")).cast("int")), F.col("x"))
    return made.select("kind", F.zip_with("x", other, lambda a, b: a + part(2) * (b - a)).alias("x"))


def warmup_cosine(step: F.Column, warm: int, total: int, peak: float, least: float = 0.0) -> F.Column:
    part = (step - warm) / F.lit(float(max(1, total - warm)))
    return F.when(step < warm, F.lit(peak) * (step + 1) / warm).otherwise(F.lit(least) + 0.5 * (peak - least) * (1 + F.cos(F.lit(math.pi) * F.least(part, F.lit(1.0)))))


def nearest_spread(df: DataFrame, vectors: str, key: str) -> DataFrame:
    """(loss): KoLeo penalty of a bag of bounded size, -mean ln of the distance to the nearest other vector."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["x"].to_numpy()).astype(float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        s = x @ x.T
        np.fill_diagonal(s, -2)
        d = np.sqrt(np.maximum(2 - 2 * s.max(1), 1e-16))
        return pd.DataFrame({"bag": [int(part["bag"].iloc[0])], "loss": [float(-np.log(d + 1e-8).mean())]})

    return df.select(F.col(key).cast("long").alias("bag"), F.col(vectors).cast("array<double>").alias("x")).groupBy("bag").applyInPandas(run, "bag long, loss double")
