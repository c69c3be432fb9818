"""Learning classes of rows from nothing but the class proportions of their bags.

A network maps features to the unit sphere, where one trainable prototype stands
for each class. In a step, each bag shows a chunk of its rows in two augmented
views. Both views are scored against the prototypes, the scores are balanced by
Sinkhorn steps so that the chunk's assignments have the bag's proportions, and
each view learns the other's assignments; rows of rare classes weigh more. A
penalty keeps prototypes apart, and they stand still in the first epochs.
Gradients reach every layer and the prototypes; AdamW moves them, with its
length cut, a warm-up and half a cosine.

On Spark: rows are dealt once into chunks of about `bag_size` rows by hash of
their key, so that a bag of any size is many rows of the chunk table; each epoch
takes one chunk of every bag, another one each time. A task works its chunks off
in numpy and yields one sum; sums are added in a second step, and the driver gets
about the square root of the tasks of them. What a task holds is one chunk.

Defined cases: missing or null features take the training rows' median; a bag
without proportions, or with masses that add to nothing, takes no part; masses
are divided by their sum; rows with null bag or features take no part; repeated
rows count each time; an empty table can't be fitted and raises; a class that no
bag names keeps its prototype, moved by the penalty only.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .learning import FAMILIES, orthogonal_prototypes

CURVE = math.sqrt(2 / math.pi)


def sinkhorn(scores: np.ndarray, w: np.ndarray, eps: float, rounds: int = 5) -> np.ndarray:
    """Assignments of rows to classes: every row sums to 1, class k has about w[k] of the rows."""
    q = np.maximum(np.exp((scores - scores.max(1, keepdims=True)) / eps), 1e-8)
    mass = np.maximum(w * len(scores), 1e-8)
    for _ in range(rounds):
        q = q * (mass / np.maximum(q.sum(0), 1e-8))
        q = q / np.maximum(q.sum(1, keepdims=True), 1e-8)
    return q


def row_weights(q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows assigned to classes that are rare in their bag weigh more; 1 on average."""
    rare = 1 / (w + 1e-3)
    weight = q @ (rare / rare.sum() * len(w))
    return weight / max(float(weight.mean()), 1e-8)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return x / size, size


def unit_slope(back: np.ndarray, u: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (back - u * (u * back).sum(1, keepdims=True)) / size


def log_softmax(s: np.ndarray) -> np.ndarray:
    s = s - s.max(1, keepdims=True)
    return s - np.log(np.exp(s).sum(1, keepdims=True))


@dataclass
class Network:
    """Layers with layer normalisation, GELU and dropout, a linear last one, and a prototype for each class, in one flat vector."""

    sizes: tuple[int, ...]
    kinds: int
    flat: np.ndarray
    medians: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    tau: float
    eps: float

    @classmethod
    def random(cls, width: int, hidden: Sequence[int], kinds: int, tau: float = 0.1, eps: float = 0.05, seed: int = 42) -> Network:
        sizes, rng = (width, *hidden), np.random.default_rng(seed)
        out = cls(sizes, kinds, np.zeros(0), np.zeros(width), np.zeros(width), np.ones(width), tau, eps)
        parts = []
        for name, shape in out.shapes():
            if name[0] == "w":
                parts.append(rng.normal(0, 1 / math.sqrt(shape[0]), shape))
            else:
                parts.append(orthogonal_prototypes(kinds, sizes[-1], seed) if name == "prototypes" else np.ones(shape) if name[0] == "g" else np.zeros(shape))
        return replace(out, flat=np.concatenate([p.ravel() for p in parts]))

    def shapes(self) -> list[tuple[str, tuple[int, ...]]]:
        out = []
        for i, (a, b) in enumerate(zip(self.sizes, self.sizes[1:], strict=False)):
            out += [(f"w{i}", (a, b)), (f"b{i}", (b,))]
            if i < len(self.sizes) - 2:
                out += [(f"g{i}", (b,)), (f"h{i}", (b,))]
        return [*out, ("prototypes", (self.kinds, self.sizes[-1]))]

    def arrays(self, flat: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Views of the flat vector by name."""
        flat, out, at = self.flat if flat is None else flat, {}, 0
        for name, shape in self.shapes():
            out[name] = flat[at : at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
        return out

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (np.where(np.isnan(x), self.medians, x) - self.mean) / np.where(self.std == 0, 1, self.std)

    def forward(self, z: np.ndarray, rng: np.random.Generator | None = None, dropout: float = 0.0) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        """Unit vectors of scaled features, their lengths before, and what each hidden layer saw and made."""
        a, seen = self.arrays(), []
        last = len(self.sizes) - 2
        for i in range(last):
            s = z @ a[f"w{i}"] + a[f"b{i}"]
            deviation = np.sqrt(s.var(1, keepdims=True) + 1e-5)
            n = (s - s.mean(1, keepdims=True)) / deviation
            v = n * a[f"g{i}"] + a[f"h{i}"]
            mask = (rng.random(v.shape) >= dropout) / (1 - dropout) if rng is not None and dropout else np.ones(1)
            seen.append((z, n, deviation, v, mask))
            z = 0.5 * v * (1 + np.tanh(CURVE * (v + 0.044715 * v**3))) * mask
        u, size = unit(z @ a[f"w{last}"] + a[f"b{last}"])
        return u, size, [*seen, (z,)]

    def backward(self, back: np.ndarray, u: np.ndarray, size: np.ndarray, seen: list[tuple], out: dict[str, np.ndarray]) -> None:
        """Adds to `out` the gradient of all layers, given that of the unit vectors."""
        a, last = self.arrays(), len(self.sizes) - 2
        back = unit_slope(back, u, size)
        out[f"w{last}"] += seen[last][0].T @ back
        out[f"b{last}"] += back.sum(0)
        for i in range(last - 1, -1, -1):
            z, n, deviation, v, mask = seen[i]
            t = np.tanh(CURVE * (v + 0.044715 * v**3))
            back = (back @ a[f"w{i + 1}"].T) * mask * (0.5 * (1 + t) + 0.5 * v * (1 - t**2) * CURVE * (1 + 3 * 0.044715 * v**2))
            out[f"g{i}"] += (back * n).sum(0)
            out[f"h{i}"] += back.sum(0)
            back = back * a[f"g{i}"]
            back = (back - back.mean(1, keepdims=True) - n * (back * n).mean(1, keepdims=True)) / deviation
            out[f"w{i}"] += z.T @ back
            out[f"b{i}"] += back.sum(0)

    def scores(self, u: np.ndarray) -> np.ndarray:
        return u @ unit(self.arrays()["prototypes"])[0].T

    def chances(self, x: np.ndarray) -> np.ndarray:
        return np.exp(log_softmax(self.scores(self.forward(self.scaled(x))[0]) / self.tau))

    def swapped(self, views: Sequence[np.ndarray], assigned: Sequence[np.ndarray], weight: np.ndarray, rngs: Sequence[np.random.Generator | None] = (None, None), dropout: float = 0.0) -> tuple[float, np.ndarray]:
        """Mean weighted cross-entropy of each view's chances under the other's assignments, and its gradient, flat."""
        slope = np.zeros_like(self.flat)
        out, loss = self.arrays(slope), 0.0
        proto, proto_size = unit(self.arrays()["prototypes"])
        for z, q, rng in zip(views, assigned[::-1], rngs, strict=True):
            u, size, seen = self.forward(z, rng, dropout)
            logs = log_softmax(u @ proto.T / self.tau)
            share = weight[:, None] / len(z)
            loss -= float((share * q * logs).sum())
            back = share * (np.exp(logs) * q.sum(1, keepdims=True) - q) / self.tau
            self.backward(back @ proto, u, size, seen, out)
            out["prototypes"] += unit_slope(back.T @ u, proto, proto_size)
        return loss, slope

    def apart(self) -> tuple[float, np.ndarray]:
        """Mean squared cosine of different prototypes, and its gradient."""
        proto, size = unit(self.arrays()["prototypes"])
        same = proto @ proto.T
        np.fill_diagonal(same, 0)
        pairs = max(1, self.kinds * (self.kinds - 1))
        slope = np.zeros_like(self.flat)
        self.arrays(slope)["prototypes"] += unit_slope(4 * same @ proto / pairs, proto, size)
        return float((same**2).sum() / pairs), slope

    def bag_slope(self, x: np.ndarray, w: np.ndarray, families: Sequence[str], seed: Sequence[int], dropout: float = 0.0, noise: float = 1.0) -> tuple[float, np.ndarray]:
        """One chunk's loss and gradient: two views, their assignments by the bag's proportions, swapped."""
        rngs = [np.random.default_rng([*seed, side]) for side in (0, 1)]
        rules = np.array([FAMILIES.get(f, FAMILIES["otro"]) for f in families])
        z = self.scaled(x)
        views = [np.where(rng.random(z.shape) < rules[:, 0] * noise, 0.0, z) + rng.normal(size=z.shape) * rules[:, 1] * noise for rng in rngs]
        again = [np.random.default_rng([*seed, side, 1]) for side in (0, 1)]
        assigned = [sinkhorn(self.scores(self.forward(v, np.random.default_rng([*seed, side, 1]), dropout)[0]), w, self.eps) for side, v in enumerate(views)]
        return self.swapped(views, assigned, row_weights(assigned[0], w), again, dropout)

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row for each array."""
        held = {"sizes": np.array(self.sizes), "kinds": np.array([self.kinds]), "medians": self.medians, "mean": self.mean, "std": self.std, "tau": np.array([self.tau]), "eps": np.array([self.eps]), "flat": self.flat}
        spark.createDataFrame([(k, v.astype(float).tolist()) for k, v in held.items()], "name string, data array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        a = {r["name"]: np.array(r["data"]) for r in spark.read.parquet(path).collect()}  # a row for each array of weights
        return cls(tuple(int(v) for v in a["sizes"]), int(a["kinds"][0]), a["flat"], a["medians"], a["mean"], a["std"], float(a["tau"][0]), float(a["eps"][0]))


def learning_rate(epoch: int, warm: int, total: int, peak: float, least: float) -> float:
    """Linear warm-up, then half a cosine down to `least`."""
    return peak * (epoch + 1) / warm if epoch < warm else least + 0.5 * (peak - least) * (1 + math.cos(math.pi * (epoch - warm) / max(1, total - warm)))


def chunks(rows: DataFrame, proportions: DataFrame, bag: str, key: str, features: str, held: Column, bag_size: int) -> DataFrame:
    """(bag, chunk, chunks, held, w, x): the rows' features, in the order of their keys, about bag_size of them a chunk; proportions: (bag, w)."""
    total = F.aggregate("w", F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))
    known = proportions.select(F.col(bag).alias("bag"), F.col("w").cast("array<double>").alias("w")).where(total > 0).select("bag", F.transform("w", lambda v: F.coalesce(v, F.lit(0.0)) / total).alias("w"))
    kept = rows.select(F.col(bag).alias("bag"), F.xxhash64(key).alias("_k"), F.col(features).cast("array<double>").alias("x"), held.alias("held")).where("bag is not null and x is not null")
    sizes = kept.groupBy("bag").agg(F.count(F.lit(1)).alias("n")).join(known, "bag").select("bag", "w", F.ceil(F.col("n") / bag_size).cast("int").alias("chunks"))
    dealt = kept.join(sizes, "bag").withColumn("chunk", F.pmod(F.xxhash64("_k"), F.col("chunks")).cast("int"))
    return dealt.groupBy("bag", "chunk").agg(F.first("chunks").alias("chunks"), F.max("held").alias("held"), F.first("w").alias("w"), F.transform(F.sort_array(F.collect_list(F.struct("_k", "x"))), lambda s: s["x"]).alias("x"))


def _matrix(rows: list) -> np.ndarray:
    return np.array([np.asarray(r, float) for r in rows])  # None becomes NaN


def added(df: DataFrame, run) -> np.ndarray:
    """The sum of the vectors that `run`, applied to the pandas batches of each task, yields; about the square root of the tasks reach the driver."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = run(batches)
        yield pd.DataFrame({"s": pd.Series([total] if total is not None else [], dtype=object)})

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [s for part in batches for s in part["s"]]
        yield pd.DataFrame({"s": pd.Series([np.sum(found, 0)] if found else [], dtype=object)})

    parts = df.rdd.getNumPartitions()
    out = df.mapInPandas(one, "s array<double>").repartition(max(1, math.isqrt(parts))).mapInPandas(sums, "s array<double>").collect()
    return np.sum([np.array(r["s"]) for r in out], 0)


def bag_divergence(dealt: DataFrame, model: Network) -> DataFrame:
    """(bag, w, p, kl): the mean chances of all of a bag's rows, and how far its proportions are from them."""
    shared = dealt.sparkSession.sparkContext.broadcast(model)
    kind = dealt.schema["bag"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            p = [shared.value.chances(_matrix(x)) for x in part["x"]]
            yield pd.DataFrame({"bag": part["bag"], "w": part["w"], "n": [len(v) for v in p], "p": [v.sum(0) for v in p]})

    sums = dealt.select("bag", "w", "x").mapInPandas(run, f"bag {kind}, w array<double>, n long, p array<double>")
    each = sums.select("bag", "w", "n", F.posexplode("p").alias("k", "p")).groupBy("bag", "k").agg(F.first(F.get("w", F.col("k"))).alias("w"), (F.sum("p") / F.sum("n")).alias("p"))
    least = F.lit(1e-8)
    term = F.col("w") * (F.ln(F.greatest("w", least)) - F.ln(F.greatest("p", least)))
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("k", c))), lambda s: s[c]).alias(c)
    return each.groupBy("bag").agg(in_order("w"), in_order("p"), F.sum(term).alias("kl"))


def prior_divergence(dealt: DataFrame) -> float:
    """Mean over held bags of the divergence from the mean proportions of the others: what knowing no features costs."""
    bags = dealt.groupBy("bag").agg(F.first("w").alias("w"), F.max("held").alias("held"))
    long = bags.select("bag", "held", F.posexplode("w").alias("k", "w"))
    prior = long.where("not held").groupBy("k").agg(F.avg("w").alias("p"))
    least = F.lit(1e-8)
    each = long.where("held").join(prior, "k").groupBy("bag").agg(F.sum(F.col("w") * (F.ln(F.greatest("w", least)) - F.ln(F.greatest("p", least)))).alias("kl"))
    return float(each.agg(F.avg("kl")).first()[0])


def train(
    rows: DataFrame, proportions: DataFrame, bag: str, key: str, features: str, families: Sequence[str], held: Column, hidden: Sequence[int] = (256, 128, 64, 512), epochs: int = 30, steps: int = 4, bag_size: int = 2048, warm: int = 5,
    peak: float = 1e-3, least: float = 1e-5, decay: float = 0.0, clip: float = 1.0, frozen: int = 1, koleo: float = 0.2, tau: float = 0.05, eps: float = 0.02, dropout: float = 0.2, noise: float = 1.0, seed: int = 42,
) -> tuple[Network, list[tuple[int, float, float, float]], float]:
    """The network of least divergence on held-out bags, (epoch, rate, loss, held divergence) of each epoch, and the divergence of the class prior.

    proportions: (bag, w); held: whether a row's bag is held out; families: the
    augmentation family of each feature. An epoch deals the bags into `steps`
    by hash, each step is one movement of the weights by the mean gradient of
    its bags.
    """
    spark = rows.sparkSession
    dealt = chunks(rows, proportions, bag, key, features, held, bag_size).persist()
    first = dealt.where("not held").select("x", "w").first()
    if first is None:
        raise ValueError("no bag to learn from")
    width, kinds = len(first["x"][0]), len(first["w"])
    known = [F.when(~F.isnan(c), c) for c in (F.get(features, F.lit(i)).cast("double") for i in range(width))]
    facts = rows.where(~held).agg(F.array(*[F.avg(c) for c in known]), F.array(*[F.stddev_pop(c) for c in known]), F.array(*[F.percentile_approx(c, 0.5) for c in known])).first()
    mean, std, medians = (np.array([v or 0.0 for v in part], float) for part in facts)
    model = replace(Network.random(width, hidden, kinds, tau, eps, seed), medians=medians, mean=mean, std=std)
    prior = prior_divergence(dealt)
    moved, spread, best, log, t = np.zeros_like(model.flat), np.zeros_like(model.flat), (math.inf, model), [], 0
    for epoch in range(epochs):
        rate, loss_sum, bags = learning_rate(epoch, warm, epochs, peak, least), 0.0, 0.0
        turn = F.pmod(F.lit(epoch) + F.pmod(F.xxhash64("bag"), F.col("chunks")), F.col("chunks"))
        for step in range(steps):
            chosen = dealt.where((F.col("chunk") == turn) & ~F.col("held") & (F.pmod(F.xxhash64("bag", F.lit(epoch)), F.lit(steps)) == step)).select("bag", "w", "x")
            shared = spark.sparkContext.broadcast(model)

            def run(batches: Iterator[pd.DataFrame], shared=shared, epoch=epoch) -> np.ndarray | None:
                total = None
                for part in batches:
                    for b, w, x in zip(part["bag"], part["w"], part["x"], strict=True):
                        loss, slope = shared.value.bag_slope(_matrix(x), np.asarray(w, float), families, [seed, epoch, zlib.crc32(str(b).encode())], dropout, noise)
                        one = np.concatenate([[1.0, loss], slope])
                        total = one if total is None else total + one
                return total

            sums = added(chosen, run)
            shared.unpersist()
            if not np.ndim(sums) or not sums[0]:
                continue  # no bag fell to this step
            apart, apart_slope = model.apart()
            slope = sums[2:] / sums[0] + koleo * apart_slope
            loss_sum, bags, t = loss_sum + sums[1] + sums[0] * koleo * apart, bags + sums[0], t + 1
            moving = np.ones_like(slope)
            if epoch < frozen:
                model.arrays(moving)["prototypes"][:] = 0
            slope = slope * moving
            slope *= min(1.0, clip / max(float(np.linalg.norm(slope)), 1e-12))
            moved, spread = 0.9 * moved + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
            change = (moved / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.999**t)) + 1e-8)
            model = replace(model, flat=model.flat - rate * moving * (change + decay * model.flat))
        kl = float(bag_divergence(dealt.where("held"), model).agg(F.avg("kl")).first()[0] or 0.0)
        log.append((epoch, rate, float(loss_sum / max(bags, 1.0)), kl))
        best = min(best, (kl, model), key=lambda x: x[0])
    dealt.unpersist()
    return best[1], log, prior
