"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are dealt by norm to bands, each scaled by the largest norm in it, and get
one more component that makes all norms 1, so within a band the largest inner
product is the smallest Euclidean distance, and a few long vectors don't shrink
the others. A band spans a factor of 2, or as much more as leaves no more than
`BANDS` of them; a query visits the same cells in each. Each of `tables` tables cuts `k` Gaussian projections into cells of width
`width`. k follows from the number of vectors, so that a bucket holds a falling
share of them. A query visits its own buckets and, over all tables in the order
of the estimated chance of success (the sum of squared distances to the cell
borders crossed), the likeliest perturbed ones, `probes` a table on average. If
not given, `probes` is the least of a rising series at which `RECALL` of the true
neighbours of `SAMPLE` queries lie in visited buckets; their true neighbours come
from one pass over all vectors.
What the tables find is merged and reranked by the inner product of the original
vectors in double precision.

A vector that occurs many times is kept by its smallest ids only, one more than
neighbours asked for: no further copy can be among anyone's nearest. Equal
queries are searched once. Buckets are dealt to groups of bounded size; a bucket
of more than `block` vectors is cut into blocks, and one of more than `block`
visitors is copied for each block of them. A group's vectors come first and its
queries are answered as they stream by, so a task holds one group's vectors and
a few hundred queries. Every group returns its nearest only, so no pairs are
emitted. A query that finds fewer than it should is searched again against all
vectors in the same blocks, which is exact.

Recall at the production parameters is measured against brute force in the
tests and the README. Defined cases: vectors that are null, empty, zero or hold
null or non-finite components take no part as query or candidate; vectors of
different lengths are never neighbours; ties go to the smaller vec_id; repeated
rows of an id are one candidate, with the smallest of their vectors; null ids
take no part; fewer candidates than asked for are all returned; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, importable, is_empty, small, store


BANDS = 8
SAMPLE, RECALL = 100, 0.93
PROBES = (20, 40, 80, 120, 180, 270, 400, 600, 900, 1350, 2000)


def perturbations(k: int, most: int) -> np.ndarray:
    """Sets of ranks of the 2k border distances of k cells, sorted: at most `most` of them, likeliest first, padded with -1.

    Their order is that of the expected costs for uniform positions; a set never
    crosses both borders of one cell, whose ranks are r and 2k - 1 - r.
    """
    near = [(j + 1) * (j + 2) / (4 * (k + 1) * (k + 2)) for j in range(k)]
    far = [1 - (j + 1) / (k + 1) + near[j] for j in reversed(range(k))]
    cost, found, heap = near + far, [()], [(near[0], (0,))]
    while heap and len(found) < most:
        total, ranks = heapq.heappop(heap)
        if all(2 * k - 1 - r not in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    width = max(map(len, found)) or 1
    return np.array([[*ranks, *[-1] * (width - len(ranks))] for ranks in found], np.int64)


@dataclass
class Bands:
    """Norms from the largest down: band i holds those of `width` eighths of a power of two below `top`, scaled by the largest in it."""

    top: int
    width: int
    scales: dict[int, float]

    @classmethod
    def of(cls, found: list[tuple[int, float]], most: int = BANDS) -> Bands:
        """The bands of (eighths, largest norm) pairs: a factor of 2 each, or as many times squared as leaves no more than `most`."""
        top, width = max((e for e, _ in found), default=0), 8
        while len({(top - e) // width for e, _ in found}) > most:
            width *= 2
        scales: dict[int, float] = {}
        for e, norm in found:
            scales[(top - e) // width] = max(scales.get((top - e) // width, 0.0), norm * (1 + 1e-9))
        return cls(top, width, scales)

    def place(self, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The band of each norm, and its scale."""
        band = (self.top - eighths(norms)) // self.width
        return band, np.array([self.scales[b] for b in band.tolist()])


class Hashing:
    def __init__(self, bands: Bands, tables: int = 8, k: int = 8, width: float = 2.5, probes: int = 80, seed: int = 11) -> None:
        self.bands, self.tables, self.k, self.width, self.probes, self.seed = bands, tables, k, width, probes, seed
        self.sets = perturbations(k, 2 * probes)
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def planes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Gaussian projections and offsets of all tables for vectors of a length."""
        if length not in self._planes:
            rng = np.random.default_rng([self.seed, length])
            self._planes[length] = rng.normal(size=(length + 1, self.tables * self.k)), rng.uniform(0, self.width, self.tables * self.k)
        return self._planes[length]

    def cells(self, scaled: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """(n, tables, k) of positions in cell widths."""
        a, b = self.planes(scaled.shape[1])
        return ((np.column_stack([scaled, rest]) @ a + b) / self.width).reshape(len(scaled), self.tables, self.k)

    def keys(self, cells: np.ndarray, table: np.ndarray, length: int, band: np.ndarray) -> np.ndarray:
        """A 63-bit key of (table, length, band, cells)."""
        with np.errstate(over="ignore"):
            h = (table.astype(np.uint64) * np.uint64(1000003) + np.uint64(length + 1)) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (band.astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            for j in range(self.k):
                h = (h ^ cells[..., j].astype(np.uint64)) * np.uint64(0x100000001B3)
                h ^= h >> np.uint64(29)
        return (h >> np.uint64(1)).astype(np.int64)

    def own(self, vectors: np.ndarray) -> np.ndarray:
        """(n, tables): the bucket of each vector."""
        norms = norms_of(vectors)
        band, scale = self.bands.place(norms)
        cells = np.floor(self.cells(vectors / scale[:, None], np.sqrt(np.maximum(0, 1 - (norms / scale) ** 2)))).astype(np.int64)
        return self.keys(cells, np.broadcast_to(np.arange(self.tables), cells.shape[:2]), vectors.shape[1], band[:, None])

    def probed(self, vectors: np.ndarray) -> np.ndarray:
        """(n, bands * tables * probes): the buckets a query visits."""
        n, at = len(vectors), self.cells(vectors / norms_of(vectors)[:, None], np.zeros(len(vectors)))
        floor = np.floor(at).astype(np.int64)
        low = at - floor
        distances = np.concatenate([low, 1 - low], 2)  # down, up
        order = np.argsort(distances, 2)
        padded = np.concatenate([np.take_along_axis(distances, order, 2) ** 2, np.zeros((n, self.tables, 1))], 2)
        total = padded[:, :, self.sets].sum(3).reshape(n, -1)
        visits = min(self.tables * self.probes, total.shape[1])
        best = np.argpartition(total, visits - 1, axis=1)[:, :visits]
        table, ranks = best // len(self.sets), self.sets[best % len(self.sets)]
        row = np.arange(n)[:, None]
        cells = floor[row, table]
        for j in range(ranks.shape[2]):
            r, c = np.nonzero(ranks[:, :, j] >= 0)
            crossed = order[r, table[r, c], ranks[r, c, j]]
            cells[r, c, crossed % self.k] += np.where(crossed < self.k, -1, 1)
        return np.concatenate([self.keys(cells, table, vectors.shape[1], np.array(b)) for b in self.bands.scales], 1)

    def hits(self, query: np.ndarray, true: np.ndarray) -> int:
        """How many of a query's true neighbours lie in buckets that it visits."""
        return int(np.isin(self.own(true), self.probed(query[None])[0]).any(1).sum())


def norms_of(vectors: np.ndarray) -> np.ndarray:
    """Lengths, of very long and very short vectors too."""
    top = np.abs(vectors).max(1)
    return top * np.linalg.norm(vectors / top[:, None], axis=1)


def eighths(norms: np.ndarray) -> np.ndarray:
    """The logarithms of norms, in whole eighths of a power of two."""
    return np.floor(8 * np.log2(norms)).astype(np.int64)


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column."""
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(lengths)[:-1].astype(int)) if len(lengths) else []


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of each vector length."""
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, values[np.repeat(lengths == n, lengths)].reshape(len(rows), n).astype(np.float64)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, one for each id."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vec")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(fine).groupBy("vec_id").agg(F.min("vec").alias("vec"))


class Held:
    """A group's vectors of one length, by bucket, and the search among them."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.last = np.append(self.first[1:], len(keys))
        self.ids, self.matrix = ids[order], matrix[order].astype(np.float64)
        self.largest = np.linalg.norm(self.matrix, axis=1).max()

    def nearest(self, wanted: np.ndarray, visits: list[np.ndarray], n: int, side: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, exact score): the n best rows of each query's buckets, ties to the smaller id.

        A fast score within rounding of a query's n-th best so far is kept, how
        many there are, and what is kept is scored exactly and cut to the n best.
        """
        owner, flat = np.repeat(np.arange(len(wanted)), [len(v) for v in visits]), np.concatenate(visits)
        at = np.minimum(np.searchsorted(self.keys, flat), len(self.keys) - 1)
        owner, at = owner[self.keys[at] == flat], at[self.keys[at] == flat]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        visited, start = np.unique(at, return_index=True)
        end = np.append(start[1:], len(at))
        margin = 4 * wanted.shape[1] * np.finfo(float).eps * np.linalg.norm(wanted, axis=1) * self.largest
        border = np.full(len(wanted), -np.inf)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def cut() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            query, row = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.zeros(0, np.int64),) * 2
            exact = np.concatenate([np.zeros(0), *[(self.matrix[row[i : i + 65536]] * wanted[query[i : i + 65536]]).sum(1) for i in range(0, len(row), 65536)]])
            near = exact >= border[query] - margin[query]  # the border has risen since most of them were kept
            query, row, exact = query[near], row[near], exact[near]
            order = np.lexsort((self.ids[row], -exact, query))
            query, row, exact = query[order], row[order], exact[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            full = place == n - 1
            border[query[full]] = np.maximum(border[query[full]], exact[full] - margin[query[full]])
            return query[place < n], row[place < n], exact[place < n]

        # large buckets first: they soon set borders that the small ones are held against
        for j in np.argsort(self.first[visited] - self.last[visited], kind="stable"):
            for x in range(start[j], end[j], side):
                who = owner[x : min(x + side, end[j])]
                for a in range(self.first[visited[j]], self.last[visited[j]], side):
                    b = min(a + side, self.last[visited[j]])
                    scores = wanted[who] @ self.matrix[a:b].T
                    near = scores >= border[who, None]
                    if b - a > n and np.count_nonzero(near) > 4 * n * len(who):
                        border[who] = np.maximum(border[who], np.partition(scores, b - a - n, axis=1)[:, b - a - n] - margin[who])
                        near = scores >= border[who, None]
                    query, row = np.nonzero(near)
                    kept.append((who[query], row + a))
                    size += len(query)
                    if size > 32 * n * len(wanted):
                        kept[:] = [cut()[:2]]
                        size = len(kept[0][0])
        return cut()


def search_blocks(data: DataFrame, queries: DataFrame, n: int, groups: int, at_once: int = 1024) -> DataFrame:
    """(query, vec_id, score): the n best of each query in each group, data (g, key, vec_id, vec) and queries (g, keys, query, vec) meeting by g and key.

    A group's rows come as one sorted stream, data first; queries are answered `at_once` at a time.
    """
    vec = dict(data.dtypes)["vec"]
    id_kind = dict(data.dtypes)["vec_id"]
    rows = data.select("g", F.lit(0).alias("o"), F.array("key").alias("keys"), F.col("vec_id").alias("id"), "vec").unionByName(queries.select("g", F.lit(1).alias("o"), "keys", F.col("query").alias("id"), "vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, coming, held = None, {}, None
        for batch in batches:
            kind = batch.schema.field("id").type
            groups, sides = batch.column("g").to_numpy(), batch.column("o").to_numpy()
            cuts = np.flatnonzero((groups[1:] != groups[:-1]) | (sides[1:] != sides[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(groups)], strict=True):
                if a == b:
                    continue
                if groups[a] != group:
                    group, coming, held = groups[a], {}, None
                part = batch.slice(a, b - a)
                if not sides[a]:
                    for at, matrix in _by_length(part.column("vec")):
                        some = part.take(pa.array(at))
                        coming.setdefault(matrix.shape[1], []).append((some.column("keys").flatten().to_numpy(), np.array(some.column("id").to_pylist()), matrix.astype(np.float32) if vec == "array<float>" else matrix))
                    continue
                if held is None:
                    held = {length: Held(*(np.concatenate(x) for x in zip(*parts, strict=True))) for length, parts in coming.items()}
                    coming = {}
                for at, matrix in _by_length(part.column("vec")):
                    own = held.get(matrix.shape[1])
                    for i in range(0, len(at) if own else 0, at_once):
                        some = part.take(pa.array(at[i : i + at_once]))
                        query, row, score = own.nearest(matrix[i : i + at_once], _lists(some.column("keys")), n)
                        yield pa.RecordBatch.from_arrays([some.column("id").take(pa.array(query)), pa.array(own.ids[row], kind), pa.array(score)], ["query", "vec_id", "score"])

    assert vec == dict(queries.dtypes)["vec"]
    return rows.repartitionById(min(groups, 10_000), F.col("g")).sortWithinPartitions("g", "o").mapInArrow(run, f"query {id_kind}, vec_id {id_kind}, score double")


def best(found: DataFrame, n: int) -> DataFrame:
    """(query, vec_id, score, place): the n best of each query over all groups and tables."""
    merged = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    return merged.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= n)


def cells_for(n: int) -> int:
    """Projections of a table for n vectors: a bucket's share of them falls about as n to the power -0.7."""
    return max(4, round(0.64 * float(np.log2(max(n, 2)))))


def norm_powers(vectors: DataFrame) -> list:
    """(e, n, top) rows: how many vectors have a norm of each eighth of a power of two, and their largest norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = np.concatenate([np.zeros(0), *[norms_of(matrix) for _, matrix in _by_length(batch.column("vec"))]])
            e, at = np.unique(eighths(norms), return_inverse=True)
            top = np.zeros(len(e))
            np.maximum.at(top, at, norms)
            yield pa.RecordBatch.from_arrays([pa.array(e), pa.array(np.bincount(at, minlength=len(e))), pa.array(top)], ["e", "n", "top"])

    return vectors.select("vec").mapInArrow(run, "e long, n long, top double").groupBy("e").agg(F.sum("n").alias("n"), F.max("top").alias("top")).collect()  # at most some 17,000 of them


def true_neighbours(data: DataFrame, sample: list[tuple[object, np.ndarray]], n: int) -> dict[object, np.ndarray]:
    """The n nearest vectors of a few queries (id, vector), by one pass over all vectors; each task keeps the nearest of its rows."""
    shared = data.sparkSession.sparkContext.broadcast(sample)  # SAMPLE vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[float, int, object, np.ndarray]]] = {i: [] for i in range(len(shared.value))}
        turn = 0
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            for rows, matrix in _by_length(batch.column("vec")):
                for i, (own, vec) in enumerate(shared.value):
                    if len(vec) != matrix.shape[1]:
                        continue
                    scores = matrix @ vec
                    for j in np.argsort(-scores, kind="stable")[: n + 1]:
                        if ids[rows[j]] != own:
                            turn += 1
                            item = (float(scores[j]), turn, ids[rows[j]], matrix[j])
                            heapq.heappush(held[i], item) if len(held[i]) < n else heapq.heappushpop(held[i], item)
        found = [(i, *x) for i, h in held.items() for x in h]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[4].tolist() for f in found], pa.list_(pa.float64()))], ["i", "score", "vec"])

    rank = F.row_number().over(W.partitionBy("i").orderBy(F.desc("score"), "vec"))
    rows = data.select("vec_id", "vec").mapInArrow(run, "i int, score double, vec array<double>").withColumn("r", rank).where(F.col("r") <= n).collect()  # n for each query of the sample
    out: dict[object, list] = {}
    for r in rows:
        out.setdefault(sample[r["i"]][0], []).append(r["vec"])
    return {k: np.array(v) for k, v in out.items()}


def enough_probes(hashing_for, sample: list[tuple[object, np.ndarray]], true: dict[object, np.ndarray], recall: float) -> Hashing:
    """The hashing of the fewest probes of the series that finds so much of the sample's true neighbours, or the last one."""
    asked = [(v, true[i]) for i, v in sample if i in true]
    for probes in PROBES:
        hashing = hashing_for(probes)
        if sum(hashing.hits(v, t) for v, t in asked) >= recall * sum(len(t) for _, t in asked):
            break
    return hashing


def nearest(vectors: DataFrame, is_query: str = "vec_id % 20 = 0", n: int = 20, tables: int = 8, k: int | None = None, width: float = 2.5, probes: int | None = None, block: int = 20000, vec_id: str = "vec_id", vector: str = "vec", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) for each usable vector that `is_query` picks."""
    importable(vectors.sparkSession)
    fine = store(usable(vectors, vec_id, vector), "vectors")
    powers = norm_powers(fine)
    total = sum(r["n"] for r in powers)
    bands = Bands.of([(r["e"], r["top"]) for r in powers])
    # more copies of a vector than anyone can have among the nearest take no part
    copies = F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))
    data = store(fine.withColumn("_c", copies).where(F.col("_c") <= n + 1).drop("_c"), "candidates")
    asked = fine.where(is_query)
    hashing_for = lambda p: Hashing(bands, tables, k or cells_for(total), width, p)
    if probes is None:
        sample = [(r["vec_id"], np.array(r["vec"], float)) for r in asked.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).collect()]
        hashing = enough_probes(hashing_for, sample, true_neighbours(data, sample, n), recall)
    else:
        hashing = hashing_for(probes)
    groups_of = asked.groupBy("vec").agg(F.min("vec_id").alias("query"))
    queries = store(groups_of, "queries")
    groups = max(16, -(-total * tables // block))
    id_kind, vec_kind = dict(fine.dtypes)["vec_id"], dict(fine.dtypes)["vec"]

    def hashed(df: DataFrame, name: str, keys) -> DataFrame:
        """(keys, name, vec): the buckets of each vector."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, matrix in _by_length(batch.column("vec")):
                    for i in range(0, len(rows), 64):  # the costs of all perturbations of a query are a wide row
                        part = batch.take(pa.array(rows[i : i + 64]))
                        found = keys(matrix[i : i + 64])
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(found.ravel()))
                        yield pa.RecordBatch.from_arrays([lists, part.column(name), part.column("vec")], ["keys", name, "vec"])

        return df.mapInArrow(run, f"keys array<bigint>, {name} {id_kind}, vec {vec_kind}")

    placed = store(hashed(data, "vec_id", hashing.own), "placed")
    visits = store(hashed(queries, "query", hashing.probed), "visits")
    # a bucket of more than a block of vectors, or of visitors, becomes several cells
    crowds = [df.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block).select("key", (F.floor(F.col("_n") / block) + 1).cast("int").alias(name)) for df, name in ((placed, "_b"), (visits, "_s"))]
    hot = small(store(crowds[0].join(crowds[1], "key", "full").select("key", F.coalesce("_b", F.lit(1)).alias("_b"), F.coalesce("_s", F.lit(1)).alias("_s")), "hot"))

    def dealt(df: DataFrame, name: str, own: str, other: str) -> DataFrame:
        """df's rows with a group for each cell: one block of their own side, all blocks of the other one."""
        flat = df.select(name, *(["vec"] if own == "_b" else []), F.explode("keys").alias("key")).join(hot, "key", "left")
        flat = flat.withColumn(own, F.pmod(F.xxhash64(name), F.coalesce(own, F.lit(1))).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
        return flat.withColumn("g", F.pmod(F.xxhash64("key", "_b", "_s"), F.lit(groups)).cast("int")).drop("_b", "_s")

    routed = dealt(visits, "query", "_s", "_b").groupBy("query", "g").agg(F.collect_set("key").alias("keys"))
    found = store(best(search_blocks(dealt(placed, "vec_id", "_b", "_s"), routed.join(queries, "query").select("g", "keys", "query", "vec"), n + 1, groups), n + 1), "found")
    forget(placed, visits, hot)

    # shortfall: fewer than there are vectors of the query's length, itself among them
    lengths = small(store(data.groupBy(F.size("vec").alias("_l")).agg(F.count(F.lit(1)).alias("_n")), "lengths"))
    enough = queries.join(found.groupBy("query").agg(F.count(F.lit(1)).alias("_f")), "query", "left").join(lengths, F.size("vec") == F.col("_l"))
    short = store(enough.where(F.coalesce("_f", F.lit(0)) < F.least(F.lit(n + 1), "_n")).select("query", "vec"), "short")
    if not is_empty(short):
        pieces = max(1, -(-total // block))
        everything = data.select(F.pmod(F.xxhash64("vec_id"), F.lit(pieces)).cast("int").alias("g"), F.lit(0).cast("long").alias("key"), "vec_id", "vec")
        again = short.select(F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("g"), F.array(F.lit(0).cast("long")).alias("keys"), "query", "vec")
        exact = best(search_blocks(everything, again, n + 1, pieces), n + 1)
        found = store(found.join(short.select("query"), "query", "left_anti").unionByName(exact), "found")
    members = asked.select(F.col("vec_id").alias("query_id"), "vec").join(groups_of, "vec").select("query_id", "query")
    each = members.join(found.drop("place"), "query").where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")
