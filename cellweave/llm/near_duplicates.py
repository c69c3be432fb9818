"""MinHash near-duplicates with sequential Bayesian verification.

Two texts are linked if their sets of 5-word shingles overlap by at least
`threshold`. One pass over the texts makes a row of figures for each document:
the set's size, a 128-bit digest of the set and a MinHash signature. Equal sets
become one class at once, so thousands of copies cost one row. Classes that share a band of their signatures are
candidates, and no bucket is expanded into pairs:

1. every member of a bucket is held against the bucket's smallest class only;
2. signatures are compared in batches: as soon as the posterior probability
   that the overlap reaches the threshold, given m of n equal values and a flat
   prior, is under `miss`, the pair is dropped;
3. survivors are confirmed on their full shingle sets, and linked classes are
   contracted into components;
4. what step 1 leaves out are pairs of a bucket of which one isn't linked with
   the smallest class; those members meet the bucket's other components in
   blocks of bounded size, by steps 2 and 3 within the block, each pair in the
   first band that it shares; a block returns only links that join components.
   A crowded bucket is divided first: its members meet only where their sets
   are of like size and four more values of their signatures agree.

A link is lost if no band of two linked texts agrees, if step 2 drops it (a
chance of `miss` given what it has seen), or if of a crowded bucket's pair none
of the other groups of four values agrees. Bands are as long as leaves the
first chance under 1 in 100,000 at the threshold itself: 20 bands of 5 rows at
0.85, 25 of 4 at 0.8; the last one is 4e-8 at 0.85 and 4e-6 at 0.8; all fall
fast above.

Defined cases: null text, or one without words, has no shingles, is linked with
nothing and is its own component; rows without doc_id have component null and
are kept; repeated rows of an id share its component, and if their texts differ
all of them are linked through it; texts of any length are compared whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, importable, is_empty, small, store
from .text import U64, mix, raw, shingles, slices

HASHES = 100
MULTIPLY = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)
ADD = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x9FB21C651E98DF25))


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, HASHES) of uint32: the smallest of each hash over a row's shingles; rows without any are all ones."""
    n = len(at) - 1
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    starts = at[full]
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat(((sets * MULTIPLY[k] + ADD[k]) >> U64(32)).astype(np.uint32), starts)
    return out


def digests(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """16 bytes of each row's set; none for empty sets."""
    full = np.flatnonzero(np.diff(at))
    out: list[bytes | None] = [None] * (len(at) - 1)
    if len(full):
        with np.errstate(over="ignore"):
            a = np.add.reduceat(sets, at[full])
            b = np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D)), at[full])
        for i, x, y in zip(full, a, b, strict=True):
            out[i] = x.tobytes() + y.tobytes()
    return out


def figures(docs: DataFrame, k: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, signature), one for each row."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets, at = shingles(*raw(part.column("text")), k)
                signed = signatures(sets, at)
                flat = pa.array([row.tobytes() if n else None for row, n in zip(signed, np.diff(at), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(at)), pa.array(digests(sets, at), pa.binary()), flat], ["doc_id", "text_hash", "n_shingles", "digest", "signature"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, text_hash long, n_shingles long, digest binary, signature binary")


def band_rows(threshold: float, lost: float = 1e-5) -> int:
    """The longest band that divides a signature and misses a pair at the threshold with a chance of at most `lost`."""
    return max(r for r in (1, 2, 4, 5, 10) if (1 - threshold**r) ** (HASHES // r) <= lost or r == 1)


def least_equal(threshold: float, miss: float, step: int = 20) -> list[tuple[int, int]]:
    """(n, m): after n values, fewer than m equal ones leave a posterior of under `miss`.

    With a flat prior the posterior is Beta(m + 1, n - m + 1), and its mass from
    the threshold on is the chance of at most m successes in n + 1 trials.
    """
    bounds = []
    for n in range(step, HASHES + 1, step):
        total, m = 0.0, 0
        for m in range(n + 1):  # noqa: B007
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
        bounds.append((n, m))
    return bounds


def surviving(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (rows of a and b) that no batch of the comparison drops."""
    alive, equal, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, m in bounds:
        equal = equal + (a[alive, done:n] == b[alive, done:n]).sum(1)
        ok = equal >= m
        alive, equal, done = alive[ok], equal[ok], n
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    data, at = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint32).reshape(-1, HASHES) if len(column) else np.zeros((0, HASHES), np.uint32)


def prune(pairs: DataFrame, signed: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (a, b) that the sequential comparison of signatures leaves."""
    bounds = least_equal(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(surviving(_matrix(batch.column("_x")), _matrix(batch.column("_y")), bounds))).select(["a", "b"])

    x = signed.select(F.col("node").alias("a"), F.col("signature").alias("_x"))
    y = signed.select(F.col("node").alias("b"), F.col("signature").alias("_y"))
    joined = pairs.join(y, "b").join(x, "a").select("a", "b", "_x", "_y")
    kind = dict(pairs.dtypes)["a"]
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def overlap_meets(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets; empty ones meet nothing."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, k: int = 5, block: int = 256) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold: 100 * intersection >= percent * union.

    A text a is sent to its partners in salted groups of about `block`; groups
    are streamed in order, so a task holds one set and one run of texts.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
    salted = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.floor(F.col("_n") / block) + 1).alias("_s"))
    salted = store(salted, "salted")
    right = salted.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "_s", F.lit(1).alias("_o"), "b", "text")
    left = salted.select("a", "_s").distinct().join(texts.select(F.col("node").alias("a"), "text"), "a").select("a", "_s", F.lit(0).alias("_o"), F.col("a").alias("b"), "text")
    importable(pairs.sparkSession)
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.zeros(0, U64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets, at = shingles(*raw(part.column("text")), k)
                firsts, seconds, second = part.column("a").to_pylist(), part.column("b").to_pylist(), part.column("_o").to_pylist()
                found: tuple[list, list] = ([], [])
                for i, (a, b, o) in enumerate(zip(firsts, seconds, second, strict=True)):
                    mine = sets[at[i] : at[i + 1]]
                    if not o:
                        held, own = a, mine
                    elif held == a and overlap_meets(own, mine, percent):
                        found[0].append(a)
                        found[1].append(b)
                yield pa.RecordBatch.from_arrays([pa.array(found[0], part.schema.field("a").type), pa.array(found[1], part.schema.field("a").type)], ["a", "b"])

    # the row of a itself comes first in its group: the sort is on (a, _s, _o)
    rows = left.unionByName(right).repartition("a", "_s").sortWithinPartitions("a", "_s", "_o")
    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def divided(rows: DataFrame, signed: DataFrame, percent: int, length: int) -> DataFrame:
    """The members of crowded buckets, each in the buckets that it shares with members of like size and four more equal values.

    Sizes fall into classes a factor of 100 / percent wide; linked sets lie in
    the same class or in neighbouring ones, so a member goes to its own class and
    the next one. The values of the band itself, equal for all, are left out.
    """
    four = F.transform(F.sequence(F.lit(0), F.lit(HASHES // 4 - 1)), lambda g: F.struct(g.alias("g"), F.xxhash64(F.col("signature").substr(g * 16 + 1, F.lit(16))).alias("h")))
    inside = lambda g: (g["g"] * 4 >= F.col("band") * length) & (g["g"] * 4 + 4 <= (F.col("band") + 1) * length)
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / (math.log(100 / percent) * (1 + 1e-9)))
    known = rows.join(signed.select("node", "signature", size.alias("_size")), "node")
    each = known.withColumn("_size", F.explode(F.array("_size", F.col("_size") + 1))).withColumn("_g", F.explode(F.filter(four, lambda g: ~inside(g))))
    return each.select(F.xxhash64("bucket", "_size", "_g.g", "_g.h").alias("bucket"), "band", "node", "component", "other")


def mixed_cells(bands: DataFrame, leaders: DataFrame, labels: DataFrame, signed: DataFrame, percent: int, length: int, block: int = 512, crowd: int = 48) -> DataFrame:
    """(bucket, band, i, j, side, node, component, signature): what step 4 compares.

    Of the buckets with a member in another component than their smallest class,
    members of that class's component are dealt to blocks; the others go to every
    block, in blocks of their own kind. A cell (i, j) holds block i of the others
    (side 0) against block j (side 1), so no task has more than two blocks of a
    bucket, and pairs of attached members meet nowhere. Buckets in which a row
    would go to more than about `crowd` blocks are divided first.
    """
    named = bands.join(leaders, "bucket").join(labels, "node", "left")
    named = named.select("bucket", "band", "node", "leader", F.coalesce("component", "node").alias("component"))
    named = store(named.join(labels.select(F.col("node").alias("leader"), F.col("component").alias("_lead")), "leader", "left").withColumn("other", F.col("component") != F.coalesce("_lead", "leader")).drop("_lead"), "members")

    def counted(members: DataFrame) -> DataFrame:
        """Their rows with m, the members of the bucket, and d, the others among them, of buckets that hold any."""
        mixed = store(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("other").cast("long")).alias("d")).where("d > 0 and m > 1"), "mixed-buckets")
        return members.join(small(mixed), "bucket")

    rows = store(counted(named.where("node <> leader").select("bucket", "band", "node", "component", "other")), "rows")
    crowded = (F.col("m") + 2 * F.col("d")) > crowd * block
    few = rows.where(~crowded)
    if not is_empty(rows.where(crowded)):
        few = few.unionByName(counted(store(divided(rows.where(crowded), signed, percent, length), "divided")))
    spot = F.xxhash64("node")
    blocks = F.floor(F.col("m") / block) + 1
    mine, others = F.floor(F.col("d") / block) + 1, F.col("other")
    home = F.pmod(spot, F.when(others, mine).otherwise(blocks))
    # columns j below `blocks` hold the attached, from there on the others
    as_row = F.transform(F.sequence(F.lit(0), blocks + mine - 1), lambda j: F.struct(home.alias("i"), j.alias("j"), F.lit(0).alias("side")))
    as_column = F.transform(F.sequence(F.lit(0), mine - 1), lambda i: F.struct(i.alias("i"), F.when(others, blocks + home).otherwise(home).alias("j"), F.lit(1).alias("side")))
    cells = few.select("bucket", "band", "node", "component", F.explode(F.when(others, F.concat(as_row, as_column)).otherwise(as_column)).alias("c"))
    cells = store(cells.select("bucket", "band", "c.i", "c.j", "c.side", "node", "component").join(signed.select("node", "signature"), "node"), "mixed")
    forget(named, rows)
    return cells


class _Cell:
    """The side 0 of a cell while its side 1 goes by."""

    def __init__(self, bounds: list[tuple[int, int]], length: int) -> None:
        self.bounds, self.length, self.key = bounds, length, None

    def start(self, key: tuple) -> None:
        self.key, self.reps, self.comps, self.sets, self._signs, self.signs = key, [], [], [], [], None
        self.parent: dict = {}

    def hold(self, rep, comp, sign: np.ndarray, own: np.ndarray | None = None) -> None:
        self.reps.append(rep)
        self.comps.append(comp)
        self.sets.append(own)
        self._signs.append(sign)

    def root(self, comp):
        while (up := self.parent.get(comp, comp)) != comp:
            comp = up
        return comp

    def candidates(self, band: int, comp, sign: np.ndarray) -> np.ndarray:
        """Held rows of other components that the comparison leaves and that no earlier band has shown to this row, likeliest first."""
        if not self.reps:
            return np.zeros(0, np.int64)
        if self.signs is None:
            self.signs, self.names = np.stack(self._signs), np.array(self.comps)
        near = surviving(self.signs, np.broadcast_to(sign, self.signs.shape), self.bounds)
        near = near[self.names[near] != comp]
        equal = self.signs[near] == sign
        before = equal[:, : band * self.length].reshape(len(near), band, self.length).all(2).any(1) if band else np.zeros(len(near), bool)
        return near[~before][np.argsort(-equal[~before].sum(1), kind="stable")]


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")), strict=True))


def left_over(cells: DataFrame, texts: DataFrame, percent: int, miss: float, k: int, length: int) -> DataFrame:
    """Links (a, b) between different components that mixed_cells() holds.

    A first pass on signatures finds the rows that have a candidate at all; only
    they get their texts. A second pass confirms candidates on the full sets
    where it finds them and emits a link only between rows that the cell hasn't
    joined yet, so a cell returns less than one link for each of its rows.
    """
    importable(cells.sparkSession)
    bounds, kind = least_equal(percent / 100, miss), dict(cells.dtypes)["node"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, hit = _Cell(bounds, length), set()
        for batch in batches:
            id_type, out = batch.schema.field("node").type, []
            signs = _matrix(batch.column("signature"))
            for r, (key, band, side, rep, comp) in enumerate(zip(_keys(batch), *(batch.column(c).to_pylist() for c in ("band", "side", "node", "component")), strict=True)):
                if key != cell.key:
                    cell.start(key)
                    hit = set()
                if not side:
                    cell.hold(rep, comp, signs[r])
                elif len(near := cell.candidates(band, comp, signs[r])):
                    out.append((*key, 1, rep))
                    out.extend((*key, 0, cell.reps[p]) for p in near if p not in hit)
                    hit.update(near.tolist())
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), id_type]
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], t) for n, t in enumerate(types)], ["bucket", "i", "j", "side", "node"])

    order = ["bucket", "i", "j", "side", "node"]
    hits = store(cells.repartition("bucket", "i", "j").sortWithinPartitions(*order).mapInArrow(look, f"bucket long, i long, j long, side int, node {kind}"), "hits")
    if is_empty(hits):
        return hits.select(F.col("node").alias("a"), F.col("node").alias("b"))
    full = cells.join(hits, order, "left_semi").join(texts, "node")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = _Cell(bounds, length)
        for batch in batches:
            for part in slices(batch, "text"):
                sets, at = shingles(*raw(part.column("text")), k)
                signs, made = _matrix(part.column("signature")), ([], [])
                for r, (key, band, side, rep, comp) in enumerate(zip(_keys(part), *(part.column(c).to_pylist() for c in ("band", "side", "node", "component")), strict=True)):
                    mine = sets[at[r] : at[r + 1]]
                    if key != cell.key:
                        cell.start(key)
                    if not side:
                        cell.hold(rep, comp, signs[r], mine)
                        continue
                    for p in cell.candidates(band, comp, signs[r]):
                        x, y = cell.root(comp), cell.root(cell.comps[p])
                        if x != y and overlap_meets(cell.sets[p], mine, percent):
                            cell.parent[max(x, y)] = min(x, y)
                            made[0].append(min(rep, cell.reps[p]))
                            made[1].append(max(rep, cell.reps[p]))
                yield pa.RecordBatch.from_arrays([pa.array(x, part.schema.field("node").type) for x in made], ["a", "b"])

    found = store(full.select("bucket", "band", "i", "j", "side", "node", "component", "signature", "text").repartition("bucket", "i", "j").sortWithinPartitions(*order).mapInArrow(settle, f"a {kind}, b {kind}").distinct(), "left-over")
    forget(hits)
    return found


def links(docs: DataFrame, classes: DataFrame, percent: int, k: int, miss: float) -> DataFrame:
    """Edges (a, b) between linked classes (node, doc_id, text_hash, n_shingles, signature) that contract into the components of all links."""
    threshold = percent / 100
    length = band_rows(threshold)
    signed = classes.select("node", "n_shingles", "signature")
    band = F.transform(F.sequence(F.lit(0), F.lit(HASHES // length - 1)), lambda b: F.xxhash64(b, F.col("signature").substr(b * (4 * length) + 1, F.lit(4 * length))))
    bands = store(signed.select("node", F.posexplode(band).alias("band", "bucket")), "bands")
    leaders = store(bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket", "leader"), "leaders")
    pairs = bands.join(leaders, "bucket").where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    pending = store(prune(pairs, signed, threshold, miss), "pending")
    # the texts of all members of shared buckets, fetched once for both confirmations
    needed = store(bands.join(leaders, "bucket").select("node").distinct().join(classes.select("node", "doc_id", "text_hash"), "node"), "needed")
    texts = store(_texts(docs, needed), "texts")
    # each class first meets its smallest partner; the pairs that this leaves between different components follow
    first = pending.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    edges = store(confirm(first, texts, percent, k), "edges")
    labels = components(edges)
    rest = store(_apart(pending, labels).join(first, ["a", "b"], "left_anti"), "rest")
    if not is_empty(rest):
        edges = store(edges.unionByName(confirm(rest, texts, percent, k)), "edges")
        labels = components(edges)
    forget(pending, needed, rest)
    cells = mixed_cells(bands, leaders, labels, signed, percent, length)
    if not is_empty(cells):
        more = left_over(cells, texts, percent, miss, k, length)
        if not is_empty(more):
            edges = store(edges.unionByName(more), "edges")
    forget(bands, leaders, texts, cells)
    return edges


def _texts(docs: DataFrame, needed: DataFrame, few: int = 500_000) -> DataFrame:
    """(node, text) for needed (node, doc_id, text_hash); up to `few` of them, some 20 MB, go to the texts, beyond that the texts are shuffled to them."""
    named = docs.where("text is not null and doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return named.join(small(needed, few), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("node", "text")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("_a"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 5, miss: float = 1e-9, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = store(figures(named, k), "figures")
    whole = rows.where("digest is not null and doc_id is not null")
    first = F.min(F.struct("doc_id", "text_hash")).alias("_first")
    classes = whole.groupBy("digest").agg(first, F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = classes.select("digest", "_first.doc_id", "_first.text_hash", "n_shingles", "signature")
    # a class is named by its smallest id, unless an id has several texts: then by a number, in the same order, since
    # later documents are more often edits of earlier ones than of each other, and a bucket's smallest class leads it
    several = store(whole.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("_z")).where("a <> _z").select("doc_id", "a"), "several")
    alone = is_empty(several)
    if alone:
        classes = store(classes.select(F.col("doc_id").alias("node"), "*"), "classes")
    else:
        ordered = classes.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
        classes = store(ordered.select(F.monotonically_increasing_id().alias("node"), "*"), "classes")
    edges = links(named, classes, percent, k, miss)
    if not alone:  # an id with several texts links their classes
        ends = whole.join(several, "doc_id").where("digest <> a").select("a", F.col("digest").alias("b")).distinct()
        for end in "ab":
            ends = ends.join(classes.select(F.col("digest").alias(end), F.col("node").alias(f"_{end}")), end)
        edges = edges.unionByName(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    labels = components(edges)
    named_by = labels.join(classes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    to = classes.select("node", "digest", "doc_id").join(labels.join(named_by, "component"), "node", "left").select("digest", F.coalesce("component_id", "doc_id").alias("component_id"))
    joined = rows.select("doc_id", "n_shingles", "digest").join(to, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
