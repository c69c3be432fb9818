"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into short paragraphs at points that its own bytes set: after line
breaks, and wherever a rolling hash of the last `REACH` bytes is small, about
every `EVERY` bytes in any script. So an edit touches only the paragraphs it lies
in, and short texts have several. A paragraph's 64-bit digest goes into one cell
of each of three parts of a sketch; a cell holds a count, the xor of digests and
the xor of their checks. Subtracting two versions' sketches cancels what they
share, and peeling cells of one digest recovers the digests in which they differ.
If that fails, the sketch was too small for the difference, and both texts are
sketched again, with other places and eight times larger, up to twice as large
as all their paragraphs and from there on doubled, until it succeeds.

The fingerprint is the sketch of the first size with the paragraph count, in
base 64; larger ones are made from the digests when a comparison needs them.
Likeness is shared paragraphs / all paragraphs, exact once peeling succeeds:
with d differing ones, and a and b in all, (a + b - d) / (a + b + d).

Documents are dealt to tasks by ascending (doc_id, hash of the text), at cuts of
about `part_bytes` of text that a sample of `per_part` keys for each task sets;
a text is shuffled once, and the first one of each task once more.

Defined cases: null text is empty; empty texts have no paragraphs, and two of
them are alike at 1; texts of any length are fingerprinted whole; repeated
paragraphs count by occurrence (the n-th one is its own element); equal texts
have equal fingerprints; the next document is by ascending doc_id, null ids
first, ties by the text's hash; after the last comes the first; a single row is
its own next document; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import importable, small
from .text import BYTE, U64, mix, raw, slices, span_hashes

PARTS = 3
FIRST = 24  # cells of a fingerprint and of the first attempt at a comparison
GROW = 8
EVERY, REACH = 20, 6
SMALL = U64((1 << 64) // EVERY)
TURN = [U64(pow(0xD6E8FEB86659FD93, 2 * k + 1, 1 << 64)) for k in range(REACH)]


@dataclass
class Items:
    """Digests of many texts: values and, ascending, the text each belongs to."""

    values: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Items:
        """A digest for each paragraph; the n-th occurrence of one in a text is an item of its own."""
        data, offsets = raw(pa.array(texts, pa.large_string()))
        n = len(texts)
        if not len(data):
            return cls(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(n, np.int64))
        cut = np.zeros(len(data), bool)
        if len(data) >= REACH:
            rolled = np.zeros(len(data) - REACH + 1, U64)
            with np.errstate(over="ignore"):
                for j in range(REACH):
                    rolled += BYTE[data[j : j + len(rolled)]] * TURN[j]
            cut[REACH - 1 :] = rolled < SMALL
        for j in range(REACH - 1):  # there the bytes before a text's start would count
            at = offsets[:-1] + j
            cut[at[at < offsets[1:]]] = False
        line = data == 10
        line[:-1] &= data[1:] != 10
        cut |= line
        ends = np.union1d(np.flatnonzero(cut) + 1, offsets[1:][np.diff(offsets) > 0])
        starts = np.concatenate([[0], ends[:-1]])
        owner = np.searchsorted(offsets, starts, "right") - 1
        values = span_hashes(BYTE[data], starts, ends)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        firsts = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]))
        nth = np.arange(len(values)) - np.repeat(firsts, np.diff(np.append(firsts, len(values))))
        with np.errstate(over="ignore"):
            values = np.where(nth > 0, mix(values + nth.astype(U64) * U64(0x9E3779B97F4A7C15)), values)
        return cls(values, owner, np.bincount(owner, minlength=n))

    def take(self, texts: np.ndarray) -> Items:
        """The items of some texts, renumbered in the order given (ascending)."""
        new = np.full(len(self.sizes), -1)
        new[texts] = np.arange(len(texts))
        kept = new[self.owner] >= 0
        return Items(self.values[kept], new[self.owner[kept]], self.sizes[texts])


def check(items: np.ndarray) -> np.ndarray:
    return mix(items ^ U64(0x6A09E667F3BCC909))


class Sketches:
    """A sketch for each of many texts: cells of (count, xor of digests, xor of checks), PARTS parts of equal size each."""

    def __init__(self, cells: np.ndarray, turn: int = 0) -> None:
        self.turn = U64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        self.part = (cells // PARTS).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.part * PARTS)]).astype(np.int64)
        n = self.start[-1]
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, U64), np.zeros(n, U64)

    def add(self, values: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> Sketches:
        part, start = self.part[owner].astype(U64), self.start[owner]
        with np.errstate(over="ignore"):
            a = mix(values + U64(0xD1B54A32D192ED03) + self.turn)
            b = (a >> U64(21)) * U64(0x9E3779B97F4A7C15)
            places = [a % part, (a >> U64(32)) % part + part, (b >> U64(32)) % part + part + part]
        checks = check(values)
        for place in places:
            at = place.astype(np.int64) + start
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, values)
            np.bitwise_xor.at(self.checks, at, checks)
        return self

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.part * PARTS)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign) of what could be recovered, and which sketches came out empty."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        of_cell = np.repeat(np.arange(len(self.part)), self.part * PARTS)
        while True:
            pure = np.flatnonzero((self.count == 1) | (self.count == -1))
            pure = pure[check(self.keys[pure]) == self.checks[pure]]
            if not len(pure):
                break
            owner = of_cell[pure]
            _, once = np.unique(self.keys[pure] ^ mix(owner.astype(U64)), return_index=True)
            owner, values, signs = owner[once], self.keys[pure[once]], self.count[pure[once]]
            self.add(values, owner, -signs)
            found.append((owner, values, signs))
        left = np.bincount(of_cell, weights=(self.count != 0) | (self.keys != 0), minlength=len(self.part)) > 0
        empty = np.zeros(0, np.int64)
        owner, values, signs = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (empty, empty.astype(U64), empty)
        return owner, values, signs, ~left

    def texts(self, sizes: np.ndarray) -> list[str]:
        """Each sketch with its number of paragraphs, in base 64."""
        out = []
        for i, n in enumerate(sizes):
            cells = slice(self.start[i], self.start[i + 1])
            plain = np.array([n], "<u4").tobytes() + self.count[cells].astype("<u4").tobytes() + self.keys[cells].astype("<u8").tobytes() + self.checks[cells].astype("<u8").tobytes()
            out.append(base64.b64encode(plain).decode())
        return out


def sketched(items: Items) -> Sketches:
    return Sketches(np.full(len(items.sizes), FIRST)).add(items.values, items.owner, 1)


def differences(a: Items, b: Items, first: Sketches | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of all that differs between the i-th texts of a and of b; sign 1: only a has it, -1: only b.

    first: their sketches of FIRST cells, subtracted. Pairs that don't peel are
    tried again with larger sketches.
    """
    most = np.maximum(FIRST, 2 * (a.sizes + b.sizes) // PARTS * PARTS)
    left, cells, sketch, turn, out = np.arange(len(a.sizes)), np.full(len(a.sizes), FIRST), first, 0, []
    while len(left):
        mine, theirs = a.take(left), b.take(left)
        if sketch is None:
            sketch = Sketches(cells[left], turn).add(mine.values, mine.owner, 1).add(theirs.values, theirs.owner, -1)
        owner, values, signs, done = sketch.peel()
        kept = done[owner]
        out.append((left[owner[kept]], values[kept], signs[kept]))
        cells = np.where(cells < most, np.minimum(cells * GROW, most), cells * 2)
        left, sketch, turn = left[~done], None, turn + 1
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64))


def likenesses(a: Items, b: Items, first: Sketches | None = None) -> np.ndarray:
    d, total = np.bincount(differences(a, b, first)[0], minlength=len(a.sizes)), a.sizes + b.sizes
    return np.where(total > 0, np.maximum(0, total - d) / np.maximum(total + d, 1), 1.0)


def place_of(cuts: list[tuple], column: F.Column, kind) -> F.Column:
    """How many cuts are at most the column's (doc_id, hash), by cuts of cuts, so that a row meets few of them."""
    step = max(1, math.isqrt(len(cuts)))
    key = lambda c: F.struct(F.lit(c[0]).cast(kind).alias("doc_id"), F.lit(c[1]).alias("h"))
    blocks = F.array(*[F.array(*[key(c) for c in cuts[i : i + step]]) for i in range(0, len(cuts), step)])
    below = lambda found: F.size(F.filter(found, lambda c: c <= column))
    block = F.size(F.filter(blocks, lambda b: b[0] <= column))
    return F.when(block == 0, 0).otherwise((block - 1) * step + below(F.get(blocks, block - 1))).cast("int")


def with_next(docs: DataFrame, run, schema: str, part_bytes: int, per_part: int) -> DataFrame:
    """mapInArrow over documents (doc_id, text) in ascending order, each task ending with the first document of the next.

    Cuts are keys of the table, so the first document after each is known and
    sent twice: once to its own part and once, as a guest, to the part before
    (the very first one to the last part).
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes"))
    facts = keyed.agg(F.min(F.struct("doc_id", "h")).alias("first"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return docs.limit(0).select(F.lit(0).alias("_part"), F.lit(0).alias("_guest"), "doc_id", "text").mapInArrow(run, schema)
    wanted = max(spark.sparkContext.defaultParallelism, -(-facts["bytes"] // part_bytes))
    ticket = F.pmod(F.xxhash64("doc_id", "h", F.lit(5)), F.lit(1 << 30))
    sample = keyed.where(ticket < min(1.0, wanted * per_part / facts["n"]) * (1 << 30)).groupBy("doc_id", "h").agg(F.sum(F.col("bytes") + 1).alias("weight"))
    cuts = cuts_of([((r["doc_id"], r["h"]), r["weight"]) for r in sample.collect()], wanted)
    first = (facts["first"]["doc_id"], facts["first"]["h"])
    place = place_of(cuts, F.struct("doc_id", F.xxhash64("text").alias("h")), kind) if cuts else F.lit(0)
    own = docs.select(place.alias("_part"), F.lit(0).alias("_guest"), "doc_id", "text")
    after = small(spark.createDataFrame([(*key, i, 1) for i, key in enumerate([*cuts, first])], StructType([StructField("_id", kind), StructField("_h", LongType()), StructField("_part", IntegerType()), StructField("_guest", IntegerType())])))
    guests = docs.join(after, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))).select("_part", "_guest", "doc_id", "text")
    return own.unionByName(guests).repartitionById(len(cuts) + 1, F.col("_part")).sortWithinPartitions("_part", "_guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).mapInArrow(run, schema)


def cuts_of(sample: list[tuple[tuple, int]], parts: int) -> list[tuple]:
    """At most parts - 1 different keys, ascending, null ids first, that cut a sample of (key, weight) into parts of like weight."""
    ordered = sorted(sample, key=lambda x: (x[0][0] is not None, *(x[0] if x[0][0] is not None else (0, x[0][1]))))
    upto = np.cumsum([w for _, w in ordered])
    found = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts) if len(ordered) else []
    return list(dict.fromkeys(ordered[i][0] for i in found))


def fingerprint_rows(texts: list[str], after: list[str]) -> list[tuple]:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each text and the one after it."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, after, strict=True)]
    sets = [Items.of(x) for x in (texts, edited, after)]
    own, other, following = (sketched(x) for x in sets)
    near = [likenesses(sets[0], x, own.minus(y)) for x, y in ((sets[1], other), (sets[2], following))]
    hashes = [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    return list(zip(map(len, texts), hashes, own.texts(sets[0].sizes), other.texts(sets[1].sizes), near[0].tolist(), near[1].tolist(), strict=True))


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part_bytes: int = 32 << 20, per_part: int = 50, most: int = 1 << 19) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    importable(docs.sparkSession)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, None
        for batch in (few for whole in batches for few in slices(whole, "text", 1 << 22)):
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

            def made(rows: list[tuple], kinds: list = kinds) -> pa.RecordBatch:
                out = fingerprint_rows([r[1] for r in rows], [r[2] for r in rows])
                return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kinds[0])] + [pa.array([r[i] for r in out], kinds[i + 1]) for i in range(6)], names)

            rows, size = [], 0
            for p, guest, ident, whole in zip(*(batch.column(c).to_pylist() for c in ("_part", "_guest", "doc_id", "text")), strict=True):
                if p != part:
                    part, held = p, None
                if held is not None:
                    rows.append((*held, whole))
                    size += len(held[1])
                    if size > most:
                        yield made(rows)
                        rows, size = [], 0
                held = None if guest else (ident, whole)
            if rows:
                yield made(rows)

    schema = f"doc_id {dict(named.dtypes)['doc_id']}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(named, run, schema, part_bytes, per_part)
