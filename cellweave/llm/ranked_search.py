"""Ranked lexical search by inverted treaps.

Every document is scored for every item: the sum, over the item's terms, of
w * (1e9 * tf div (1000 * tf + 8 * m)), all in 64-bit integers. A term's postings
of a block of documents form a treap: doc_id order in the tree's order, impact
order from the root down (equal impacts in a scrambled order, so that trees stay
shallow). An item walks the treaps of its terms together: a state is an interval
of documents with the root of each term's postings there, so the sum of the
roots' impacts is an upper bound for all of its documents. The state of the
largest bound is split at the document of its heaviest root, which is scored;
states whose bound cannot enter the item's best are dropped. Numpy walks many
states of an item at once.

1. Texts are read once: a row (doc_id, n, terms, tfs) for each document, with the
   postings of the items' terms, is stored. Other terms can't add to any score,
   they only count in n.
2. N, L and df are counted over all rows.
3. Blocks of documents are searched where they lie: nothing is shuffled but each
   block's best. A sixteenth of the documents, by a checksum of the text, goes
   first; the k-th best score found there is a floor for the rest, so that a
   block returns hardly more than what enters the result.

Bounds: items meet the documents in groups of about `GROUP_TERMS` (item, term)
pairs, which are what tasks are sent; a block has up to `BLOCK_POSTINGS`
postings, and one document more.

Defined cases: null and empty texts have no terms, are never found and count in
no statistic; an item without terms has no rows; repeated rows of an item
(item_id, text) are one item, an item_id with several texts is several items,
each with ranks of its own; null item_ids likewise; repeated rows of a document
and repeated doc_ids are documents of their own; equal scores go by ascending
doc_id, null last; texts of any length count whole, in pieces of 1 MB; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh_path, importable, store

TERM, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")  # of lower-cased UTF-8
PIECE = 1 << 20
GROUP_TERMS = 500_000
BLOCK_POSTINGS = 2_000_000
LEAD = 16
STATES, POOL = 4096, 1 << 24


def counted(text: str | None) -> Counter:
    """Occurrences of each term, as lower-cased bytes; bytes.lower changes A-Z only."""
    data, found, at = (text or "").encode().lower(), Counter(), 0
    while at < len(data):
        gap = GAP.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        found.update(TERM.findall(data, at, end))
        at = end
    return found


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms, size) of each distinct item that has terms."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(counted(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary())), pa.array(map(len, terms), pa.int64())], ["item_id", "terms", "size"])

    return rows.mapInArrow(run, f"item_id {kind}, terms array<binary>, size long").where("size > 0")


def postings(docs: DataFrame, terms: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs, lead), stored: the counts of the given terms, as places in the list, for each document that has a term at all."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})  # of one group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            for a in range(0, len(batch), 256):
                some = batch.slice(a, 256)
                kept, n, ids, tfs, lead = [], [], [], [], []
                for i, t in enumerate(some.column("text").to_pylist()):
                    counts = counted(t)
                    if counts:
                        known = counts.keys() & number.keys()
                        kept.append(i)
                        n.append(counts.total())
                        ids.append([number[x] for x in known])
                        tfs.append([counts[x] for x in known])
                        lead.append(int(zlib.crc32(t.encode()) % LEAD == 0))
                yield pa.RecordBatch.from_arrays([some.column("doc_id").take(pa.array(kept, pa.int32())), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64())), pa.array(lead, pa.int32())], ["doc_id", "n", "terms", "tfs", "lead"])

    path = fresh_path(docs.sparkSession, "postings")
    made = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tfs array<long>, lead int")
    made.write.partitionBy("lead").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


class Treaps:
    """The postings of a block of documents as one treap a term; documents are places in ascending doc_id order."""

    def __init__(self, owner: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray) -> None:
        order = np.lexsort((owner, terms))
        self.doc, term, tf = owner[order].astype(np.int64), terms[order], tfs[order]
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        self.docs, nil = len(m), len(order)
        self.left, self.right, self.root = np.full(nil + 1, nil, np.int64), np.full(nil + 1, nil, np.int64), {}
        cuts = np.flatnonzero(np.diff(term)) + 1 if nil else np.zeros(0, np.int64)
        scrambled = (self.doc * 0x9E3779B1) & 0xFFFFF
        for a, b in zip([0, *cuts], [*cuts, nil], strict=True):
            if b > a:
                self.root[int(term[a])] = self._grow(int(a), ((impact[a:b] << 20) | scrambled[a:b]).tolist())
        self.doc, self.impact = np.append(self.doc, -1), np.append(impact, 0)

    def _grow(self, base: int, heat: list[int]) -> int:
        """The tree over one term's postings whose heat falls from the root down; its root."""
        nil, spine = len(self.left) - 1, []  # the spine is the path to the last posting
        left, right = [nil] * len(heat), [nil] * len(heat)
        for i, h in enumerate(heat):
            below = nil
            while spine and heat[spine[-1]] < h:
                below = spine.pop() + base
            left[i] = below
            if spine:
                right[spine[-1]] = i + base
            spine.append(i)
        self.left[base : base + len(heat)], self.right[base : base + len(heat)] = left, right
        return spine[0] + base

    def split(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For roots x of documents in (lo, hi), one line a state: the roots in (lo, d) and (d, hi), and the posting of d or none."""
        shape, nil = x.shape, len(self.left) - 1
        lows, highs, ds = (np.repeat(v, shape[1]) for v in (lo, hi, d))
        at = np.flatnonzero(x.ravel() != nil)
        v, before, after, hit = x.ravel()[at], np.full(x.size, nil), np.full(x.size, nil), np.full(x.size, nil)
        while len(at):
            dv = self.doc[v]
            less, more = dv < ds[at], dv > ds[at]
            some = less & (dv > lows[at]) & (before[at] == nil)
            before[at[some]] = v[some]
            some = more & (dv < highs[at]) & (after[at] == nil)
            after[at[some]] = v[some]
            same = ~(less | more)
            hit[at[same]] = v[same]
            v = np.where(less, self.right[v], np.where(more, self.left[v], nil))
            on = v != nil
            at, v = at[on], v[on]
        met = np.flatnonzero(hit != nil)
        for out, child, other, beyond in ((before, self.left, self.right, lambda v, i: self.doc[v] <= lows[i]), (after, self.right, self.left, lambda v, i: self.doc[v] >= highs[i])):
            at = met[out[met] == nil]
            v = child[hit[at]]
            while True:  # what lies beyond the interval is passed on the way down
                out[at] = v
                on = (v != nil) & beyond(v, at)
                at, v = at[on], other[v[on]]
                if not len(at):
                    break
        return before.reshape(shape), after.reshape(shape), hit.reshape(shape)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the k best with a score of at least `floor`, best first, ties to the earlier document."""
        held = [i for i, t in enumerate(terms.tolist()) if t in self.root and weights[i] > 0]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not held:
            return docs, scores
        w = weights[held]
        x, lo, hi = np.array([[self.root[int(terms[i])] for i in held]]), np.array([-1]), np.array([self.docs])
        bound, take = (w * self.impact[x]).sum(1), 16
        while len(bound):
            if x.size > POOL:  # then the latest, which are the smallest
                chosen = np.arange(max(0, len(bound) - take), len(bound))
            else:
                chosen = np.argpartition(-bound, take - 1)[:take] if take < len(bound) else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[chosen] = False
            heavy = (w * self.impact[x[chosen]]).argmax(1)
            d = self.doc[x[chosen, heavy]]
            before, after, hit = self.split(x[chosen], lo[chosen], hi[chosen], d)
            score = (w * self.impact[hit]).sum(1)
            docs, scores = np.append(docs, d[score >= floor]), np.append(scores, score[score >= floor])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(scores) == k:
                floor = max(floor, int(scores[-1]))
            x, lo, hi = np.concatenate([x[rest], before, after]), np.concatenate([lo[rest], lo[chosen], d]), np.concatenate([hi[rest], d, hi[chosen]])
            bound = np.concatenate([bound[rest], (w * self.impact[before]).sum(1), (w * self.impact[after]).sum(1)])
            on = bound >= floor
            x, lo, hi, bound = x[on], lo[on], hi[on], bound[on]
            take = max(1, min(2 * take, STATES, POOL // max(1, 4 * len(held))))
        return docs, scores


def search_blocks(rows: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int, floors: dict[int, int]) -> DataFrame:
    """(item, doc_id, score): for each block of rows the best documents of each item; items: (number, terms, weights)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast((items, floors))  # of one group

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BLOCK_POSTINGS - size, "right")))
                held.append(batch.slice(at, end - at))
                size += int(sizes[end - 1] - (sizes[at - 1] if at else 0))
                at = end
                if size >= BLOCK_POSTINGS or at < len(batch):
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, least = shared.value
        for block in blocks(batches):
            block = block.take(pc.sort_indices(block, [("doc_id", "ascending")])).combine_chunks()
            terms, tfs, n = block.column("terms").combine_chunks(), block.column("tfs").combine_chunks(), block.column("n").to_numpy()
            owner = np.repeat(np.arange(len(block)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
            treaps = Treaps(owner, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), 10 + (90 * n * n_docs) // n_terms)
            found = [(i, *treaps.best(t, w, k, least.get(i, 1))) for i, t, w in wanted]
            docs = np.concatenate([d for _, d, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([i for i, _, _ in found], [len(d) for _, d, _ in found]), pa.int32()), pa.array(block.column("doc_id").combine_chunks().take(pa.array(docs))), pa.array(np.concatenate([s for _, _, s in found]), pa.int64())], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, f"item int, doc_id {kind}, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    importable(spark)
    asked = store(item_terms(items, item_id, item_text), "items")
    groups = asked.agg(F.coalesce(F.ceil(F.sum("size") / GROUP_TERMS), F.lit(0))).first()[0]
    kinds = asked.schema["item_id"].dataType.simpleString(), docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    for group in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(groups)) == group).collect()  # about GROUP_TERMS terms
        if not rows:
            continue
        terms = sorted({bytes(t) for r in rows for t in r["terms"]})
        kept = postings(docs, terms, doc_id, text)
        n_docs, n_terms = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r["t"]: r["df"] for r in kept.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}  # a row for each term of the group
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        place = {t: i for i, t in enumerate(terms)}
        wanted = []
        for i, r in enumerate(rows):
            ids = np.array([p for t in r["terms"] if (p := place[bytes(t)]) in weight], np.int64)
            wanted.append((i, ids, np.array([weight[p] for p in ids.tolist()], np.int64)))
        first = store(ranked(search_blocks(kept.where("lead = 1").drop("lead"), wanted, n_docs, n_terms, k, {}), k).drop("rank"), "found")
        floors = {r["item"]: r["least"] for r in first.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("c")).where(F.col("c") == k).collect()}  # a row for each item of the group
        found = ranked(first.unionByName(search_blocks(kept.where("lead = 0").drop("lead"), wanted, n_docs, n_terms, k, floors)), k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kinds[0]}")
        out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
