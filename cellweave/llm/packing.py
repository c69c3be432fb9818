"""Best-fit packing of tokenized documents into sequences by exact-complement hashing.

One pass tokenizes: a document's ids and its closing id make one piece, or, when
longer than a sequence, a shorter first piece and full ones. Packing needs only
how many pieces there are of each length, so the driver plans on a histogram of
at most `size` counts, whatever the corpus holds: an index of the sums of one,
two and three lengths at hand is made once; for the longest length left it names
what fills the gap exactly, and as many copies of that combination are consumed
as its counts allow; lengths without an exact filling are then packed best-fit,
the longest piece that still fits first. Each step exhausts a length or a way to
fill it, so a plan has a few thousand entries at any scale.

Pieces get their place by number: a piece's rank among those of its length is
the count of earlier partitions (a window over one row for each partition and
length) plus its position in its own partition, which the tokenizing pass wrote
down. The written pieces are what later steps read, so a lost executor changes
nothing.

Defined cases: null or empty text is the closing id alone, one piece of length
1; texts of any length are cut into as many pieces as they need; repeated rows
are documents of their own; null doc_ids stay null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import importable, store
from .text import slices

END_OF_TEXT = "<|endoftext|>"


class ByteBPE:
    """Encodes as the byte-level BPE file of the `tokenizers` library does, by the faster `tiktoken`.

    The vocabulary, the ids of merges and the special token come from the file;
    tests hold the ids against the `tokenizers` library. Texts that the faster
    library can't take (runs of a kind too long for its pattern matcher) go
    through `tokenizers` itself.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", []) if x.get("special")}
        # byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def encode(self, text: str) -> list[int]:
        try:
            if any(x in text for x in self.special):
                return self.fast.encode(text, allowed_special="all", disallowed_special=())
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the library's panic isn't an Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return self.slow.encode(text, add_special_tokens=False).ids


_coders: dict[str, ByteBPE] = {}


def coder(path: str) -> ByteBPE:
    if path not in _coders:
        _coders[path] = ByteBPE(path)
    return _coders[path]


def tokenize(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 0, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth[, ids]): nth counts the pieces of a length within a partition."""
    importable(docs.sparkSession)
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, seen = coder(tokenizer), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 22)):
            rows, columns, all_ids = [], [[] for _ in fields], []
            for row, value in enumerate(batch.column("text")):
                ids = np.asarray([*bpe.encode(value.as_py() or ""), end], "<u4")
                head = len(ids) % size if len(ids) > size else len(ids)
                cuts = [0, *([head] if head else []), *range(head + size, len(ids) + 1, size)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row)
                    for column, v in zip(columns, (piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]), strict=True):
                        column.append(v)
                    seen[b - a] += 1
                    if keep_ids:
                        all_ids.append(ids[a:b].astype(np.int64))
            out = [batch.column("doc_id").take(pa.array(rows, pa.int64()))] + [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
            names = ["doc_id", *(n for n, _ in fields)]
            if keep_ids:
                out.append(pa.array([x.tolist() for x in all_ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    kind = dict(docs.select(F.col(doc_id).alias("doc_id")).dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


class SumIndex:
    """For every sum a single, a pair and a triple of lengths at hand that make it.

    Built once from the counts. A pair is kept by its shorter part, a triple by
    its longest. Counts only fall, so an entry whose parts have run out is moved
    on to the next one and never back; a sum without one stays without.
    """

    def __init__(self, left: np.ndarray) -> None:
        self.left, size = left, len(left) - 1
        lengths = np.flatnonzero(left)
        self.short, self.first = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        for low in lengths:
            sums = low + lengths[np.searchsorted(lengths, low) :]
            sums = sums[sums <= size]
            self.short[sums] = np.where(self.short[sums], self.short[sums], low)
        pairs = np.flatnonzero(self.short)
        for first in lengths[::-1]:
            sums = first + pairs[: np.searchsorted(pairs, size - first, "right")]
            self.first[sums] = np.where(self.first[sums], self.first[sums], first)

    def single(self, total: int, held: Sequence[int]) -> list[int] | None:
        return [total] if self.left[total] > held.count(total) else None

    def pair(self, total: int, held: Sequence[int]) -> list[int] | None:
        """The pair of this sum whose longer part is longest, besides the lengths held."""
        low = int(self.short[total])
        if not low:
            return None
        free = self.left.copy()
        np.subtract.at(free, list(held), 1)
        fits = lambda counts, a: (counts[a] > 0) & (counts[total - a] > (2 * a == total))
        if fits(free, low):
            return [total - low, low]
        lows = np.arange(low, total // 2 + 1)
        ever = lows[fits(self.left, lows)]
        self.short[total] = ever[0] if len(ever) else 0
        now = ever[fits(free, ever)]
        return [int(total - now[0]), int(now[0])] if len(now) else None

    def triple(self, total: int, held: Sequence[int]) -> list[int] | None:
        """The triple of this sum whose longest part is longest, besides the lengths held."""
        moved = True
        for first in np.flatnonzero(self.left[: self.first[total] + 1])[::-1]:
            if self.left[first] > held.count(first) and (rest := self.pair(total - first, [*held, int(first)])):
                return [int(first), *rest]
            # a length that is only held may be free again for another sum's sake
            moved = moved and not (held.count(first) or self.short[total - first])
            if moved:
                self.first[total] = first - 1
        return None


class Plan:
    """Entries (times, lengths): so many sequences hold pieces of these lengths, longest first."""

    def __init__(self, counts: dict[int, int], size: int) -> None:
        self.size, self.left = size, np.zeros(size + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.entries: list[tuple[int, list[int]]] = []
        self._exact()
        self._best_fit()

    def _take(self, lengths: list[int]) -> None:
        """As many sequences of these lengths as the counts allow."""
        kinds, need = np.unique(lengths, return_counts=True)
        times = int((self.left[kinds] // need).min())
        self.left[kinds] -= times * need
        self.entries.append((times, lengths))

    def _exact(self) -> None:
        """Longest first: its gap is looked up among the sums, and what fills it is consumed as often as the counts allow."""
        sums = SumIndex(self.left)
        for longest in range(self.size, 0, -1):
            gap = self.size - longest
            while self.left[longest]:
                found = [] if not gap else sums.single(gap, [longest]) or sums.pair(gap, [longest]) or sums.triple(gap, [longest])
                if found is None:
                    break
                self._take([longest, *found])

    def _best_fit(self) -> None:
        while self.left.any():
            free, lengths, left = self.size, [], self.left.copy()
            while free and (fitting := np.flatnonzero(left[: free + 1])).size:
                length = int(fitting[-1])
                times = int(min(left[length], free // length))
                lengths += [length] * times
                left[length] -= times
                free -= length * times
            self._take(lengths)

    def slots(self) -> dict[str, np.ndarray]:
        """Runs of ranks of a length: rank r in [first, first + times) lies in sequence base + r - first at `offset`."""
        used = np.zeros(self.size + 1, np.int64)
        rows, base = [], 0
        for times, lengths in self.entries:
            offset = 0
            for length in lengths:
                rows.append((length, used[length], base, offset))
                used[length] += times
                offset += length
            base += times
        rows.sort()
        return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "first", "base", "offset"))}


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to written pieces of tokenize()."""
    counts = store(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    slots = Plan(histogram, size).slots()
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"), before.alias("_before"))
    ranked = pieces.join(offsets, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).withColumn("_rank", F.col("nth") + F.col("_before")).drop("_part", "_length", "_before")
    keys = slots["length"] * (1 << 44) + slots["first"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(keys, length * (1 << 44) + rank, "right") - 1
            sequence = slots["base"][at] + rank - slots["first"][at]
            kept = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(sequence), pa.array(slots["offset"][at])], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 0, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for all pieces of all documents."""
    pieces = store(tokenize(docs, tokenizer, size, end, doc_id, text, keep_ids), "pieces")
    return pack(pieces, size).drop("part", "nth")
