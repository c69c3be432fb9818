"""Mixing sources to target weights by entropy balancing.

Native: DataFrame and SQL functions only. Every document has a rate between 0
and `most` copies. Of all rates whose words meet each source's target, the ones
of largest entropy -sum(r log r + (most - r) log(most - r)) are exponentially
tilted: r = most * e / (1 + e), e = exp(l_s * size / scale_s). The convex dual
has one variable l_s for each source and is solved by safeguarded Newton steps;
all documents of one source and size share a rate, so each step runs over the
(source, size) histogram, which is built once with map-side sums. Rates become
whole copies by systematic rounding along sizes, so a source's taken words are
within about one document of its target, and which documents of a cell get the
extra copy is set by a hash of doc_id: reruns agree.

Defined cases: null text has size 0, and takes 0; a null source is a source of
its own, the last; repeated rows are documents of their own; null doc_ids are
hashed as such; an empty table, or one of empty texts, gives targets of 0;
other columns are ignored. A target of at least `most` times a source takes
every document `most` times.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, small, store

WORDS = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size): size is the number of words."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) for (source, source_size).

    Sources by code point, null last, have the weights in turn and share `share`
    times all sizes; a target stops at `most` times its source's size and the
    excess goes to the others by weight. Filled like water: in order of cap /
    weight, the level is what is left over the weights left, and the sources
    whose cap lies below the level at their turn are full.
    """
    everything = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(everything) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sources.select("source", "source_size", weight.alias("_w")).withColumn("_cap", F.col("source_size") * float(most))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    all_rows = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = float(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weights_left = F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing))
    t = t.withColumn("_level", left / weights_left)
    t = t.withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(W.partitionBy())
    return t.withColumn("_level", level["_level"]).select("source", "source_size", F.when(F.col("_full") | F.col("_level").isNull(), F.col("_cap")).otherwise(F.col("_level") * F.col("_w")).alias("target"))


def balance(cells: DataFrame, most: float, miss_share: float = 1e-7) -> DataFrame:
    """(source_no, size, n, target, rate) for cells (source_no, size, n, target, source_size): Newton steps on the dual.

    The step of source s is (target - words(l)) / slope(l), kept inside a bracket
    that the sign of the miss narrows; a step that leaves it is halved into it.
    Should Newton not do in 20 rounds, every other one halves the bracket, so
    rounds end: when every source's words are within `miss_share` of its size,
    or when its bracket holds no other double.
    """
    docs = F.sum("n")
    start = cells.groupBy("source_no").agg((F.sum(F.col("size") * F.col("n")) / docs).alias("scale"), F.max("target").alias("target"), F.max("source_size").alias("source_size"))
    # beyond the bracket every rate is 0 or `most` to the last bit of a double for any size of at least a thousandth of the mean
    state = start.select("source_no", "scale", "target", "source_size", F.lit(0.0).alias("l"), F.lit(-40000.0).alias("low"), F.lit(40000.0).alias("high"))
    state = store(state.where("source_size > 0"), "dual")
    for turn in itertools.count(1):
        x = F.col("size") / F.col("scale")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("l") * x))))
        at = cells.select("source_no", "size", "n").join(state, "source_no").groupBy("source_no").agg(
            F.sum(p * F.col("size") * F.col("n") * most).alias("words"), F.sum(p * (1 - p) * x * F.col("size") * F.col("n") * most).alias("slope"))
        miss = F.col("target") - F.col("words")
        low, high = F.when(miss > 0, F.col("l")).otherwise(F.col("low")), F.when(miss > 0, F.col("high")).otherwise(F.col("l"))
        moved = state.join(at, "source_no").select("source_no", "scale", "target", "source_size", "l", low.alias("low"), high.alias("high"), F.col("l").alias("_old"), miss.alias("_miss"), "slope")
        newton = F.col("_old") + F.try_divide(F.col("_miss"), F.col("slope"))
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        half = (F.col("low") + F.col("high")) / 2
        done = (F.abs(F.col("_miss")) <= F.lit(miss_share) * F.col("source_size")) | (half <= F.col("low")) | (half >= F.col("high"))
        new = store(moved.select("source_no", "scale", "target", "source_size", F.when(done, F.col("_old")).when(inside & F.lit(turn <= 20 or turn % 2 > 0), newton).otherwise(half).alias("l"), "low", "high", done.alias("done")), "dual")
        forget(state)
        state = new.select("source_no", "scale", "target", "source_size", "l", "low", "high")
        state._stored_at = new._stored_at
        if new.where(f"not done and target < source_size * {float(most)}").limit(1).count() == 0:
            break
    e = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("l") * F.col("size") / F.col("scale")))
    rate = F.when(F.col("target") >= F.col("source_size") * float(most), F.lit(float(most))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(float(most) / (1 + F.exp(-e)))
    return cells.join(state.select("source_no", "scale", "l"), "source_no", "left").select("source_no", "size", "n", "target", F.when(F.col("size") > 0, F.coalesce(rate, F.lit(0.0))).otherwise(F.lit(0.0)).alias("rate"))


def whole_copies(rated: DataFrame, most: int, repairs: int = 2) -> DataFrame:
    """(source_no, size, n, rate, _base, _extra): each document of a cell gets _base copies, _extra of them one more.

    A cell's copies are the running sum of rates along sizes, rounded; what a
    source then misses of its target is made up `repairs` times by copies more
    or less of the documents of one size: that of which as many as it has come
    nearest to the miss.
    """
    along = W.partitionBy("source_no").orderBy("size")
    upto = rated.withColumn("_upto", F.floor(F.sum(F.col("rate") * F.col("n")).over(along) + 0.5))
    made = F.col("_upto") - F.coalesce(F.lag("_upto").over(along), F.lit(0))
    cell = upto.select("source_no", "size", "n", "target", "rate", F.least(F.greatest(made, F.lit(0)), F.col("n") * most).alias("c"))
    for _ in range(repairs):
        miss = F.col("target") - F.sum(F.col("c") * F.col("size")).over(W.partitionBy("source_no"))
        room = F.when(F.col("_miss") > 0, F.col("n") * most - F.col("c")).otherwise(F.col("c"))
        step = F.least(room, F.round(F.try_divide(F.abs("_miss"), F.col("size"))).cast("long"))
        left = F.abs(F.abs("_miss") - F.col("_step") * F.col("size"))
        near = F.min(F.when((F.col("size") > 0) & (F.col("_step") > 0), F.struct(left, "size"))).over(W.partitionBy("source_no"))
        cell = cell.withColumn("_miss", miss).withColumn("_step", step).withColumn("_near", near["size"])
        moved = F.col("c") + F.signum("_miss").cast("long") * F.col("_step")
        cell = cell.select("source_no", "size", "n", "target", "rate", F.when(F.col("size") == F.col("_near"), moved).otherwise(F.col("c")).alias("c"))
    base = F.floor(F.col("c") / F.col("n"))
    return cell.select("source_no", "size", "n", "rate", base.alias("_base"), (F.col("c") - base * F.col("n")).alias("_extra"))


def _spot(doc_id: Column) -> Column:
    """A fixed shuffle of the documents of a cell."""
    return F.xxhash64(F.lit(9), doc_id)


def _block(spot: Column, n: Column, rank_block: int) -> Column:
    return F.pmod(F.shiftrightunsigned(spot, 20), F.floor(n / rank_block) + 1)


def _planned(sizes: DataFrame, weights: Sequence[float], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """(source_no, source, source_size, target) of the sources and the cells of whole_copies(), both stored."""
    counts = store(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    numbered = store(targets(by_source, weights, share, most).withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))), "targets")
    cells = store(counts.join(numbered, counts["source"].eqNullSafe(numbered["source"])).select("source_no", "size", "n", "source_size", "target"), "cells")
    rated = store(balance(cells, most), "rates")
    cell = store(whole_copies(rated, most), "copies")
    forget(counts, cells, rated)
    return numbered, cell


def _ranked(sizes: DataFrame, numbered: DataFrame, cell: DataFrame, rank_block: int) -> DataFrame:
    """The documents with their place in their block and how many of it get one copy more.

    Cells are cut into blocks by hash; a block's part of the extra copies follows from the blocks before it.
    """
    named = numbered.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    each = sizes.join(named, sizes["source"].eqNullSafe(F.col("_source"))).drop("_source")
    each = each.join(cell, ["source_no", "size"])
    each = each.withColumn("_key", _spot(F.col("doc_id"))).withColumn("_block", _block(F.col("_key"), F.col("n"), rank_block))
    blocks = each.groupBy("source_no", "size", "_block").agg(F.count(F.lit(1)).alias("_m"), F.max("n").alias("_n"), F.max("_extra").alias("_all"))
    run = F.sum("_m").over(W.partitionBy("source_no", "size").orderBy("_block"))
    upto = lambda c: F.floor(c * F.col("_all") / F.col("_n"))
    blocks = store(blocks.select("source_no", "size", "_block", (upto(run) - upto(run - F.col("_m"))).alias("_here")), "blocks")
    place = F.row_number().over(W.partitionBy("source_no", "size", "_block").orderBy("_key", F.col("doc_id").asc_nulls_first()))
    return each.join(blocks, ["source_no", "size", "_block"]).withColumn("_place", place)


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, doc_id: str = "doc_id", text: str = "text", source: str = "source", rank_block: int = 4096) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) for each document."""
    sizes = store(sized(docs, doc_id, text, source), "sizes")
    numbered, cell = _planned(sizes, weights, share, most)
    chosen = _ranked(sizes, numbered, cell, rank_block).withColumn("copies", (F.col("_base") + (F.col("_place") <= F.col("_here")).cast("long")).cast("long"))
    return chosen.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, key: Column, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, text: str = "text", source: str = "source", rank_block: int = 4096, rules: int = 200_000) -> DataFrame:
    """The rows of docs, all columns, each as often as mix() takes it; key tells documents apart.

    What a document gets depends on its source, size and key: up to the last key
    of its block that gets one copy more. Sources, cells and blocks are few rows
    beside the documents, so while they are at most `rules` they are broadcast
    and no text is shuffled; beyond that the texts meet them in a shuffle. Rows
    of one key in a cell all get what the last of them gets.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(key.alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"), row)
    sizes = store(sized(keyed), "sizes")
    numbered, cell = _planned(sizes, weights, share, most)
    taken = F.when(F.col("_place") <= F.col("_here"), F.struct("_key", "doc_id"))
    lasts = store(_ranked(sizes, numbered, cell, rank_block).groupBy("source_no", "size", "_block").agg(F.max(taken).alias("_last")).where("_last is not null"), "lasts")
    forget(sizes)
    each = keyed.select("row", F.col("doc_id"), F.col("source").alias("_source"), size_of(F.col("text")).alias("size"))
    named = small(numbered.select("source", "source_no"), rules)
    each = each.join(named, each["_source"].eqNullSafe(named["source"])).drop("_source", "source")
    each = each.join(small(cell.select("source_no", "size", "n", "_base"), rules), ["source_no", "size"]).withColumn("_block", _block(_spot(F.col("doc_id")), F.col("n"), rank_block))
    each = each.join(small(lasts, rules), ["source_no", "size", "_block"], "left")
    more = F.col("_last").isNotNull() & (F.struct(_spot(F.col("doc_id")).alias("_key"), "doc_id") <= F.col("_last"))
    copies = (F.col("_base") + more.cast("long")).cast("int")
    return each.select("row", copies.alias("copies")).where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
