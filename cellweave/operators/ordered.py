"""Running sums and exact quantiles over a whole table without one task that sees all of it.

Running sums deal rows to buckets between approximate quantiles of the order, so
that an outlier doesn't put the rest into one; a window runs within each bucket
and starts from the sum of the buckets before it, of which there are at most
`buckets` for each key. Exact quantiles come from two narrow passes: brackets
from approximate quantiles, then counts below them with the few values inside.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


TOGETHER = 7  # quantiles of one pass: the code of many more is too long to be compiled


def _bucket(value: Column, blocks: str) -> Column:
    """How many edges are at most the value, by the first edge of each block, so that a row meets few of them."""
    block = F.size(F.filter(blocks, lambda b: F.get(b, F.lit(0)) <= value))
    inside = F.size(F.filter(F.get(blocks, block - 1), lambda e: e <= value))
    return F.when(block > 0, F.aggregate(F.slice(blocks, F.lit(1), block - 1), F.lit(0), lambda n, b: n + F.size(b)) + inside).otherwise(0)


def running(df: DataFrame, order: str, sums: dict[str, str], keys: Sequence[str] = (), descending: bool = False, buckets: int = 256) -> DataFrame:
    """Adds for each name in sums the sum of its column up to and with the row, by `order` within keys; `order` is known, and unique within keys."""
    o, step = F.col(order).cast("double"), max(1, round(buckets**0.5))
    edges = df.groupBy(*keys).agg(F.percentile_approx(o, [i / buckets for i in range(1, buckets)], 20 * buckets).alias("_e"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit((buckets - 2) // step)), lambda i: F.slice("_e", i * step + 1, F.lit(step)))
    ends = edges.select(*keys, blocks.alias("_blocks"))
    ranged = df.join(ends, list(keys)) if keys else df.crossJoin(F.broadcast(ends))  # without keys one row
    dealt = ranged.withColumn("_b", F.coalesce(_bucket(o, "_blocks"), F.lit(0))).drop("_blocks")
    way = F.desc if descending else F.asc
    by_bucket = W.partitionBy(*keys).orderBy(way("_b"))
    totals = dealt.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    before = totals.select(*keys, "_b", *[(F.sum(f"_s_{n}").over(by_bucket) - F.col(f"_s_{n}")).alias(f"_before_{n}") for n in sums])
    within = W.partitionBy(*keys, "_b").orderBy(way(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = dealt.join(before, [*keys, "_b"])
    return joined.select(*df.columns, *[(F.col(f"_before_{n}") + F.sum(c).over(within)).alias(n) for n, c in sums.items()])


def quantiles(values: DataFrame, wanted: Sequence[float], keys: Sequence[str] = ("name",), value: str = "value", accuracy: int = 10_000) -> DataFrame:
    """(keys, q, value): exact quantiles, linear between neighbouring ranks, of long rows (keys, value); missing values are left out.

    keys name columns of a table, so they take few values. An approximate
    quantile is off by at most 1 / accuracy of the ranks; each wanted rank lies
    between those of twice that distance on both sides, and groups of at most
    4 * accuracy rows are their own bracket. Of a group only what lies in the
    brackets, some 4 / accuracy of its rows for each quantile, is shuffled and ranked.
    """
    wanted = sorted(set(wanted))
    if len(wanted) > TOGETHER:
        parts = [quantiles(values, wanted[i : i + TOGETHER], keys, value, accuracy) for i in range(0, len(wanted), TOGETHER)]
        return reduce(DataFrame.unionByName, parts)
    v, near = F.col(value).cast("double"), 2 / accuracy
    known = values.where(F.col(value).isNotNull() & ~F.isnan(v))
    spots = sorted({min(1.0, max(0.0, q + d)) for q in wanted for d in (-near, near)})
    facts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.min(v).alias("_min"), F.max(v).alias("_max"), F.percentile_approx(v, spots, accuracy).alias("_p"))
    exact = F.col("_all") <= 4 * accuracy
    edge = lambda q, end: F.when(exact | F.lit(not 0 < q < 1), F.col(end)).otherwise(F.get("_p", F.lit(spots.index(min(1.0, max(0.0, q))))))
    ends = [(f"_low{i}", f"_high{i}") for i in range(len(wanted))]
    brackets = [edge(q + d, end).alias(name) for q, names in zip(wanted, ends, strict=True) for d, end, name in ((-near, "_min", names[0]), (near, "_max", names[1]))]
    facts = F.broadcast(facts.select(*keys, "_all", *brackets))  # a row for each column of a table
    met = lambda df: df.join(facts, list(keys)) if keys else df.crossJoin(facts)
    # one pass more: each row tells how many brackets begin at or below it, and its value if it lies in one; sums leave few rows of it
    begun = sum((F.when(F.col("_v") >= F.col(low), 1).otherwise(0) for low, _ in ends), F.lit(0))
    lies = [F.col("_v").between(F.col(low), F.col(high)) for low, high in ends]
    at = lambda i, kept: F.struct(i.cast("int").alias("at"), (F.col("_v") if kept else F.lit(None).cast("double")).alias("_v"))
    entries = F.when(reduce(lambda x, y: x | y, lies), F.array(at(begun, False), *[F.when(c, at(F.lit(i), True)) for i, c in enumerate(lies)])).otherwise(F.array(at(begun, False)))
    told = met(known.select(*keys, v.alias("_v"))).select(*keys, "_all", F.explode(entries).alias("_s")).where("_s is not null")
    sums = told.groupBy(*keys, "_all", F.col("_s.at").alias("_at"), F.col("_s._v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # a value without a bracket's name lies below all brackets that have not begun there
    spread = F.when(F.col("_v").isNotNull(), F.array("_at")).when(F.col("_at") < len(wanted), F.sequence("_at", F.lit(len(wanted) - 1)))
    each = sums.select(*keys, "_all", F.explode(spread).alias("_at"), "_v", "_n").groupBy(*keys, "_all", "_at", "_v").agg(F.sum("_n").alias("_n"))
    sums = each.withColumn("q", F.get(F.array(*[F.lit(float(q)) for q in wanted]), F.col("_at")))
    # those below come first, as null
    upto = F.sum("_n").over(W.partitionBy(*keys, "q").orderBy(F.asc_nulls_first("_v")).rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = sums.withColumn("_upto", upto).where("_v is not null")
    spot = F.col("q") * (F.col("_all") - 1)
    holding = lambda k: (k < F.col("_upto")) & (k >= F.col("_upto") - F.col("_n"))
    low, high = F.max(F.when(holding(F.floor(spot)), F.col("_v"))), F.max(F.when(holding(F.ceil(spot)), F.col("_v")))
    return ranked.groupBy(*keys, "q").agg((low + (high - low) * F.max(spot - F.floor(spot))).alias(value))
