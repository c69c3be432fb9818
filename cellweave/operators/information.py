"""Mutual information of a number and a class by nearest neighbours, and folds balanced by class counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cuts import cut
from .ordered import running

BLOCK = 4096
INSIDE = 1 - 1e-9  # of a radius, so that the row it is measured to lies outside


def digamma(x: Column) -> Column:
    """The logarithmic derivative of the gamma function for x >= 1, to 1e-10: moved up by six, then its series."""
    y = x + 6.0
    z = 1.0 / (y * y)
    series = F.ln(y) - 0.5 / y - z * (1 / 12.0 - z * (1 / 120.0 - z * (1 / 252.0 - z / 240.0)))
    return series - sum((1.0 / (x + float(i)) for i in range(6)), F.lit(0.0))


def radii(counts: DataFrame, k: int) -> DataFrame:
    """(kind, value, n, of, r): how far the k-th nearest other row of the same kind is, for each distinct value with n rows; of: the kind's rows.

    A kind of k rows or fewer takes all its others; with one row it has none and
    is left out. Values of a kind are numbered in order and cut into blocks with
    k values of the neighbours on either side, so a window sees a block.
    """
    sizes = counts.groupBy("kind").agg(F.sum("n").alias("of"))
    numbered = running(counts.withColumn("_one", F.lit(1)), "value", {"_at": "_one"}, ["kind"])
    home = F.floor((F.col("_at") - 1) / BLOCK)
    blocks = F.array_distinct(F.array(home, F.floor((F.col("_at") - 1 - k) / BLOCK), F.floor((F.col("_at") - 1 + k) / BLOCK)))
    dealt = numbered.select("kind", "value", "n", home.alias("_home"), F.explode(blocks).alias("_block")).where("_block >= 0")
    near = W.partitionBy("kind", "_block").orderBy("value").rowsBetween(-k, k)
    seen = dealt.withColumn("_near", F.collect_list(F.struct("value", "n")).over(near)).where(F.col("_block") == F.col("_home")).join(sizes.where("of > 1"), "kind")
    # of the distinct distances in order the first whose rows, the row itself left out, are k
    away = F.array_sort(F.transform("_near", lambda s: F.struct(F.abs(s["value"] - F.col("value")).alias("d"), s["n"].alias("n"))))
    wanted = F.least(F.lit(k), F.col("of") - 1) + 1
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("r"))
    found = F.aggregate(away, start, lambda a, s: F.struct((a["n"] + s["n"]).alias("n"), F.when(a["n"] < wanted, s["d"]).otherwise(a["r"]).alias("r")))
    return seen.select("kind", "value", "n", "of", found["r"].alias("r"))


def information(df: DataFrame, value: str, kind: str, k: int = 3) -> DataFrame:
    """(information): psi(N) + mean psi(k) - mean psi(rows of the kind) - mean psi(rows within the radius), in nats, 0 at least.

    A row's radius is the distance to its k-th nearest row of the same kind in
    the value; rows of any kind within a billionth less than that lie within it,
    and rows of the same value. Rows of one value are counted together. Ranges of rows and counts
    below a value both come from running sums by buckets, so nothing is compared
    with everything. Rows without value or kind, with NaN, and kinds of one row
    take no part; without any row the result is null.
    """
    known = df.select(F.col(value).cast("double").alias("value"), F.col(kind).alias("kind")).where("value is not null and not isnan(value) and kind is not null")
    counts = cut(known.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")))
    rows = cut(radii(counts, k))
    low, high = F.col("value") - F.col("r") * INSIDE, F.col("value") + F.col("r") * INSIDE
    asks = rows.select(F.explode(F.array(low, high)).alias("at"), F.lit(0).cast("long").alias("n"))
    counted = asks.unionByName(rows.select(F.col("value").alias("at"), "n")).groupBy("at").agg(F.sum("n").alias("n"))
    below = cut(running(counted, "at", {"upto": "n"}).select("at", "upto", (F.col("upto") - F.col("n")).alias("under")))
    at_high, at_low = below.select(F.col("at").alias("_high"), "upto"), below.select(F.col("at").alias("_low"), "under")
    met = rows.withColumn("_high", high).withColumn("_low", low).join(at_high, "_high").join(at_low, "_low")
    within = F.col("upto") - F.col("under")
    psi = lambda c: F.sum(F.col("n") * digamma(c.cast("double")))
    total = F.sum("n")
    result = digamma(total.cast("double")) + (psi(F.least(F.lit(k), F.col("of") - 1)) - psi(F.col("of")) - psi(within)) / total
    return met.agg(F.when(total > 0, F.greatest(result, F.lit(0.0))).alias("information"))


def spread(counts: np.ndarray) -> float:
    """Mean over classes of the deviation of the folds' shares; counts: (folds, classes)."""
    return float((counts / np.maximum(counts.sum(0), 1)).std(0).mean())


def balanced_folds(groups: DataFrame, key: str, counts: str, k: int, shard: int = 4096) -> DataFrame:
    """(key, fold): whole groups in k folds with nearly the same class counts each; counts: an array of a group's rows of each class.

    Groups whose classes are most uneven go first, each into the fold that then
    has the least spread of class shares, ties to the fold of fewer rows. More
    than `shard` groups are dealt by hash into shards of about that many, each of
    which is balanced over 8 * k parts by itself, and the parts of all shards are
    the groups of the next round: no task sees more than a shard. Null counts are
    0; a null key is a group; of repeated keys the first row counts.
    """
    one = groups.groupBy(F.col(key).alias("key")).agg(F.first(counts).alias("counts"))
    shards = max(1, -(-one.count() // shard))
    parts = k if shards == 1 else 8 * k
    schema = f"key {one.schema['key'].dataType.simpleString()}, counts array<double>, part int, _shard long"

    def run(part: pd.DataFrame) -> pd.DataFrame:
        table = np.nan_to_num(np.array([[np.nan if v is None else v for v in c] for c in part["counts"]], float))
        whole = np.maximum(table.sum(0), 1)
        order = sorted(range(len(part)), key=lambda i: (-table[i].std(), -table[i].sum(), str(part["key"].iloc[i])))
        held, chosen = np.zeros((parts, table.shape[1])), np.zeros(len(part), int)
        for i in order:
            shares = held / whole
            more = shares + table[i] / whole
            # of the shares' sums and squares only those of the part change
            sums, squares = shares.sum(0) - shares + more, (shares**2).sum(0) - shares**2 + more**2
            uneven = np.sqrt(np.maximum(squares / parts - (sums / parts) ** 2, 0)).mean(1).round(12)
            chosen[i] = np.lexsort((np.arange(parts), held.sum(1), uneven))[0]
            held[chosen[i]] += table[i]
        return pd.DataFrame({"key": part["key"], "counts": list(table), "part": chosen, "_shard": part["_shard"]})

    dealt = one.withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("_shard").applyInPandas(run, schema)
    if shards == 1:
        return dealt.select(F.col("key").alias(key), F.col("part").alias("fold"))
    dealt = cut(dealt.withColumn("_p", F.col("_shard") * parts + F.col("part")))
    long = dealt.select("_p", F.posexplode("counts").alias("i", "n")).groupBy("_p", "i").agg(F.sum("n").alias("n"))
    merged = long.groupBy("_p").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "n"))), lambda s: s["n"]).alias("counts"))
    return dealt.join(balanced_folds(merged, "_p", "counts", k, max(shard, 16 * k)), "_p").select(F.col("key").alias(key), "fold")
