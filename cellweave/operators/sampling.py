"""Deterministic samples and splits: hash order in place of a random generator, so that reruns and other engines agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import col


def ticket(key: Column | str, seed: int = 42) -> Column:
    """md5 of the key and a seed: a fixed shuffle that SQL engines share."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col(key).cast("string")))


def quotas(df: DataFrame, stratum: list[str], size: int) -> DataFrame:
    """(stratum, n, quota): max(1, floor(size * n / N)), at most n."""
    counts = df.groupBy(*stratum).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"))
    return counts.crossJoin(F.broadcast(whole)).select(*stratum, "n", F.least("n", F.greatest(F.lit(1), F.floor(F.lit(size) * F.col("n") / F.col("_all")))).alias("quota"))  # one row


def stratified(df: DataFrame, stratum: list[str], key: str, size: int, always: Column | None = None, seed: int = 42) -> DataFrame:
    """All rows that `always` picks, and of the others each stratum's quota of what is left of `size`."""
    kept = df.where(always) if always is not None else None
    rest = df.where(~F.coalesce(always, F.lit(False))) if always is not None else df
    left = max(0, size - kept.count()) if kept is not None else size
    q = quotas(rest, stratum, left)
    place = F.row_number().over(W.partitionBy(*stratum).orderBy(ticket(key, seed), key))
    chosen = rest.join(q, stratum).withColumn("_n", place).where((F.col("_n") <= F.col("quota")) & F.lit(left > 0)).select(df.columns)
    return chosen.unionByName(kept) if kept is not None else chosen


def first_by_hash(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(ticket(key, seed), key).limit(n)


def bags(df: DataFrame, bag: list[str], key: str, most: int = 2048, seed: int = 42) -> DataFrame:
    """At most `most` rows of each bag."""
    place = F.row_number().over(W.partitionBy(*bag).orderBy(ticket(key, seed), key))
    return df.withColumn("_n", place).where(F.col("_n") <= most).drop("_n")


def group_split(groups: DataFrame, key: str, test: float = 0.15, valid: float = 0.15, seed: int = 42) -> DataFrame:
    """(key, fold): whole groups to train, valid or test, by shares of the number of groups."""
    ranked = groups.select(key).distinct().withColumn("_n", F.row_number().over(W.orderBy(ticket(key, seed), key)))
    count = ranked.agg(F.count(F.lit(1)).alias("_all"))
    n, tests, valids = F.col("_n"), F.ceil(F.col("_all") * test), F.ceil(F.col("_all") * valid)
    return ranked.crossJoin(F.broadcast(count)).select(key, F.when(n <= tests, "test").when(n <= tests + valids, "valid").otherwise("train").alias("fold"))  # one row


def class_group_split(groups: DataFrame, key: str, kind: str, least: int = 4, test: float = 0.15, valid: float = 0.15, seed: int = 42) -> DataFrame:
    """(key, kind, pool, fold): groups split within their dominant class; classes of fewer than `least` groups share a pool.

    A class of the pool keeps its groups in train first: its smallest ticket is
    never held out, so each class can be learned.
    """
    counts = groups.groupBy(kind).agg(F.count(F.lit(1)).alias("_c"))
    pooled = groups.join(counts, kind).withColumn("pool", F.when(F.col("_c") < least, "minority").otherwise(F.col(kind)))
    rescue = F.row_number().over(W.partitionBy(kind).orderBy(ticket(key, seed), key))
    marked = pooled.withColumn("_keep", (rescue == 1) & (F.col("_c") < least))
    w = W.partitionBy("pool").orderBy("_keep", ticket(key, seed), key)
    size = F.count(F.lit(1)).over(W.partitionBy("pool"))
    n = F.row_number().over(w)
    fold = F.when(F.col("_keep"), "train").when(n <= F.floor(size * test), "test").when(n <= F.floor(size * test) + F.floor(size * valid), "valid").otherwise("train")
    return marked.select(key, kind, "pool", fold.alias("fold"))


def folds(groups: DataFrame, key: str, size: str, k: int) -> DataFrame:
    """(key, fold): groups from large to small go round the folds there and back, which balances them without a running state."""
    n = F.row_number().over(W.orderBy(F.desc(size), key)) - 1
    lap, at = F.floor(n / k), F.pmod(n, F.lit(k))
    return groups.select(key, size, F.when(F.pmod(lap, F.lit(2)) == 0, at).otherwise(k - 1 - at).cast("int").alias("fold"))


def class_folds(groups: DataFrame, key: str, kind: str, size: str, k: int) -> DataFrame:
    """(key, kind, size, fold): within each dominant class, groups from large to small go round the folds there and back, each class starting one fold on."""
    classes = groups.select(kind).distinct().withColumn("_k", F.row_number().over(W.orderBy(kind)) - 1)  # a row for each class
    n = F.row_number().over(W.partitionBy(kind).orderBy(F.desc(size), key)) - 1
    lap, at = F.floor(n / k), F.pmod(n, F.lit(k))
    turned = F.when(F.pmod(lap, F.lit(2)) == 0, at).otherwise(k - 1 - at)
    return groups.join(classes, kind).select(key, kind, size, F.pmod(turned + F.col("_k"), F.lit(k)).cast("int").alias("fold"))


def within_class_split(df: DataFrame, kind: str, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds is_test: the first share of each class by ticket."""
    place = F.row_number().over(W.partitionBy(kind).orderBy(ticket(key, seed), key))
    size = F.count(F.lit(1)).over(W.partitionBy(kind))
    return df.withColumn("is_test", place <= F.floor(size * test))
