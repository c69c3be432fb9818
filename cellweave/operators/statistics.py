"""Profiles, distributions, correlation, scaling, pruning. Quantiles are exact throughout."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import quantiles

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame, leave: Sequence[str] = (), prefix: str | None = None) -> list[str]:
    return [n for n, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and n not in leave and not (prefix and n.startswith(prefix))]


def feature_columns(df: DataFrame, leave: Sequence[str], prefix: str = "prob_") -> list[str]:
    """All columns but the excluded ones and those of the soft target."""
    return [c for c in df.columns if c not in leave and not c.startswith(prefix)]


def repeated_columns(names: Sequence[str]) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n in seen or seen.add(n)]


def long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, name, value): one row for each cell of the columns, values as doubles, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.name", "_p.value")


def stacked_aggregates(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """(name, measures): each measure of each column, one scan and one row before unpivoting."""
    wide = df.agg(*[f(c).alias(f"{m}__{c}") for c in columns for m, f in measures.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), *[F.col(f"{m}__{c}").alias(m) for m in measures]) for c in columns])
    return wide.select(F.explode(rows).alias("_r")).select("_r.*")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return stacked_aggregates(df, columns, {"null_share": lambda c: F.avg(F.col(c).isNull().cast("double")), "n": lambda c: F.count(F.lit(1))})


def zero_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return stacked_aggregates(df, columns, {"zero_share": lambda c: F.avg((F.col(c) == 0).cast("double"))})


def quantile(c: str, q: float) -> Column:
    """Exact quantile of a group of moderate size: its buffer counts each distinct value. Of whole columns, see whole_quantiles."""
    return F.percentile(F.col(c).cast("double"), F.lit(q))


def whole_quantiles(df: DataFrame, columns: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    """(name, one column for each wanted quantile) of whole columns, exact, by running counts."""
    found = quantiles(long(df, columns), list(dict.fromkeys(wanted.values())))
    return found.groupBy("name").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for n, q in wanted.items()])


def wide_quantiles(df: DataFrame, columns: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    """One row: a column <prefix><name> for each quantile of each column."""
    rows = whole_quantiles(df, columns, wanted)
    return rows.agg(*[F.max(F.when(F.col("name") == c, F.col(n))).alias(f"{n}{c}") for c in columns for n in wanted])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    d = lambda c: F.col(c).cast("double")
    moments = stacked_aggregates(df, columns, {"n": lambda c: F.count(c), "mean": lambda c: F.avg(d(c)), "std": lambda c: F.stddev_samp(d(c)), "min": lambda c: F.min(d(c)), "max": lambda c: F.max(d(c))})
    ranks = whole_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(ranks, "name", "left").select("name", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def basic(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population std, percentiles, coefficient of variation, share of zeros."""
    d = lambda c: F.col(c).cast("double")
    moments = stacked_aggregates(df, columns, {"mean": lambda c: F.avg(d(c)), "std": lambda c: F.stddev_pop(d(c)), "cv": lambda c: F.stddev_pop(d(c)) / (F.abs(F.avg(d(c))) + 1e-9), "zero_share": lambda c: F.avg((d(c) == 0).cast("double"))})
    ranks = whole_quantiles(df, columns, {"p5": 0.05, "p95": 0.95})
    return moments.join(ranks, "name", "left").select("name", "mean", "std", "p5", "p95", "cv", "zero_share")


def extremes(df: DataFrame, columns: Sequence[str], sigmas: float = 5.0) -> DataFrame:
    """(name, n): values further than so many sample stds from the mean; one pass for moments, one for counts."""
    moments = df.agg(*[f(F.col(c).cast("double")).alias(f"{m}__{c}") for c in columns for m, f in (("m", F.avg), ("s", F.stddev_samp))])
    joined = df.select(*columns).crossJoin(F.broadcast(moments))  # one row
    return stacked_aggregates(joined, columns, {"n": lambda c: F.coalesce(F.sum((F.abs(F.col(c) - F.col(f"m__{c}")) > sigmas * F.col(f"s__{c}")).cast("long")), F.lit(0))})


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share, running): most frequent first, ties by value; the window runs over the counts, not the rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(W.partitionBy())
    run = F.sum("n").over(W.orderBy(F.desc("n"), "value").rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.select("value", "n", (F.col("n") / whole).alias("share"), (run / whole).alias("running"))


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.median(v).alias("median"), F.max(v).alias("max"))


def crosstab(df: DataFrame, a: str, b: str, margins: bool = True) -> DataFrame:
    """(a, b, n): counts of pairs, with totals as missing keys when margins are asked for."""
    return (df.cube(a, b) if margins else df.groupBy(a, b)).agg(F.count(F.lit(1)).alias("n"))


def repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(rows, repeats): rows beyond the first of their key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("repeats"))


def modal_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, modal_share, distinct): the most frequent value's part of the known ones."""
    counts = long(df, columns).where("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("name").agg((F.max("_n") / F.sum("_n")).alias("modal_share"), F.count(F.lit(1)).alias("distinct"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for a before b in the order given: Pearson over the rows where both are known, one scan."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    d = lambda c: F.col(c).cast("double")
    wide = df.agg(*[F.corr(d(a), d(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("_r")).select("_r.*")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return stacked_aggregates(df, columns, {"r": lambda c: F.corr(F.col(c).cast("double"), F.col(target).cast("double"))})


def pruned(pairs: Sequence[tuple[str, str, float]], above: float = 0.85) -> list[str]:
    """Columns to drop: from the strongest pair on, the one with the larger mean |r| goes, unless its partner already has. Pairs are few."""
    strength: dict[str, list[float]] = {}
    for a, b, r in pairs:
        strength.setdefault(a, []).append(abs(r))
        strength.setdefault(b, []).append(abs(r))
    mean = {c: sum(v) / len(v) for c, v in strength.items()}
    gone: list[str] = []
    for a, b, r in sorted(pairs, key=lambda p: (-abs(p[2]), p[0], p[1])):
        if abs(r) > above and a not in gone and b not in gone:
            gone.append(a if (mean[a], a) > (mean[b], b) else b)
    return gone


def imputed(df: DataFrame, medians: Sequence[str] = (), modes: Sequence[str] = ()) -> DataFrame:
    """Missing values take the column's exact median, or its most frequent value (ties to the smaller)."""
    joined = df
    if medians:
        joined = joined.crossJoin(F.broadcast(wide_quantiles(df, medians, {"_m_": 0.5})))  # one row
    for c in modes:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        joined = joined.crossJoin(F.broadcast(counts.orderBy(F.desc("_n"), c).limit(1).agg(F.max(c).alias(f"_m_{c}"))))  # one row
    fill = {c: F.coalesce(F.col(c).cast("double") if c in medians else F.col(c), F.col(f"_m_{c}")) for c in [*medians, *modes]}
    return joined.select(*[fill[c].alias(c) if c in fill else F.col(c) for c in df.columns])


def scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c - mean) / population std; a constant column becomes 0."""
    facts = df.agg(*[f(F.col(c).cast("double")).alias(f"_{m}_{c}") for c in columns for m, f in (("a", F.avg), ("s", F.stddev_pop))])
    joined = df.crossJoin(F.broadcast(facts))  # one row
    z = {c: (F.col(c) - F.col(f"_a_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}")) for c in columns}
    return joined.select(*[z[c].alias(c) if c in z else F.col(c) for c in df.columns])


def normalised(df: DataFrame, columns: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Each column between its exact quantiles, clipped to 0 to 1."""
    from ..functions.agronomy import min_max

    facts = wide_quantiles(df, columns, {"_l_": low, "_h_": high})
    joined = df.crossJoin(F.broadcast(facts))  # one row
    return joined.select(*[min_max(F.col(c).cast("double"), F.col(f"_l_{c}"), F.col(f"_h_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def enveloped(df: DataFrame, reference: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.95, slack: float = 0.1) -> DataFrame:
    """Rows whose columns lie within the reference's quantiles, each widened by a part of itself."""
    facts = wide_quantiles(reference, columns, {"_l_": low, "_h_": high})
    joined = df.crossJoin(F.broadcast(facts))  # one row
    ok = reduce(lambda a, b: a & b, [F.col(c).between(F.col(f"_l_{c}") - slack * F.abs(f"_l_{c}"), F.col(f"_h_{c}") + slack * F.abs(f"_h_{c}")) for c in columns])
    return joined.where(ok).select(df.columns)


def binned_information(df: DataFrame, column: str, target: str, bins: int = 10) -> DataFrame:
    """(mi): mutual information of a column, in bins of equal width, with a class, in nats."""
    facts = df.agg(F.min(F.col(column).cast("double")).alias("_l"), F.max(F.col(column).cast("double")).alias("_h"))
    b = F.least(F.lit(bins - 1), F.floor((F.col(column) - F.col("_l")) / (F.col("_h") - F.col("_l")) * bins))
    cells = df.where(F.col(column).isNotNull() & F.col(target).isNotNull()).crossJoin(F.broadcast(facts)).groupBy(F.when(F.col("_h") > F.col("_l"), b).otherwise(0).alias("_b"), F.col(target).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))  # facts: one row
    n, nb, nt = (F.sum("_n").over(W.partitionBy(*k)) for k in ((), ("_b",), ("_t",)))
    return cells.select((F.col("_n") / n * F.ln(F.col("_n") * n / (nb * nt))).alias("_i")).agg(F.sum("_i").alias("mi"))


def encoded(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Adds contiguous ids of the values in order."""
    kinds = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn(out, F.dense_rank().over(W.orderBy(column)) - 1)
    return df.join(kinds, column, "left")


def factorised(df: DataFrame, column: str, order: str, out: str = "code") -> DataFrame:
    """(column, out): ids from 1 in order of first appearance."""
    firsts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    return firsts.select(column, F.row_number().over(W.orderBy("_first", column)).alias(out))


def one_hot(df: DataFrame, column: str, kinds: Sequence[str]) -> DataFrame:
    """A 0/1 column for each kind; values outside them are all zeros."""
    return df.select("*", *[F.coalesce((F.col(column) == k).cast("int"), F.lit(0)).alias(f"{column}_{k}") for k in kinds])


def range_checks(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """(name, low, high, n, outside, ok): values outside the physical range of each column."""
    measures = stacked_aggregates(df, list(ranges), {"n": lambda c: F.count(c), "outside": lambda c: F.coalesce(F.sum((~F.col(c).between(*ranges[c])).cast("long")), F.lit(0))})
    limits = F.create_map(*[x for c, (a, b) in ranges.items() for x in (F.lit(c), F.struct(F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high")))])
    return measures.select("name", limits[F.col("name")]["low"].alias("low"), limits[F.col("name")]["high"].alias("high"), "n", "outside", (F.col("outside") == 0).alias("ok"))
