"""Classification, ranking and distribution metrics; every metric takes weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import col
from .cuts import cut
from .ordered import quantiles, running


def confusion(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """(truth, predicted, n, share): share of the truth's row."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(n.cast("double").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("truth")))


def dense_confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """The confusion counts with zeros for pairs that don't occur; classes x classes rows."""
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    kinds = counts.select(F.col("truth").alias("k")).union(counts.select("predicted")).distinct()
    # a table of class names, squared
    return kinds.select(F.col("k").alias("truth")).crossJoin(kinds.select(F.col("k").alias("predicted"))).join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def scores_by_class(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """(kind, support, precision, recall, f1), 0 where a ratio has no denominator."""
    c = confusion(df, truth, predicted, weight)
    long = c.select(F.col("truth").alias("kind"), F.col("n").alias("t"), F.lit(0.0).alias("p"), F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0.0).alias("tp")).union(c.select("predicted", F.lit(0.0), F.col("n"), F.lit(0.0)))
    g = long.groupBy("kind").agg(F.sum("t").alias("support"), F.sum("p").alias("_p"), F.sum("tp").alias("_tp"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = ratio(F.col("_tp"), F.col("_p")), ratio(F.col("_tp"), F.col("support"))
    return g.select("kind", "support", precision.alias("precision"), recall.alias("recall"), ratio(2 * F.col("_tp"), F.col("_p") + F.col("support")).alias("f1"))


def summary(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """(accuracy, macro_precision, macro_recall, macro_f1, weighted_f1)."""
    by = scores_by_class(df, truth, predicted, weight)
    return by.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def curve(df: DataFrame, y: str, score: str, weight: str | None = None) -> DataFrame:
    """(score, p, n, tp, fp, positives, negatives): weights of a score and of all scores from it upwards, one row for each distinct score.

    Ties share a row: rows are summed by score before anything is ordered, and
    the running sums go bucket by bucket.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    sums = df.groupBy(F.col(score).alias("score")).agg(F.sum(F.when(F.col(y) == 1, w).otherwise(0.0)).alias("p"), F.sum(F.when(F.col(y) == 1, 0.0).otherwise(w)).alias("n"))
    return summed_curve(sums)


def summed_curve(sums: DataFrame) -> DataFrame:
    """The curve of rows (score, p, n) with one row for each score, which are written once: edges, buckets and totals all read them."""
    sums = cut(sums)
    whole = sums.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    return running(sums, "score", {"tp": "p", "fp": "n"}, descending=True).crossJoin(F.broadcast(whole))  # one row


def areas(points: DataFrame) -> DataFrame:
    """(roc_auc, average_precision) of a curve: trapezoids, and the sum of precision times gained recall."""
    roc = F.sum(F.col("n") * (2 * F.col("tp") - F.col("p")) / 2) / F.max(F.col("positives") * F.col("negatives"))
    return points.agg(roc.alias("roc_auc"), F.sum(F.col("p") / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))


def auc(df: DataFrame, y: str, score: str, weight: str | None = None) -> DataFrame:
    return areas(curve(df, y, score, weight))


def thresholds(points: DataFrame, precision: float = 0.9) -> DataFrame:
    """(best_f1, best_youden, at_precision): the score of largest F1, of largest tpr - fpr, and of most recall at the precision; ties to the higher score."""
    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("positives"))
    j = F.col("tp") / F.col("positives") - F.col("fp") / F.col("negatives")
    held = F.when(F.col("tp") / (F.col("tp") + F.col("fp")) >= precision, F.col("tp"))
    pick = lambda x: F.max_by("score", F.struct(x.alias("v"), F.col("score").alias("s")))
    return points.agg(pick(f1).alias("best_f1"), pick(j).alias("best_youden"), F.max_by("score", F.when(held.isNotNull(), F.struct(held.alias("v"), F.col("score").alias("s")))).alias("at_precision"))


def proper_scores(df: DataFrame, y: str, p: str, least: float = 1e-7) -> DataFrame:
    """(brier, log_loss)."""
    q = F.least(F.greatest(F.col(p), F.lit(least)), F.lit(1 - least))
    return df.agg(F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier"), (-F.avg(F.when(F.col(y) == 1, F.ln(q)).otherwise(F.ln(1 - q)))).alias("log_loss"))


def evaluated(df: DataFrame, y: str, p: str, threshold: float = 0.5, weight: str | None = None) -> DataFrame:
    """One row: the summary of the classes at a threshold, the areas under both curves, Brier and log loss."""
    classes = summary(df.withColumn("_pred", (F.col(p) >= threshold).cast("int")).withColumn("_y", F.col(y).cast("int")), "_y", "_pred", weight)
    return classes.crossJoin(F.broadcast(auc(df, y, p, weight))).crossJoin(F.broadcast(proper_scores(df, y, p)))  # a row each


def calibration(df: DataFrame, y: str, p: str, bins: int = 15) -> DataFrame:
    """(bin, mean_p, rate, n) over bins whose edges are exact quantiles of p; equal edges share a bin."""
    found = quantiles(df.select(F.col(p).alias("value")), [i / bins for i in range(1, bins)], ())
    edges = found.agg(F.collect_list("value").alias("_e"))
    at = df.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("_e", lambda e: e < F.col(p))))  # one row
    return at.groupBy("bin").agg(F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))


def error_kinds(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """(n, fp, fn, fp_rate, fn_rate)."""
    fp, fn = ((F.col(y) == a) & (F.col(predicted) == b) for a, b in ((0, 1), (1, 0)))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n"), count(fp).alias("fp"), count(fn).alias("fn"), F.try_divide(count(fp), count(F.col(y) == 0)).alias("fp_rate"), F.try_divide(count(fn), count(F.col(y) == 1)).alias("fn_rate"))


def top_k_hits(truth: Column | str, ranked: Column | str, ks: tuple[int, ...] = (1, 3, 5, 8)) -> list[Column]:
    """Shares of rows whose truth is among the first k of the ranked classes."""
    return [F.avg(F.array_contains(F.slice(col(ranked), 1, k), col(truth)).cast("double")).alias(f"top_{k}") for k in ks]


def recall_at(df: DataFrame, truth: str, ranked: str, ks: tuple[int, ...] = (1, 2, 3, 5)) -> DataFrame:
    """(kind, n, recall_k ...) of each true class."""
    hit = lambda k: F.avg(F.array_contains(F.slice(F.col(ranked), 1, k), F.col(truth)).cast("double")).alias(f"recall_{k}")
    return df.groupBy(F.col(truth).alias("kind")).agg(F.count(F.lit(1)).alias("n"), *[hit(k) for k in ks])


def bag_divergence(df: DataFrame, bag: str, kind: str, p: str, w: str, least: float = 1e-12) -> DataFrame:
    """(bag, kl) from long rows (bag, kind, p, w): KL of the bag's proportions w from its mean prediction."""
    means = df.groupBy(bag, kind).agg(F.avg(p).alias("_p"), F.max(w).alias("_w"))
    term = F.when(F.col("_w") > 0, F.col("_w") * (F.ln(F.col("_w")) - F.ln(F.greatest(F.col("_p"), F.lit(least))))).otherwise(0.0)
    return means.groupBy(bag).agg(F.sum(term).alias("kl"))


def ranking(df: DataFrame, kind: str, p: str) -> DataFrame:
    """(kind, mean_p, max_p), best first."""
    return df.groupBy(kind).agg(F.avg(p).alias("mean_p"), F.max(p).alias("max_p")).orderBy(F.desc("mean_p"), kind)
