"""Weak labels: shares of classes in a region, the order of sources, soft rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import UNFIT
from ..functions.semantics import col

SOURCES = ("monitoreo", "eva_municipal", "noapto_proxy")
CONFIDENCE = {"monitoreo": 1.0, "eva_municipal": 0.70, "noapto_proxy": 0.40}


def shares(df: DataFrame, region: list[str], kind: str, area: str, more: Sequence[Column] = ()) -> DataFrame:
    """(region, kind, area, share): a class's part of its region's area, 0 where the region has none."""
    sums = df.groupBy(*region, kind).agg(F.sum(area).alias("area"), *more)
    whole = F.sum("area").over(W.partitionBy(*region))
    return sums.withColumn("share", F.when(whole > 0, F.col("area") / whole).otherwise(0.0))


def dominant(shared: DataFrame, region: list[str], kind: str, by: str = "area") -> DataFrame:
    """The class with most area of each region, ties to the smaller name."""
    place = F.row_number().over(W.partitionBy(*region).orderBy(F.desc(by), kind))
    return shared.withColumn("_n", place).where("_n = 1").drop("_n")


def as_map(shared: DataFrame, region: list[str], kind: str, share: str = "share") -> DataFrame:
    """(region, distribution): map of class to share, without zero shares and the unfit class."""
    kept = shared.where((F.col(share) > 0) & (F.col(kind) != UNFIT))
    return kept.groupBy(*region).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, share)))).alias("distribution"))


def unfit(votes: Column | str, ndvi: Column | str, least_votes: int = 3, bare: float = 0.15) -> Column:
    """At least three layers vote against, or too little vegetation; missing evidence is none."""
    return F.coalesce(col(votes) >= least_votes, F.lit(False)) | F.coalesce(col(ndvi) < bare, F.lit(False))


def prioritised(monitored: Column, regional: Column, unfit_flag: Column) -> tuple[Column, Column, Column]:
    """(class, confidence, source): monitoring, else the region's dominant class, else the unfit proxy, else none."""
    source = F.when(monitored.isNotNull(), "monitoreo").when(regional.isNotNull(), "eva_municipal").when(unfit_flag, "noapto_proxy")
    kind = F.coalesce(monitored, regional, F.when(unfit_flag, UNFIT))
    confidence = F.when(monitored.isNotNull(), 1.0).when(regional.isNotNull(), 0.70).when(unfit_flag, 0.40).otherwise(0.0)
    return kind, confidence, source


def gold_weight(source: Column | str) -> Column:
    return F.when(col(source) == "monitoreo", 1.0).when(col(source) == "eva_municipal", 0.7).otherwise(0.0)


def expanded(df: DataFrame, keys: list[str], soft: dict[str, str], confidence: str, least: float = 0.05) -> DataFrame:
    """(keys, kind, p, weight): a row for each class with p > least, weighted p * confidence * balance.

    balance is n / (K * n_class) over the expanded rows.
    """
    stacked = df.select(*keys, confidence, F.explode(F.create_map(*[x for name, column in soft.items() for x in (F.lit(name), F.col(column).cast("double"))])).alias("kind", "p"))
    rows = stacked.where(F.col("p") > least)
    counts = rows.groupBy("kind").agg(F.count(F.lit(1)).alias("_c"))
    totals = counts.agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
    sized = counts.crossJoin(F.broadcast(totals)).select("kind", (F.col("_n") / (F.col("_k") * F.col("_c"))).alias("_b"))  # a row for each class
    return rows.join(F.broadcast(sized), "kind").select(*keys, "kind", "p", (F.col("p") * F.col(confidence) * F.col("_b")).alias("weight"))
