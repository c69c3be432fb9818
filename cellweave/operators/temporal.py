"""Time: half-years, minimum support, anomalies, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.semantics import col, half_year, std_pop


def calendar(spark, first_year: int, last_year: int, last_second_half: bool = True) -> DataFrame:
    """(month_label, semester, start, next_start): the months of the period."""
    months = spark.sql(f"select explode(sequence(date'{first_year}-01-01', date'{last_year}-{'12' if last_second_half else '06'}-01', interval 1 month)) as start")
    return months.select(F.date_format("start", "yyyy_MM").alias("month_label"), half_year("start").alias("semester"), "start", F.add_months("start", 1).alias("next_start"), F.dayofmonth(F.last_day("start")).alias("days"))


def months_of(semester: Column | str) -> Column:
    """The six month labels of a half-year."""
    s = col(semester)
    first = F.when(F.endswith(s, F.lit("B")), 7).otherwise(1)
    return F.transform(F.sequence(first, first + 5), lambda m: F.concat_ws("_", F.substring(s, 1, 4), F.lpad(m.cast("string"), 2, "0")))


def supported(monthly: DataFrame, layer: list[str], period: str, month: str, least: int) -> DataFrame:
    """Rows of the layers and periods that have at least `least` distinct months, counted on the layer, not the cell."""
    enough = monthly.groupBy(*layer, period).agg(F.count_distinct(month).alias("_m")).where(F.col("_m") >= least).drop("_m")
    return monthly.join(enough, [*layer, period], "left_semi")


def anomaly(value: Column | str, keys: list, floor: float = 1.0) -> Column:
    """(value - mean) / population std within a partition, the std at least `floor`."""
    w = W.partitionBy(*keys)
    v = col(value).cast("double")
    std = F.stddev_pop(v).over(w)
    return (v - F.avg(v).over(w)) / F.when(std.isNotNull(), F.greatest(std, F.lit(floor)))


def filled(value: Column | str, keys: list, order: Column | str) -> Column:
    """A gap takes the mean of the nearest valid values before and after, or the one there is."""
    w = W.partitionBy(*keys).orderBy(order)
    v = col(value)
    before = F.last(v, True).over(w.rowsBetween(W.unboundedPreceding, -1))
    after = F.first(v, True).over(w.rowsBetween(1, W.unboundedFollowing))
    return F.coalesce(v, (before + after) / 2, before, after)


def spread_over_time(df: DataFrame, cell: list[str], value: str, least: int = 2) -> DataFrame:
    """(cell, sigma, mean) over all periods of cells with at least `least` values."""
    return df.groupBy(*cell).agg(std_pop(value).alias("sigma"), F.avg(F.col(value).cast("double")).alias("mean"), F.count(value).alias("n")).where(F.col("n") >= least)


def latest(df: DataFrame, cell: list[str], period: str, value: str, periods: int = 4) -> DataFrame:
    """(cell, value): maximum over the table's last periods, missing values skipped."""
    last = df.select(period).distinct().orderBy(F.desc(period)).limit(periods)
    return df.join(F.broadcast(last), period, "left_semi").groupBy(*cell).agg(F.max(value).alias(value))  # at most `periods` rows
