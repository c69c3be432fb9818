"""Raster operators on long tables of cells (row, col, value): windows, relief, resampling, burning, binning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.semantics import col
from .statistics import wide_quantiles
from .tiles import windows


def grid(spark, rows: int, cols: int) -> DataFrame:
    """(row, col) of every cell, made in the executors."""
    ids = spark.range(rows * cols)
    return ids.select(F.expr(f"cast(id div {cols} as int)").alias("row"), F.expr(f"cast(id % {cols} as int)").alias("col"))


def centre(row: Column | str, column: Column | str, west: float, north: float, size: float) -> tuple[Column, Column]:
    """x and y of a cell's centre on a north-up grid."""
    return F.lit(west) + (col(column) + 0.5) * size, F.lit(north) - (col(row) + 0.5) * size


def cell_of(x: Column | str, y: Column | str, west: float, north: float, size: float) -> tuple[Column, Column]:
    return F.floor((F.lit(north) - col(y)) / size).cast("int"), F.floor((col(x) - F.lit(west)) / size).cast("int")


def neighbours(cells: DataFrame, rows: int, cols: int, reach: int = 1, clamp: bool = True) -> DataFrame:
    """(row, col, dr, dc, value): the values around each cell.

    Each value is sent to the cells that see it; with clamp a cell beyond the
    edge repeats the edge, as one that lies there sends its value for it too.
    One shuffle on (row, col) follows in whatever groups the result.
    """
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    sent = cells.select("row", "col", "value", F.explode(steps).alias("dr")).select("*", F.explode(steps).alias("dc"))
    at = sent.select((F.col("row") - F.col("dr")).alias("_r"), (F.col("col") - F.col("dc")).alias("_c"), "dr", "dc", "value", F.col("row").alias("_sr"), F.col("col").alias("_sc"))
    inner = at.where(F.col("_r").between(0, rows - 1) & F.col("_c").between(0, cols - 1)).select(F.col("_r").alias("row"), F.col("_c").alias("col"), "dr", "dc", "value")
    if not clamp:
        return inner
    # what a border cell misses is the value of the cell that its clamped position names
    pad = cells.where((F.col("row") < reach) | (F.col("row") >= rows - reach) | (F.col("col") < reach) | (F.col("col") >= cols - reach))
    span = F.sequence(F.lit(-reach), F.lit(reach))
    seen = cells.select("row", "col").where((F.col("row") < reach) | (F.col("row") >= rows - reach) | (F.col("col") < reach) | (F.col("col") >= cols - reach))
    want = seen.select("row", "col", F.explode(span).alias("dr")).select("*", F.explode(span).alias("dc"))
    r, c = F.col("row") + F.col("dr"), F.col("col") + F.col("dc")
    beyond = want.where(~(r.between(0, rows - 1) & c.between(0, cols - 1))).select("*", F.greatest(F.lit(0), F.least(F.lit(rows - 1), r)).alias("_r"), F.greatest(F.lit(0), F.least(F.lit(cols - 1), c)).alias("_c"))
    edge = pad.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return inner.unionByName(beyond.join(edge, ["_r", "_c"]).select("row", "col", "dr", "dc", "value"))


def medians(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """(row, col, med, n): the median of the 3 x 3 values around each cell, and how many there are."""

    def run(w: np.ndarray) -> dict[str, np.ndarray]:
        n = (~np.isnan(w)).sum(0)
        sorted_ = np.sort(w, 0)  # NaN last
        at = np.arange(w.shape[1])
        low, high = sorted_[np.maximum(n - 1, 0) // 2, at], sorted_[np.maximum(n, 1) // 2, at]
        return {"med": (low + high) / 2, "n": n}

    return windows(cells, rows, cols, run, "med double, n long")


def terrain(cells: DataFrame, rows: int, cols: int, size: float) -> DataFrame:
    """(row, col, slope_pct, slope_deg, aspect, laplacian) by Horn's weights; aspect in degrees from north, -1 where flat; null where the window has a hole."""

    def run(w: np.ndarray) -> dict[str, np.ndarray]:
        gx = ((w[2] + 2 * w[5] + w[8]) - (w[0] + 2 * w[3] + w[6])) / (8.0 * size)
        gy = ((w[6] + 2 * w[7] + w[8]) - (w[0] + 2 * w[1] + w[2])) / (8.0 * size)
        rise = np.sqrt(gx * gx + gy * gy)
        turned = np.degrees(np.arctan2(-gx, gy))
        aspect = np.where(rise == 0, -1.0, np.where(turned < 0, turned + 360.0, turned))
        return {"slope_pct": rise * 100, "slope_deg": np.degrees(np.arctan(rise)), "aspect": aspect, "laplacian": (w[1] + w[3] + w[5] + w[7] - 4 * w[4]) / (size * size)}

    return windows(cells, rows, cols, run, "slope_pct double, slope_deg double, aspect double, laplacian double")


def median_filled(cells: DataFrame, rows: int, cols: int, valid_only: bool = False) -> DataFrame:
    """(row, col, value): missing values take the median of the 3 x 3 window.

    As the method in use fills it: missing values first take the layer's median,
    then the window's is taken; with valid_only the window's valid values alone
    count and a window without any stays missing.
    """
    if valid_only:
        source = cells
    else:
        whole = wide_quantiles(cells, ["value"], {"_m_": 0.5}).withColumnRenamed("_m_value", "_m")
        source = cells.crossJoin(F.broadcast(whole)).select("row", "col", F.coalesce("value", "_m").alias("value"))  # one row
    return cells.join(medians(source, rows, cols), ["row", "col"], "left").select("row", "col", F.coalesce("value", "med").alias("value"))


def resample_nearest(source: DataFrame, target: DataFrame, fr: Column, fc: Column) -> DataFrame:
    """target with the value of the source cell in which its fractional index (fr, fc) lies."""
    at = target.withColumn("_r", F.floor(fr + 0.5).cast("int")).withColumn("_c", F.floor(fc + 0.5).cast("int"))
    cells = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return at.join(cells, ["_r", "_c"], "left").drop("_r", "_c")


def resample_kernel(source: DataFrame, target: DataFrame, fr: Column, fc: Column, kind: str = "bilinear") -> DataFrame:
    """target (keyed by its columns) with a weighted mean of the 4 (bilinear) or 16 (cubic) source cells around its fractional index.

    Weights are renormalised over valid cells; no valid one leaves the value missing.
    """
    reach = (0, 1) if kind == "bilinear" else (-1, 2)
    keys = target.columns

    def weight(d: Column) -> Column:
        if kind == "bilinear":
            return F.greatest(F.lit(0.0), 1 - F.abs(d))
        t = F.abs(d)
        near, far = 1.5 * t * t * t - 2.5 * t * t + 1, -0.5 * t * t * t + 2.5 * t * t - 4 * t + 2
        return F.when(t <= 1, near).when(t < 2, far).otherwise(0.0)

    span = F.sequence(F.lit(reach[0]), F.lit(reach[1]))
    t = target.withColumn("_fr", fr).withColumn("_fc", fc)
    t = t.select("*", F.explode(span).alias("_dr")).select("*", F.explode(span).alias("_dc"))
    t = t.withColumn("_r", (F.floor("_fr") + F.col("_dr")).cast("int")).withColumn("_c", (F.floor("_fc") + F.col("_dc")).cast("int"))
    t = t.withColumn("_w", weight(F.col("_fr") - F.col("_r")) * weight(F.col("_fc") - F.col("_c")))
    cells = source.where("value is not null").select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    joined = t.join(cells, ["_r", "_c"], "left")
    kept = F.when(F.col("value").isNotNull(), F.col("_w"))
    return joined.groupBy(*keys).agg(F.try_divide(F.sum(F.col("value") * F.col("_w")), F.sum(kept)).alias("value"))


def burn(cells: DataFrame, shapes: DataFrame, size: float, west: float, north: float) -> DataFrame:
    """(row, col, value): value of the last shape (largest ord) whose rings hold the cell's centre.

    shapes: (ord, value, rings). A shape goes to the coarse blocks that its box
    meets and meets only the cells of those blocks, an equi-join.
    """
    block = 64
    minx, miny, maxx, maxy = geometry.box(F.element_at("rings", 1))
    r0, c0 = cell_of(minx, maxy, west, north, size)
    r1, c1 = cell_of(maxx, miny, west, north, size)
    dealt = shapes.withColumn("_br", F.explode(F.sequence(F.floor(r0 / block), F.floor(r1 / block)))).withColumn("_bc", F.explode(F.sequence(F.floor(c0 / block), F.floor(c1 / block))))
    x, y = centre("row", "col", west, north, size)
    at = cells.select("row", "col", x.alias("_x"), y.alias("_y"), F.floor(F.col("row") / block).alias("_br"), F.floor(F.col("col") / block).alias("_bc"))
    hit = at.join(dealt, ["_br", "_bc"]).where(geometry.inside("_x", "_y", "rings"))
    return hit.groupBy("row", "col").agg(F.max_by("value", "ord").alias("value"))


def within(points: DataFrame, rings: list[list[list[float]]], x: str = "x", y: str = "y") -> DataFrame:
    """Points inside one polygon: its box first, which reaches the scan, then the exact rule."""
    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
    shape = F.array(*[F.array(*[F.array(F.lit(float(p[0])), F.lit(float(p[1]))) for p in ring]) for ring in rings])
    return points.where(F.col(x).between(min(xs), max(xs)) & F.col(y).between(min(ys), max(ys))).where(geometry.inside(x, y, shape))


def binned(points: DataFrame, size: float, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """(bx, by, mean, n) over square bins."""
    return points.groupBy(F.floor(F.col(x) / size).alias("bx"), F.floor(F.col(y) / size).alias("by")).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def mosaic(tiles: DataFrame, keys: list[str], order: str = "tile", value: str = "value") -> DataFrame:
    """For each key the value of the first tile that has one."""
    return tiles.groupBy(*keys).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))
