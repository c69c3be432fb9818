"""Rank classes inside a polygon: filter, infer, combine, aggregate.

The semester prunes folders, the polygon's box reaches the Parquet scan, the
exact rule runs on what is left. Both models score in one pass; the binary
model's chance replaces its class, rows are renormalised, classes are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import grid, metrics
from ..sources import sinks

# Colours of classes on a map.
COLOURS = {
    "Papa": "#8B4513", "Cafe": "#6F4E37", "Maiz": "#FFD700", "Cana_Panelera": "#9ACD32", "Platano": "#FFFF66", "Mango": "#FFA500",
    "Frijol": "#A0522D", "Cacao": "#7B3F00", "Arveja": "#7CFC00", "Palma": "#228B22", "Banano": "#FFE135", "Citricos": "#FFA07A",
    "Mora": "#8B0000", "Zanahoria": "#FF8C00", "Tomate_Arbol": "#FF6347", "Yuca": "#DEB887", "Habichuela": "#90EE90", "Hortalizas": "#3CB371",
}
PLAIN_COLOUR = "#888888"


def validated(semester: str, polygon: Sequence, semesters: Sequence[str]) -> None:
    """Refuses an unknown semester and a ring of fewer than three corners before a job starts."""
    if semester not in semesters:
        raise ValueError(f"semester {semester} is not one of {', '.join(semesters)}")
    if not polygon or len(polygon[0]) < 4:
        raise ValueError("a polygon needs a closed ring of at least three corners")


def pixels(view: DataFrame, semester: str, polygon: Sequence, x: str = "x", y: str = "y", label: str = "semestre") -> DataFrame:
    return grid.within(view.where(F.col(label) == semester), polygon, x, y)


def combined(df: DataFrame, soft: Callable[[DataFrame, str], DataFrame], replaced: int, binary: Column, key: str) -> DataFrame:
    """(key, p): chances of the many-class model with one class's chance taken from the binary model, renormalised.

    soft(df, "_b") returns (key, p, _b): the binary chance goes along, so that the rows are read once.
    """
    p = soft(df.withColumn("_b", binary), "_b")
    swapped = F.transform("p", lambda v, i: F.when(i == replaced, F.col("_b")).otherwise(v))
    return p.select(key, swapped.alias("_q")).select(key, vectors.row_normalised("_q").alias("p"))


def ranked(chances: DataFrame, classes: Sequence[str]) -> DataFrame:
    """(cultivo, prob_media, prob_max, color), best first; colours from the map of fixed values."""
    names = F.array(*[F.lit(c) for c in classes])
    long = chances.select(F.posexplode("p").alias("k", "v")).select(F.get(names, F.col("k")).alias("cultivo"), "v")
    colours = F.create_map(*[x for k, v in COLOURS.items() for x in (F.lit(k), F.lit(v))])
    order = metrics.ranking(long, "cultivo", "v")
    return order.select("cultivo", F.col("mean_p").alias("prob_media"), F.col("max_p").alias("prob_max"), F.coalesce(F.try_element_at(colours, "cultivo"), F.lit(PLAIN_COLOUR)).alias("color"))


def answer(ranking: DataFrame, n: int, semester: str) -> DataFrame:
    """(value): the response as one JSON text; the ranking has a row for each class."""
    rows = F.array_sort(F.collect_list(F.struct("prob_media", "prob_max", "cultivo", "color")))
    return ranking.agg(F.to_json(F.struct(F.lit(n).alias("n_pixeles"), F.lit(semester).alias("semestre"), F.reverse(rows).alias("ranking"))).alias("value"))


__all__ = ["answer", "combined", "pixels", "ranked", "sinks", "validated"]
