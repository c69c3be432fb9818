"""Results as files: Parquet, CSV, GeoJSON, JSON objects, ASCII grids, Markdown and HTML reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import NODATA, export
from ..operators import statistics


def parquet(df: DataFrame, path: str, by: Sequence[str] = ("semestre",), again: bool = False) -> None:
    """Snappy Parquet by semester; what is there already stays unless asked for again."""
    df.write.mode("overwrite" if again else "ignore").option("compression", "snappy").partitionBy(*[c for c in by if c in df.columns]).parquet(path)


def csv(df: DataFrame, path: str, again: bool = False) -> None:
    df.write.mode("overwrite" if again else "ignore").csv(path, header=True)


def features(df: DataFrame, rings: str = "rings", properties: Sequence[str] = ()) -> DataFrame:
    """(value): one GeoJSON feature a row, ready for write.text: a stream that other tools append to or read line by line."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col(rings).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))


def json_object(df: DataFrame, key: str, value: str) -> DataFrame:
    """(value): one JSON object of a small table, as catalogues and code tables are."""
    return df.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))).alias("value"))


def response(ranked: Sequence[Column], pixels: Column, semester: Column, n: Column) -> Column:
    return F.to_json(F.struct(n.alias("n_pixeles"), semester.alias("semestre"), F.array(*ranked).alias("ranking"), pixels.alias("pixeles")))


def ascii_rows(cells: DataFrame, width: int) -> DataFrame:
    """(row, value): a grid's lines of text, missing cells as NoData."""
    full = F.map_from_entries(F.collect_list(F.struct("col", export("value"))))
    lines = cells.groupBy("row").agg(full.alias("m"))
    return lines.select("row", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(NODATA)).cast("string")), " ").alias("value"))


def markdown(df: DataFrame, title: str, most: int = 10_000) -> str:
    """A report table; the caller hands in a profile, a row for each column of a table. More than `most` rows are no report, and raise."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    head = f"# {title}\n\n| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns) + "\n"
    return head + "".join("| " + " | ".join("" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) + " |\n" for r in rows)


def html_profile(df: DataFrame, title: str, columns: Sequence[str] | None = None) -> str:
    """Description and null shares of the numeric columns."""
    names = list(columns or statistics.numeric_columns(df))
    profile = statistics.describe(df, names).join(statistics.null_profile(df, names).select("name", "null_share"), "name")
    body = "".join("<tr>" + "".join(f"<td>{'' if v is None else v}</td>" for v in r) + "</tr>" for r in profile.orderBy("name").collect())
    return f"<!doctype html><title>{title}</title><table><tr>" + "".join(f"<th>{c}</th>" for c in profile.columns) + f"</tr>{body}</table>"
