"""The wide table: sampled cells by semester with features, hard and soft labels, in the contract's column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import agronomy, vectors
from ..functions.names import MODEL_CLASSES, UNFIT, class_id
from ..functions.semantics import first_argmax
from ..operators import labels

META = ("pixel_id", "x", "y", "semestre", "cod_mun")
STATIC = (
    "elevacion", "pendiente", "twi", "piso_termico", "aspecto_sin", "aspecto_cos", "sg_phh2o", "sg_soc", "sg_nitrogen", "sg_cec", "sg_bdod", "sg_clay", "sg_sand", "sg_silt",
    "igac_fertilidad", "igac_fosforo", "igac_ph", "igac_potasio", "igac_vocacion", "indice_fertilidad", "ndvi_sigma_temporal", "ndvi_mean_temporal",
)
SEASONAL = (
    "temperatura_media", "temperatura_max", "temperatura_min", "humedad_media", "chirps_acum", *(f"s2_{i}_{m}" for i in ("ndvi", "gndvi", "msavi", "bsi", "savi") for m in ("media", "max", "std")),
    "amplitud_termica", "anomalia_precip", "ndvi_max", "ndvi_integral", "indice_aridez",
)
HARD = ("cultivo", "cultivo_id", "confianza", "fuente", "rendimiento_tha")
SOFT = tuple(f"prob_{c}" for c in MODEL_CLASSES)
COLUMNS = (*META, *STATIC, *SEASONAL, *HARD, *SOFT)


def soft_vector(distribution: str) -> Column:
    """Shares of all classes in order, from a map of shares: outside classes count as other, the sum is 1 where anything is known and 0 elsewhere.

    One array, so that later columns refer to it instead of repeating it.
    """
    pairs = F.transform(F.map_entries(distribution), lambda e: F.struct(F.when(e["key"].isin(*MODEL_CLASSES), e["key"]).otherwise("Otros_cultivos").alias("k"), e["value"].cast("double").alias("v")))
    names = F.array(*[F.lit(c) for c in MODEL_CLASSES])
    sums = F.transform(names, lambda c: F.aggregate(F.filter(pairs, lambda s: s["k"] == c), F.lit(0.0), lambda t, s: t + s["v"]))
    return F.coalesce(vectors.row_normalised(sums), F.array_repeat(F.lit(0.0), len(MODEL_CLASSES)))


def one_hot(kind: Column) -> Column:
    return F.transform(F.array(*[F.lit(c) for c in MODEL_CLASSES]), lambda c: F.when(c == kind, 1.0).otherwise(0.0))


def labelled(cells: DataFrame, monitored: DataFrame, regions: DataFrame, yields: DataFrame) -> DataFrame:
    """Hard and soft labels of cells (cell, semestre, cod_mun, votes, ndvi_max): soft as the array `soft`.

    monitored: (cell, semestre, cultivo, ord), the first crop in order wins.
    regions: (cod_mun, semestre, distribution). yields: (cod_mun, semestre, cultivo, rendimiento).
    A monitored cell keeps its hard label and takes the region's distribution as
    its soft one; a cell of the proxy is wholly unfit.
    """
    first = monitored.groupBy("cell", "semestre").agg(F.min_by("cultivo", "ord").alias("_m"))
    # a row for each region and semester: its vector and dominant class are made once, not for each cell
    dominant = F.get(F.array(*[F.lit(c) for c in MODEL_CLASSES]), first_argmax("_soft"))
    soft = regions.select("cod_mun", "semestre", soft_vector("distribution").alias("_soft")).select("cod_mun", "semestre", "_soft", F.when(vectors.total("_soft") > 0, dominant).alias("_top"))
    df = cells.join(first, ["cell", "semestre"], "left").join(soft, ["cod_mun", "semestre"], "left")
    kind, confidence, source = labels.prioritised(F.col("_m"), F.col("_top"), labels.unfit("votes", "ndvi_max"))
    df = df.select("*", kind.alias("cultivo"), confidence.alias("confianza"), source.alias("fuente"))
    vector = F.when(F.col("fuente") == "noapto_proxy", one_hot(F.lit(UNFIT))).when(F.col("_top").isNull(), one_hot(F.col("_m"))).otherwise(F.col("_soft"))
    rate = yields.select("cod_mun", "semestre", "cultivo", F.col("rendimiento").alias("rendimiento_tha"))
    named = df.withColumn("soft", vector).join(rate, ["cod_mun", "semestre", "cultivo"], "left")
    return named.withColumn("cultivo_id", F.coalesce(class_id("cultivo"), class_id("_top"))).drop("_m", "_soft", "_top")


def derived(df: DataFrame) -> DataFrame:
    """The layers that follow from others of the same cell and semester."""
    sine, cosine = agronomy.aspect_parts("aspecto")
    rain = W.partitionBy("cell", F.substring("semestre", 5, 1))
    std = F.stddev_pop("chirps_acum").over(rain)
    return (
        df.withColumn("piso_termico", agronomy.altitude_class("elevacion")).withColumn("aspecto_sin", sine).withColumn("aspecto_cos", cosine)
        .withColumn("amplitud_termica", agronomy.amplitude("temperatura_max", "temperatura_min"))
        .withColumn("indice_aridez", agronomy.aridity("chirps_acum", "temperatura_media", "temperatura_max", "temperatura_min"))
        .withColumn("anomalia_precip", (F.col("chirps_acum") - F.avg("chirps_acum").over(rain)) / F.when(std.isNotNull(), F.greatest(std, F.lit(1.0))))
    )


def assembled(df: DataFrame, types: dict[str, str] | None = None, ids: bool = True) -> DataFrame:
    """The contract's columns in order, absent ones as typed missing values, rows without any label left out.

    With ids, pixel_id runs on across semesters, which costs a shuffle of all rows; without, it is missing.
    """
    df = df.select(*[c for c in df.columns if c != "soft"], *[F.get("soft", F.lit(i)).alias(c) for i, c in enumerate(SOFT)]) if "soft" in df.columns else df
    have = set(df.columns)
    missing = [F.lit(None).cast((types or {}).get(c, "double")).alias(c) for c in COLUMNS if c not in have and c != "pixel_id"]
    kept = df.select("*", *missing).where(F.length("cultivo") > 0)
    if not ids:
        return kept.withColumn("pixel_id", F.lit(None).cast("long")).select("cell", *COLUMNS)
    block = F.floor(F.col("cell") / 4096)
    counts = kept.groupBy("semestre", block.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("semestre", "_b", (F.sum("_n").over(W.orderBy("semestre", "_b")) - F.col("_n")).alias("_base"))
    nth = F.row_number().over(W.partitionBy("semestre", "_b").orderBy("cell"))
    numbered = kept.withColumn("_b", block).join(before, ["semestre", "_b"]).withColumn("pixel_id", F.col("_base") + nth - 1)
    return numbered.select("cell", *COLUMNS)


def group_columns(columns: Sequence[str]) -> dict[str, str]:
    """Which part of the contract each column belongs to."""
    parts = (("meta", META), ("static", STATIC), ("seasonal", SEASONAL), ("hard", HARD), ("soft", SOFT))
    return {c: next((n for n, p in parts if c in p), "other") for c in columns}
