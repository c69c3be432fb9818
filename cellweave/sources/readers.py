"""Files of the engine's inputs: registries, stations, polygons, catalogues, file names, the wide view.

Text sources are read with all columns as strings and coerced, so that one bad
value is a missing value and not a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import crop_class, first_alias
from ..functions.semantics import number, valid, zero_padded

REGISTRY = ("cod_mun", "year", "cultivo", "rendimiento", "area_cosechada", "area_sembrada", "ciclo")
# Column names of the two registries, in the order of REGISTRY.
NEW_COLUMNS = ("c_digo_dane_municipio", "a_o", "cultivo", "rendimiento", "rea_cosechada", "rea_sembrada", "ciclo_del_cultivo")
OLD_COLUMNS = ("c_d_mun", "a_o", "cultivo", "rendimiento_t_ha", "rea_cosechada_ha", "rea_sembrada_ha", "ciclo_de_cultivo")


def text_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with a header, all columns strings; gzip by extension, globs and lists welcome."""
    return spark.read.csv(path, header=True, inferSchema=False)


def registry(spark: SparkSession, path: str | list[str], columns: Sequence[str], cycle: str = "Transitorio") -> DataFrame:
    """One registry under the common names: codes padded to five digits, numbers coerced, a missing cycle column filled."""
    raw = text_table(spark, path)
    have = {c.lower(): c for c in raw.columns}
    at = [F.col(have[c]) if c in have else F.lit(None).cast("string") for c in columns]
    kinds = [zero_padded(at[0]), at[1].try_cast("int"), at[2], *[x.try_cast("double") for x in at[3:6]], F.coalesce(at[6], F.lit(cycle))]
    return raw.select(*[k.alias(n) for k, n in zip(kinds, REGISTRY, strict=True)])


def registries(new: DataFrame, old: DataFrame) -> DataFrame:
    """Both registries, each year's row once for each half-year, crops classified."""
    both = new.unionByName(old)
    return both.select("*", F.explode(F.array(F.lit("A"), F.lit("B"))).alias("_half")).withColumn("semestre", F.concat(F.col("year").cast("string"), "_half")).withColumn("cultivo_norm", crop_class("cultivo")).drop("_half")


def stations(spark: SparkSession, path: str | list[str], nodata: Sequence[float] = (-9999.0,)) -> DataFrame:
    """(code, ts, value, lat, lon, altitude): observations; an absent altitude column is missing."""
    raw = text_table(spark, path)
    has = lambda c: number(F.col(c)) if c in raw.columns else F.lit(None).cast("double")
    return raw.select(F.col("codigoestacion").alias("code"), F.try_to_timestamp("fechaobservacion").alias("ts"), valid(has("valorobservado"), nodata).alias("value"), has("latitud").alias("lat"), has("longitud").alias("lon"), has("altitud").alias("altitude"))


def month_window(c: str, year: int, month: int, quirk: bool = False) -> Column:
    """Half-open [first, next month); the quirk ends at midnight of the last day, which loses that day."""
    first = f"{year:04d}-{month:02d}-01"
    after = f"add_months(date'{first}', 1)" if not quirk else f"last_day(date'{first}')"
    return F.expr(f"{c} >= timestamp'{first}' and {c} < {after}")


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, type, coordinates): features of GeoJSON files, coordinates as JSON text to be parsed by polygons()."""
    docs = spark.read.text(path, wholetext=True)
    feature = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
    rows = docs.select(F.input_file_name().alias("file"), F.from_json("value", f"struct<features:array<{feature}>>").alias("c")).select("file", F.explode("c.features").alias("f"))
    return rows.select("file", "f.properties", F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("coordinates"))


def polygons(features: DataFrame) -> DataFrame:
    """Adds rings: the polygon's rings, or those of all parts of a multipolygon."""
    one = F.from_json("coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    return features.withColumn("rings", F.when(F.col("type") == "Polygon", one).when(F.col("type") == "MultiPolygon", many))


def municipalities(features: DataFrame, department: str = "25", name: str = "CUNDINAMARCA") -> DataFrame:
    """(cod_dane, cod_dpto, nombre_dpto, nombre_mpio, rings) of one department, whatever the source calls its fields."""
    p = "properties"
    code = first_alias(p, ["MpCodigo", "MPIO_CDPMP", "mpio_ccnct", "cod_dane"])
    dept = F.coalesce(first_alias(p, ["DPTO_CCDGO", "cod_dpto"]), F.substring(zero_padded(code), 1, 2))
    dept_name, town = first_alias(p, ["Depto", "DPTO_CNMBR", "nombre_dpto"]), first_alias(p, ["MpNombre", "MPIO_CNMBR", "nombre_mpio"])
    keep = (dept == department) | F.startswith(zero_padded(code), F.lit(department)) | F.contains(F.upper(dept_name), F.lit(name))
    return features.where(F.coalesce(keep, F.lit(False))).select(zero_padded(code).alias("cod_dane"), dept.alias("cod_dpto"), dept_name.alias("nombre_dpto"), town.alias("nombre_mpio"), "rings")


def json_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(name, id) of a JSON object file."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,int>")).alias("name", "id"))


def points(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def view(spark: SparkSession, path: str) -> DataFrame:
    """The wide view; partitioned by semester, so a semester filter reads one folder."""
    return spark.read.parquet(path)


def monitored(file: Column) -> tuple[Column, Column]:
    """(crop, semester label) of monitoreo_<crop>_<year>[_s1|_s2].geojson; a name without half stands for A."""
    stem = F.regexp_extract(file, r"monitoreo_(.+?)_(\d{4})(?:_s([12]))?\.geojson$", 1)
    year = F.regexp_extract(file, r"monitoreo_(.+?)_(\d{4})(?:_s([12]))?\.geojson$", 2)
    half = F.regexp_extract(file, r"monitoreo_(.+?)_(\d{4})(?:_s([12]))?\.geojson$", 3)
    ok = stem != ""
    return F.when(ok, stem), F.when(ok, F.concat(year, F.when(half == "2", "B").otherwise("A")))


def month_of(file: Column) -> Column:
    """YYYY_MM in a file name."""
    found = F.regexp_extract(file, r"(\d{4}_\d{2})", 1)
    return F.when(found != "", found)


def landed(spark: SparkSession, path: str) -> int:
    """Rows already written to a folder, from which an interrupted load goes on; 0 if there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0
