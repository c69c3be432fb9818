"""End-to-end queries: the polygon ranking, the wide view, files in and out, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import labels
from . import recommend, view
from .registry import REGISTRY_SQL, big, query, r, registry, table

CLASSES = ("Papa", "Cafe", "Maiz", "Mora")
#: Embeddings on a map: x, y from the id, semester from its parity, chances of four classes from the first components.
POLYGON = [[[2.2, 1.3], [17.6, 2.1], [15.4, 17.8], [3.1, 14.9], [2.2, 1.3]]]
EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(POLYGON[0], POLYGON[0][1:], strict=False))


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    scores = F.transform(F.slice("embedding", 1, 4), lambda v: v.cast("double"))
    return e.select("vec_id", F.pmod("vec_id", F.lit(20)).cast("double").alias("x"), F.pmod(F.floor(F.col("vec_id") / 20), F.lit(20)).cast("double").alias("y"), F.when(F.col("label") % 2 == 0, "2024A").otherwise("2023B").alias("semestre"), vectors.softmax(scores, 0.1).alias("soft"), F.abs(F.col("embedding")[4].cast("double")).alias("binary"))


@query(f"""WITH v AS (SELECT vec_id, (vec_id % 20)::DOUBLE AS x, ((vec_id // 20) % 20)::DOUBLE AS y, label, abs(embedding[5]::DOUBLE) AS b, exp(embedding[1]::DOUBLE / 0.1) AS e0, exp(embedding[2]::DOUBLE / 0.1) AS e1, exp(embedding[3]::DOUBLE / 0.1) AS e2, exp(embedding[4]::DOUBLE / 0.1) AS e3 FROM embeddings),
  i AS (SELECT vec_id FROM (SELECT vec_id, count(*) FILTER ((y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (CASE WHEN y2 = y1 THEN 1 ELSE y2 - y1 END)) AS n FROM v, (VALUES {EDGES}) s(x1, y1, x2, y2) WHERE label % 2 = 0 GROUP BY 1) WHERE n % 2 = 1),
  p AS (SELECT unnest(['Papa', 'Cafe', 'Maiz', 'Mora']) AS cultivo, unnest([b / t, e1 / s / t, e2 / s / t, e3 / s / t]) AS p FROM (SELECT *, b + (e1 + e2 + e3) / s AS t FROM (SELECT *, e0 + e1 + e2 + e3 AS s FROM v)) JOIN i USING (vec_id))
  SELECT cultivo, round(avg(p), 6) AS prob_media, round(max(p), 6) AS prob_max, CASE cultivo WHEN 'Papa' THEN '#8B4513' WHEN 'Cafe' THEN '#6F4E37' WHEN 'Maiz' THEN '#FFD700' ELSE '#8B0000' END AS color FROM p GROUP BY 1 ORDER BY 2 DESC""")
def recommend_in_polygon(spark, sf):
    recommend.validated("2024A", POLYGON, ("2023B", "2024A"))
    inside = recommend.pixels(_pixels(spark, sf), "2024A", POLYGON)
    chances = recommend.combined(inside, lambda d, kept: d.select("vec_id", F.col("soft").alias("p"), kept), 0, F.col("binary"), "vec_id")
    out = recommend.ranked(chances, CLASSES)
    return out.select("cultivo", r("prob_media").alias("prob_media"), r("prob_max").alias("prob_max"), "color")


def _view(spark: SparkSession, sf_dir: str, ids: bool = True) -> DataFrame:
    """The wide view on the tables: a cell is a customer, a region a nation, a monitored crop an urgent order."""
    reg = registry(spark, sf_dir).withColumn("cultivo", F.when(F.col("cultivo") == "BUILDING", "Papa").when(F.col("cultivo") == "MACHINERY", "Cafe").otherwise(F.col("cultivo")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    full = reg.join(orders, "o_orderkey")
    cells = full.groupBy(F.col("o_custkey").alias("cell"), "semestre", F.lpad(F.col("mun").cast("string"), 5, "0").alias("cod_mun")).agg(
        F.count(F.lit(1)).alias("votes"), (F.avg("o_totalprice") / 1_000_000).alias("ndvi_max"), F.sum("o_totalprice").alias("chirps_acum"),
        (F.max("o_totalprice") / 10000).alias("temperatura_max"), (F.min("o_totalprice") / 10000).alias("temperatura_min"), (F.avg("o_totalprice") / 10000).alias("temperatura_media"))
    cells = cells.withColumn("elevacion", (F.col("cell") % 4000).cast("double")).withColumn("aspecto", (F.col("cell") % 361 - 1).cast("double"))
    monitored = full.where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("cell"), "semestre", "cultivo", F.col("o_orderkey").alias("ord"))
    shared = labels.shares(reg.withColumn("cod_mun", F.lpad(F.col("mun").cast("string"), 5, "0")), ["cod_mun", "semestre"], "cultivo", "area", [F.median("area").alias("rendimiento")])
    regions = labels.as_map(shared.where("cod_mun < '00015'"), ["cod_mun", "semestre"], "cultivo")  # the last regions report nothing
    return view.assembled(view.derived(view.labelled(cells, monitored, regions, shared)), {"cod_mun": "string"}, ids)


@query(f"""WITH g AS (SELECT *, CASE cultivo WHEN 'BUILDING' THEN 'Papa' WHEN 'MACHINERY' THEN 'Cafe' ELSE cultivo END AS c FROM {REGISTRY_SQL}),
  cells AS (SELECT o_custkey AS cell, semestre, mun, count(*) AS votes, avg(area) / 1000000 AS ndvi FROM g GROUP BY ALL),
  mon AS (SELECT g.o_custkey AS cell, semestre, arg_min(c, o_orderkey) AS m FROM g JOIN orders o USING (o_orderkey) WHERE o.o_orderpriority LIKE '1%' GROUP BY ALL),
  sh AS (SELECT mun, semestre, CASE WHEN c IN ('Papa', 'Cafe') THEN c ELSE 'Otros_cultivos' END AS k, sum(area) AS a FROM g WHERE mun < 15 GROUP BY ALL),
  top AS (SELECT mun, semestre, k FROM sh QUALIFY row_number() OVER (PARTITION BY mun, semestre ORDER BY a DESC, CASE k WHEN 'Papa' THEN 0 WHEN 'Cafe' THEN 2 ELSE 18 END) = 1)
  SELECT semestre, fuente, cultivo, count(*)::BIGINT AS n FROM (SELECT semestre, coalesce(m, k, CASE WHEN votes >= 3 OR ndvi < 0.15 THEN 'No_apto' END) AS cultivo, CASE WHEN m IS NOT NULL THEN 'monitoreo' WHEN k IS NOT NULL THEN 'eva_municipal' ELSE 'noapto_proxy' END AS fuente FROM cells LEFT JOIN mon USING (cell, semestre) LEFT JOIN top USING (mun, semestre)) WHERE cultivo IS NOT NULL GROUP BY ALL""")
def minable_view_labels(spark, sf):
    return _view(spark, sf, False).groupBy("semestre", "fuente", "cultivo").agg(big(F.count(F.lit(1))).alias("n"))


@query(None)
def minable_view(spark, sf):
    return _view(spark, sf).drop("cell")


@query("SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS start, count(value)::BIGINT AS n, round(avg(value), 6) AS mean, max(value) AS max FROM events GROUP BY ALL")
def daily_windows(spark, sf):
    """The batch form of the streaming aggregate: the same plan over a table."""
    from ..streaming.windows import tumbling

    out = tumbling(table(spark, sf, "events"), ["event_type"])
    return out.select("event_type", "start", big("n").alias("n"), r("mean").alias("mean"), "max")


@query("SELECT semestre, '{\"' || string_agg(cultivo || '\":' || n, ',\"' ORDER BY cultivo) || '}' AS value FROM (SELECT semestre, cultivo, count(*) AS n FROM " + REGISTRY_SQL + " GROUP BY ALL) GROUP BY 1")
def json_catalogues(spark, sf):
    g = registry(spark, sf).groupBy("semestre", "cultivo").agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy("semestre").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cultivo", "n"))))).alias("value"))
