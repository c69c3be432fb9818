"""Queries on regional shares, weak labels and time."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..functions.semantics import half_year, nan_sum
from ..operators import labels, temporal
from .registry import CHANCES_SQL, REGISTRY_SQL, big, chances, query, r, registry, table

SHARES_SQL = f"""(SELECT mun, semestre, cultivo, area, CASE WHEN sum(area) OVER (PARTITION BY mun, semestre) > 0 THEN area / sum(area) OVER (PARTITION BY mun, semestre) ELSE 0 END AS share, mid
  FROM (SELECT mun, semestre, cultivo, sum(area) AS area, median(area) AS mid FROM {REGISTRY_SQL} GROUP BY ALL))"""
DOMINANT_SQL = f"(SELECT * FROM {SHARES_SQL} QUALIFY row_number() OVER (PARTITION BY mun, semestre ORDER BY area DESC, cultivo) = 1)"


def regional(spark, sf):
    return labels.shares(registry(spark, sf), ["mun", "semestre"], "cultivo", "area", [F.median("area").alias("mid")])


@query(f"SELECT mun, semestre, cultivo, round(area, 2) AS area, round(share, 6) AS share, round(mid, 4) AS mid FROM {SHARES_SQL}")
def share_by_group(spark, sf):
    return regional(spark, sf).select("mun", "semestre", "cultivo", r("area", 2).alias("area"), r("share").alias("share"), r("mid", 4).alias("mid"))


@query(f"SELECT mun, semestre, cultivo, round(area, 2) AS area, round(share, 6) AS share FROM {DOMINANT_SQL}")
def dominant_class(spark, sf):
    return labels.dominant(regional(spark, sf), ["mun", "semestre"], "cultivo").select("mun", "semestre", "cultivo", r("area", 2).alias("area"), r("share").alias("share"))


@query(f"SELECT mun, semestre, cultivo, round(share, 6) AS share FROM {SHARES_SQL} WHERE share > 0 AND cultivo <> 'No_apto'")
def dist_map(spark, sf):
    maps = labels.as_map(regional(spark, sf), ["mun", "semestre"], "cultivo")
    return maps.select("mun", "semestre", F.explode("distribution").alias("cultivo", "share")).select("mun", "semestre", "cultivo", r("share").alias("share"))


@query(f"SELECT round(avg(k), 6) AS mean_size, max(k)::BIGINT AS max_size FROM (SELECT mun, semestre, count(*) AS k FROM {SHARES_SQL} WHERE share > 0 GROUP BY ALL)")
def mean_map_size(spark, sf):
    maps = labels.as_map(regional(spark, sf), ["mun", "semestre"], "cultivo")
    return maps.agg(r(F.avg(F.size("distribution"))).alias("mean_size"), big(F.max(F.size("distribution"))).alias("max_size"))


@query(f"""SELECT o_orderkey, d.cultivo AS dominante, coalesce(round(y.mid, 4), -1.0) AS rendimiento FROM {REGISTRY_SQL} p JOIN {DOMINANT_SQL} d USING (mun, semestre)
  LEFT JOIN (SELECT mun, semestre, cultivo, mid FROM {SHARES_SQL} WHERE share > 0.25) y ON y.mun = p.mun AND y.semestre = p.semestre AND y.cultivo = d.cultivo""")
def distribution_lookup(spark, sf):
    pixels, shared = registry(spark, sf), regional(spark, sf)
    top = labels.dominant(shared, ["mun", "semestre"], "cultivo").select("mun", "semestre", F.col("cultivo").alias("dominante"))
    rate = shared.where("share > 0.25").select("mun", "semestre", F.col("cultivo").alias("dominante"), "mid")
    return pixels.join(top, ["mun", "semestre"]).join(rate, ["mun", "semestre", "dominante"], "left").select("o_orderkey", "dominante", F.coalesce(r("mid", 4), F.lit(-1.0)).alias("rendimiento"))


CROPS = ("Papa criolla", "Tomate de árbol", "Tomate chonto", "Habichuela", "Haba", "Cebolla de rama", "Trigo", "CAÑA panelera", "Café", "Plátano hartón", "  Limón tahití", "Otros cítricos", "Ajo", "Pimentón", "Ñame")
NAMES_SQL = "(SELECT p_partkey, CASE WHEN p_partkey % 16 = 15 THEN NULL ELSE [" + ", ".join(f"'{c}'" for c in CROPS) + "][(p_partkey % 16) + 1] END AS raw FROM part)"


@query(f"SELECT p_partkey, CASE {' '.join(f'''WHEN n LIKE '{p}%' THEN '{k}' ''' for p, k in names.PREFIX_RULES)} ELSE 'Otros_cultivos' END AS cultivo FROM (SELECT p_partkey, strip_accents(lower(trim(raw))) AS n FROM {NAMES_SQL})")
def accent_prefix_class(spark, sf):
    raw = F.get(F.array(*[F.lit(c) for c in CROPS]), F.pmod("p_partkey", F.lit(16)).cast("int"))
    return table(spark, sf, "part").select("p_partkey", names.crop_class(raw).alias("cultivo"))


CATALOGUE_SQL = "list_position([" + ", ".join(f"'{c}'" for c in names.MODEL_CLASSES) + f"], %s) - 1"


@query(f"""SELECT p_partkey, coalesce({CATALOGUE_SQL % "raw"}, {CATALOGUE_SQL % "soft"})::INT AS cultivo_id, coalesce(CASE WHEN {CATALOGUE_SQL % "raw"} IS NOT NULL THEN raw END, 'Otros_cultivos') AS cultivo
  FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Papa' WHEN 1 THEN p_type ELSE NULL END AS raw, ['Mora', 'Yuca'][(p_partkey % 2) + 1] AS soft FROM part)""")
def class_map_fallback(spark, sf):
    raw = F.expr("case pmod(p_partkey, 3) when 0 then 'Papa' when 1 then p_type end")
    soft = F.get(F.array(F.lit("Mora"), F.lit("Yuca")), F.pmod("p_partkey", F.lit(2)).cast("int"))
    part = table(spark, sf, "part").select("p_partkey", raw.alias("raw"), soft.alias("soft"))
    return part.select("p_partkey", F.coalesce(names.class_id("raw"), names.class_id("soft")).alias("cultivo_id"), names.in_catalogue(F.coalesce("raw", F.lit("none"))).alias("cultivo"))


#: labels = monitoring, the source's most frequent language = regional class, length and rule = unfit proxy.
LABELLED_SQL = """(SELECT d.doc_id, d.source, d.n_chars, CASE WHEN l.quality = 1 THEN d.lang END AS monitored, CASE WHEN d.n_chars > 1500 THEN t.lang END AS regional,
  (d.n_chars // 200) AS votes, CASE WHEN d.doc_id % 5 <> 0 THEN (d.doc_id % 100) / 100.0::DOUBLE END AS ndvi
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  LEFT JOIN (SELECT source, lang FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) = 1) t ON d.source = t.source)"""


def labelled(spark, sf):
    docs, known = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars"), table(spark, sf, "labels").select("doc_id", "quality")
    counts = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    top = labels.dominant(counts, ["source"], "lang", "n").select("source", F.col("lang").alias("top"))
    return docs.join(known, "doc_id", "left").join(top, "source", "left").select(
        "doc_id", "source", "n_chars", F.when(F.col("quality") == 1, F.col("lang")).alias("monitored"), F.when(F.col("n_chars") > 1500, F.col("top")).alias("regional"),
        F.floor(F.col("n_chars") / 200).alias("votes"), F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") % 100) / 100.0).alias("ndvi"))


UNFIT_SQL = "(coalesce(votes >= 3, false) OR coalesce(ndvi < 0.15, false))"


@query(f"""SELECT doc_id, coalesce(monitored, regional, CASE WHEN {UNFIT_SQL} THEN 'No_apto' END) AS cultivo,
  CASE WHEN monitored IS NOT NULL THEN 1.0 WHEN regional IS NOT NULL THEN 0.7 WHEN {UNFIT_SQL} THEN 0.4 ELSE 0.0 END::DOUBLE AS confianza,
  CASE WHEN monitored IS NOT NULL THEN 'monitoreo' WHEN regional IS NOT NULL THEN 'eva_municipal' WHEN {UNFIT_SQL} THEN 'noapto_proxy' END AS fuente,
  CASE WHEN monitored IS NOT NULL THEN 1.0 WHEN regional IS NOT NULL THEN 0.7 ELSE 0.0 END::DOUBLE AS peso_oro FROM {LABELLED_SQL}""")
def priority_label(spark, sf):
    rows = labelled(spark, sf)
    kind, confidence, source = labels.prioritised(F.col("monitored"), F.col("regional"), labels.unfit("votes", "ndvi"))
    return rows.select("doc_id", kind.alias("cultivo"), confidence.alias("confianza"), source.alias("fuente")).withColumn("peso_oro", F.coalesce(labels.gold_weight("fuente"), F.lit(0.0)))


@query(f"SELECT doc_id, {UNFIT_SQL} AS no_apto FROM {LABELLED_SQL} WHERE monitored IS NULL")
def unfit_unlabelled(spark, sf):
    rows = labelled(spark, sf)
    marked = rows.where("monitored is not null").select("doc_id")
    return rows.join(marked, "doc_id", "left_anti").select("doc_id", labels.unfit("votes", "ndvi").alias("no_apto"))


@query(f"SELECT coalesce(fuente, 'ninguna') AS fuente, count(*)::BIGINT AS n, round(avg(confianza), 6) AS media FROM (SELECT CASE WHEN monitored IS NOT NULL THEN 'monitoreo' WHEN regional IS NOT NULL THEN 'eva_municipal' WHEN {UNFIT_SQL} THEN 'noapto_proxy' END AS fuente, CASE WHEN monitored IS NOT NULL THEN 1.0 WHEN regional IS NOT NULL THEN 0.7 WHEN {UNFIT_SQL} THEN 0.4 ELSE 0 END::DOUBLE AS confianza FROM {LABELLED_SQL}) GROUP BY 1")
def source_confidence(spark, sf):
    return priority_label(spark, sf).groupBy(F.coalesce("fuente", F.lit("ninguna")).alias("fuente")).agg(big(F.count(F.lit(1))).alias("n"), r(F.avg("confianza")).alias("media"))


@query("""WITH e AS (SELECT vec_id, k, p, 0.7::DOUBLE AS c FROM (SELECT vec_id, unnest(['a', 'b', 'c']) AS k, unnest([p0, p1, p2]) AS p FROM CHANCES) WHERE p > 0.05),
  b AS (SELECT k, (SELECT count(*) FROM e) / ((SELECT count(DISTINCT k) FROM e) * count(*))::DOUBLE AS w FROM e GROUP BY k)
  SELECT vec_id, k AS kind, round(p, 6) AS p, round(p * c * w, 6) AS weight FROM e JOIN b USING (k)""".replace("CHANCES", CHANCES_SQL))
def soft_expand(spark, sf):
    wide = chances(spark, sf).select("vec_id", F.lit(0.7).alias("conf"), *[F.col("p")[i].alias(f"prob_{k}") for i, k in enumerate("abc")])
    return labels.expanded(wide, ["vec_id"], {k: f"prob_{k}" for k in "abc"}, "conf").select("vec_id", "kind", r("p").alias("p"), r("weight").alias("weight"))


@query("""SELECT * FROM (SELECT lpad(c_nationkey::VARCHAR, 5, '0') AS cod_mun, c_mktsegment AS cultivo, c_acctbal AS area, s AS semestre FROM customer, (VALUES ('A'), ('B')) v(s)
  UNION ALL SELECT lpad(s_nationkey::VARCHAR, 5, '0'), 'Transitorio', s_acctbal, s FROM supplier, (VALUES ('A'), ('B')) v(s))""")
def registry_union(spark, sf):
    from ..functions.semantics import zero_padded

    new = table(spark, sf, "customer").select(zero_padded("c_nationkey").alias("cod_mun"), F.col("c_mktsegment").alias("cultivo"), F.col("c_acctbal").alias("area"))
    old = table(spark, sf, "supplier").select(zero_padded("s_nationkey").alias("cod_mun"), F.lit("Transitorio").alias("cultivo"), F.col("s_acctbal").alias("area"))
    return new.unionByName(old).withColumn("semestre", F.explode(F.array(F.lit("A"), F.lit("B"))))


MONTHLY_SQL = "(SELECT user_id % 50 AS cell, year(ts) AS y, month(ts) AS m, year(ts)::VARCHAR || CASE WHEN month(ts) <= 6 THEN 'A' ELSE 'B' END AS semestre, day(ts) AS d, event_type AS band, nullif(value, 0) AS value FROM events)"


def monthly(spark, sf):
    e = table(spark, sf, "events")
    return e.select((F.col("user_id") % 50).alias("cell"), F.year("ts").alias("y"), F.month("ts").alias("m"), half_year("ts").alias("semestre"), F.dayofmonth("ts").alias("d"), F.col("event_type").alias("band"), F.nullif(F.col("value"), F.lit(0.0)).alias("value"))


@query(f"SELECT cell, semestre, round(avg(value), 6) AS media, max(value) AS maximo, min(value) AS minimo, round(coalesce(sum(value), 0), 4) AS acum FROM {MONTHLY_SQL} WHERE (semestre) IN (SELECT semestre FROM {MONTHLY_SQL} GROUP BY semestre HAVING count(DISTINCT d) >= 3) GROUP BY ALL")
def semester_agg(spark, sf):
    rows = temporal.supported(monthly(spark, sf), [], "semestre", "d", 3)
    return rows.groupBy("cell", "semestre").agg(r(F.avg("value")).alias("media"), F.max("value").alias("maximo"), F.min("value").alias("minimo"), r(nan_sum("value"), 4).alias("acum"))


@query(f"SELECT cell, semestre, " + ", ".join(f"round(avg(value) FILTER (band = '{b}'), 6) AS {b}_media, max(value) FILTER (band = '{b}') AS {b}_max, round(stddev_pop(value) FILTER (band = '{b}'), 6) AS {b}_std" for b in ("click", "view")) + f" FROM {MONTHLY_SQL} GROUP BY ALL")
def semester_bands(spark, sf):
    at = lambda b: F.when(F.col("band") == b, F.col("value"))
    return monthly(spark, sf).groupBy("cell", "semestre").agg(*[x for b in ("click", "view") for x in (r(F.avg(at(b))).alias(f"{b}_media"), F.max(at(b)).alias(f"{b}_max"), r(F.stddev_pop(at(b))).alias(f"{b}_std"))])


@query(f"SELECT cell, semestre, max(value) AS ndvi_max, round(coalesce(sum(value), 0) * 30, 3) AS ndvi_integral FROM {MONTHLY_SQL} GROUP BY ALL HAVING count(DISTINCT d) >= 2")
def ndvi_max_integral(spark, sf):
    g = monthly(spark, sf).groupBy("cell", "semestre").agg(F.max("value").alias("ndvi_max"), r(nan_sum("value") * 30, 3).alias("ndvi_integral"), F.count_distinct("d").alias("_d"))
    return g.where("_d >= 2").drop("_d")


RAIN_SQL = "(SELECT l_suppkey AS cell, year(l_shipdate) AS y, CASE WHEN month(l_shipdate) <= 6 THEN 'A' ELSE 'B' END AS tipo, sum(l_quantity) AS rain FROM lineitem GROUP BY ALL)"


def rain(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("cell"), F.year("l_shipdate").alias("y"), F.when(F.month("l_shipdate") <= 6, "A").otherwise("B").alias("tipo")).agg(F.sum("l_quantity").alias("rain"))


@query(f"SELECT cell, y, tipo, round((rain - avg(rain) OVER w) / greatest(stddev_pop(rain) OVER w, 1.0), 6) + 0.0 AS z FROM {RAIN_SQL} WINDOW w AS (PARTITION BY cell, tipo)")
def anomaly_z(spark, sf):
    return rain(spark, sf).select("cell", "y", "tipo", r(temporal.anomaly("rain", ["cell", "tipo"])).alias("z"))


@query(f"SELECT cell, round(stddev_pop(rain), 6) AS sigma, round(avg(rain), 6) AS mean, count(rain)::BIGINT AS n FROM {RAIN_SQL} GROUP BY cell HAVING count(rain) >= 2")
def temporal_sigma(spark, sf):
    return temporal.spread_over_time(rain(spark, sf), ["cell"], "rain").select("cell", r("sigma").alias("sigma"), r("mean").alias("mean"), big("n").alias("n"))


@query("SELECT o_custkey, max(o_totalprice) AS best FROM (SELECT o_custkey, o_totalprice, dense_rank() OVER (ORDER BY year(o_orderdate) * 4 + quarter(o_orderdate) DESC) AS k FROM orders) WHERE k <= 4 GROUP BY 1")
def last4_max(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("q"))
    return temporal.latest(o, ["o_custkey"], "q", "o_totalprice").withColumnRenamed("o_totalprice", "best")


DAILY_SQL = f"(SELECT cell, y * 10000 + m * 100 + d AS day, CASE WHEN (cell + d) % 3 = 0 THEN NULL ELSE round(avg(value), 6) END AS v FROM {MONTHLY_SQL} GROUP BY cell, y, m, d)"


@query(f"""SELECT cell, day, round(coalesce(v, (last_value(v IGNORE NULLS) OVER b + first_value(v IGNORE NULLS) OVER a) / 2, last_value(v IGNORE NULLS) OVER b, first_value(v IGNORE NULLS) OVER a), 8) AS v FROM {DAILY_SQL}
  WINDOW b AS (PARTITION BY cell ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY cell ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""")
def interp_gaps(spark, sf):
    daily = monthly(spark, sf).groupBy("cell", "y", "m", "d").agg(F.avg("value").alias("_v"))
    rows = daily.select("cell", (F.col("y") * 10000 + F.col("m") * 100 + F.col("d")).cast("bigint").alias("day"), F.when((F.col("cell") + F.col("d")) % 3 != 0, r("_v")).alias("v"))
    return rows.select("cell", "day", r(temporal.filled("v", ["cell"], "day"), 8).alias("v"))


@query("SELECT user_id, event_type, year(ts)::INT AS y, month(ts)::INT AS m, round(median(value), 6) AS med FROM events WHERE user_id IS NOT NULL GROUP BY ALL")
def median_station(spark, sf):
    e = table(spark, sf, "events").where("user_id is not null")
    return e.groupBy("user_id", "event_type", F.year("ts").alias("y"), F.month("ts").alias("m")).agg(r(F.median("value")).alias("med"))


@query("SELECT l_suppkey AS cell, strftime(l_shipdate, '%Y_%m') AS month_label, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY ALL")
def monthly_totals(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), F.date_format("l_shipdate", "yyyy_MM").alias("month_label")).agg(r(F.sum("l_quantity"), 2).alias("total"))


@query("""SELECT strftime(d, '%Y_%m') AS month_label FROM generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH) t(d)
  WHERE strftime(d, '%Y_%m') NOT IN (SELECT strftime(o_orderdate, '%Y_%m') FROM orders WHERE o_totalprice > 480000)""")
def missing_months(spark, sf):
    found = table(spark, sf, "orders").where("o_totalprice > 480000").select(F.date_format("o_orderdate", "yyyy_MM").alias("month_label")).distinct()
    return temporal.calendar(spark, 1992, 1998).select("month_label").join(found, "month_label", "left_anti")


@query("SELECT o_orderpriority AS variable, count(DISTINCT strftime(o_orderdate, '%Y_%m'))::BIGINT AS encontrados, 84::BIGINT AS esperados, round(count(DISTINCT strftime(o_orderdate, '%Y_%m')) * 100.0::DOUBLE / 84, 6) AS cobertura_pct FROM orders WHERE o_totalprice > 450000 AND year(o_orderdate) BETWEEN 1992 AND 1998 GROUP BY 1")
def monthly_coverage(spark, sf):
    """Months found of those expected, in percent, for each variable."""
    month = F.date_format("o_orderdate", "yyyy_MM")
    found = table(spark, sf, "orders").where((F.col("o_totalprice") > 450000) & F.year("o_orderdate").between(1992, 1998)).groupBy(F.col("o_orderpriority").alias("variable")).agg(big(F.count_distinct(month)).alias("encontrados"))
    return found.select("variable", "encontrados", big(F.lit(84)).alias("esperados"), r(F.col("encontrados") * 100.0 / 84).alias("cobertura_pct"))


@query(f"SELECT semestre, cultivo, round(median(rend), 4) AS rendimiento FROM (SELECT mun, semestre, cultivo, median(area) AS rend FROM {REGISTRY_SQL} GROUP BY ALL) GROUP BY ALL")
def regional_yield(spark, sf):
    """The median over regions of a class's yield in a semester, as monitored cells take it."""
    by_region = registry(spark, sf).groupBy("mun", "semestre", "cultivo").agg(F.median("area").alias("rend"))
    return by_region.groupBy("semestre", "cultivo").agg(r(F.median("rend"), 4).alias("rendimiento"))


@query("""SELECT strftime(d, '%Y_%m') AS month_label, year(d)::VARCHAR || CASE WHEN month(d) <= 6 THEN 'A' ELSE 'B' END AS semestre, day(last_day(d))::INT AS days FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2024-06-01', INTERVAL 1 MONTH) t(d)""")
def month_calendar(spark, sf):
    return temporal.calendar(spark, 2020, 2024, False).select("month_label", F.col("semester").alias("semestre"), F.col("days").cast("int").alias("days"))


@query(f"SELECT semestre, count(*)::BIGINT AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM {REGISTRY_SQL} GROUP BY 1")
def rows_per_semester(spark, sf):
    g = registry(spark, sf).groupBy("semestre").agg(big(F.count(F.lit(1))).alias("n"))
    return g.select("semestre", "n", r(F.col("n") * 100.0 / F.sum("n").over(W.partitionBy())).alias("pct"))


@query(f"SELECT semestre, o_orderkey, (row_number() OVER (ORDER BY semestre, o_orderkey) - 1)::BIGINT AS pixel_id FROM {REGISTRY_SQL}")
def sequential_ids(spark, sf):
    """Ids that run on across semesters: a number within the semester plus the rows of the earlier ones, so no task sees the whole table."""
    rows = registry(spark, sf).select("semestre", "o_orderkey")
    block = F.floor(F.col("o_orderkey") / 4096)
    counts = rows.groupBy("semestre", block.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("semestre", "b", (F.sum("n").over(W.orderBy("semestre", "b")) - F.col("n")).alias("base"))
    nth = F.row_number().over(W.partitionBy("semestre", "b").orderBy("o_orderkey"))
    return rows.withColumn("b", block).join(before, ["semestre", "b"]).select("semestre", "o_orderkey", big(F.col("base") + nth - 1).alias("pixel_id"))


@query("SELECT o_orderkey, min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS best FROM orders")
def running_min(spark, sf):
    w = W.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(W.unboundedPreceding, W.currentRow)
    return table(spark, sf, "orders").select("o_orderkey", F.min("o_totalprice").over(w).alias("best"))


@query("SELECT k AS cultivo FROM (VALUES " + ", ".join(f"('{c}')" for c in names.MODEL_CLASSES) + ") v(k) EXCEPT SELECT CASE WHEN doc_id % 4 = 0 THEN 'Papa' WHEN doc_id % 4 = 1 THEN 'Mora' ELSE 'Yuca' END FROM documents")
def catalogue_missing(spark, sf):
    present = table(spark, sf, "documents").select(F.expr("case pmod(doc_id, 4) when 0 then 'Papa' when 1 then 'Mora' else 'Yuca' end").alias("cultivo"))
    whole = spark.createDataFrame([(c,) for c in names.MODEL_CLASSES], "cultivo string")
    return whole.subtract(present)


@query("SELECT cell, sum(f)::BIGINT AS votes FROM (SELECT l_suppkey AS cell, l_linenumber AS layer, max((l_discount > 0.07)::INT) AS f FROM lineitem GROUP BY ALL) GROUP BY 1")
def layer_votes(spark, sf):
    layers = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), "l_linenumber").agg(F.max((F.col("l_discount") > 0.07).cast("int")).alias("f"))
    return layers.groupBy("cell").agg(big(F.sum("f")).alias("votes"))
