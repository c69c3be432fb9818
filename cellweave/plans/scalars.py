"""Queries on derived layers, names, vectors, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import agronomy, geometry, names, semantics, vectors
from ..operators import statistics
from .registry import CHANCES_SQL, big, chances, query, r, table


@query("""SELECT p_partkey, CASE WHEN e IS NULL THEN NULL WHEN e < 1000 THEN 0 WHEN e < 2000 THEN 1 WHEN e < 3000 THEN 2 ELSE 3 END AS piso,
  CASE WHEN p_size < 5 THEN 0 WHEN p_size < 15 THEN 1 WHEN p_size < 30 THEN 2 ELSE 3 END AS pendiente,
  (coalesce(CASE WHEN e IS NULL THEN NULL WHEN e < 1000 THEN 0 WHEN e < 2000 THEN 1 WHEN e < 3000 THEN 2 ELSE 3 END, -1) * 100 + CASE WHEN p_size < 5 THEN 0 WHEN p_size < 15 THEN 1 WHEN p_size < 30 THEN 2 ELSE 3 END * 10 + (p_partkey % 7 = 0)::INT)::INT AS estrato
  FROM (SELECT *, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice * 2 END AS e FROM part)""")
def altitude_slope_classes(spark, sf):
    p = table(spark, sf, "part").withColumn("e", F.when(F.col("p_partkey") % 11 != 0, F.col("p_retailprice") * 2))
    a, s = agronomy.altitude_class("e"), agronomy.slope_class("p_size")
    return p.select("p_partkey", a.alias("piso"), s.alias("pendiente"), agronomy.stratum(a, s, F.col("p_partkey") % 7 == 0).alias("estrato"))


@query("""SELECT o_custkey, round(tmax - tmin, 6) AS amplitud, round(lluvia / greatest(0.0023::DOUBLE * (tm + 17.8::DOUBLE) * sqrt(greatest(tmax - tmin, 0)) * 15.0::DOUBLE * 182.0::DOUBLE, 1.0::DOUBLE), 6) AS aridez
  FROM (SELECT o_custkey, max(o_totalprice) / 10000 AS tmax, min(o_totalprice) / 10000 AS tmin, avg(o_totalprice) / 10000 AS tm, count(*) * 100.0::DOUBLE AS lluvia FROM orders GROUP BY 1)""")
def amplitude_aridity(spark, sf):
    g = table(spark, sf, "orders").groupBy("o_custkey").agg((F.max("o_totalprice") / 10000).alias("tmax"), (F.min("o_totalprice") / 10000).alias("tmin"), (F.avg("o_totalprice") / 10000).alias("tm"), (F.count(F.lit(1)) * 100.0).alias("rain"))
    return g.select("o_custkey", r(agronomy.amplitude("tmax", "tmin")).alias("amplitud"), r(agronomy.aridity("rain", "tm", "tmax", "tmin")).alias("aridez"))


@query("""WITH q AS (SELECT quantile_cont(p_retailprice, 0.02) AS al, quantile_cont(p_retailprice, 0.98) AS ah, quantile_cont(p_size::DOUBLE, 0.02) AS bl, quantile_cont(p_size::DOUBLE, 0.98) AS bh FROM part)
  SELECT p_partkey, round(greatest(least((p_retailprice - al) / (ah - al), 1), 0), 6) AS precio, round(greatest(least((p_size - bl) / (bh - bl), 1), 0), 6) AS tamano,
  round(0.5::DOUBLE * greatest(least((p_retailprice - al) / (ah - al), 1), 0) + 0.25::DOUBLE * greatest(least((p_size - bl) / (bh - bl), 1), 0) + 0.25::DOUBLE * (1 - greatest(least(abs(p_size / 5.0::DOUBLE - 6.5::DOUBLE) / 3.5::DOUBLE, 1), 0)), 6) AS fertilidad FROM part, q""")
def fertility_index(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size", F.col("p_size").alias("raw"))
    n = statistics.normalised(p, ["p_retailprice", "p_size"])
    whole = 0.5 * F.col("p_retailprice") + 0.25 * F.col("p_size") + 0.25 * agronomy.ph_optimum(F.col("raw") / 5.0)
    return n.select("p_partkey", r("p_retailprice").alias("precio"), r("p_size").alias("tamano"), r(whole).alias("fertilidad"))


@query("""SELECT p_partkey, round(CASE WHEN a IS NULL OR a < 0 THEN 0 ELSE sin(radians(a)) END, 6) + 0.0 AS seno, round(CASE WHEN a IS NULL OR a < 0 THEN 0 ELSE cos(radians(a)) END, 6) + 0.0 AS coseno
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN -1 ELSE (p_partkey * 7 % 360)::DOUBLE END AS a FROM part)""")
def circular_aspect(spark, sf):
    a = F.expr("case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then -1 else cast(p_partkey * 7 % 360 as double) end")
    s, c = agronomy.aspect_parts(F.col("a"))
    return table(spark, sf, "part").select("p_partkey", a.alias("a")).select("p_partkey", r(s).alias("seno"), r(c).alias("coseno"))


@query("""SELECT p_partkey, round(CASE WHEN (SELECT max(p_size * 1.9::DOUBLE) FROM part) BETWEEN 90.0000001 AND 100 THEN tan(radians(p_size * 1.9::DOUBLE)) * 100 ELSE p_size * 1.9::DOUBLE END, 4) AS pct FROM part""")
def slope_units(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 1.9).alias("d"))
    top = p.agg(F.max("d").alias("top"))
    return p.crossJoin(F.broadcast(top)).select("p_partkey", r(agronomy.slope_unified(F.col("d"), F.col("top")), 4).alias("pct"))  # one row


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity / s * 100, 5) AS arcilla, round(l_discount * 100 / s * 100, 5) AS arena, round(l_tax * 100 / s * 100, 5) AS limo
  FROM (SELECT *, l_quantity + l_discount * 100 + l_tax * 100 AS s FROM lineitem)""")
def texture_normalise(spark, sf):
    t = agronomy.texture("l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[r(c, 5).alias(n) for c, n in zip(t, ("arcilla", "arena", "limo"), strict=True)])


@query("SELECT p_partkey, round(CASE WHEN (SELECT avg(p_size) FROM part) > 14 THEN p_size / 10.0::DOUBLE ELSE p_size::DOUBLE END, 6) AS ph FROM part")
def unit_guard(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("raw"))
    mean = p.agg(F.avg("raw").alias("m"))
    return p.crossJoin(F.broadcast(mean)).select("p_partkey", r(F.when(F.col("m") > 14, F.col("raw") / 10.0).otherwise(F.col("raw"))).alias("ph"))  # one row


BANDS = "abs(embedding[1]::DOUBLE), abs(embedding[2]::DOUBLE), abs(embedding[3]::DOUBLE), abs(embedding[4]::DOUBLE), abs(embedding[5]::DOUBLE)"


@query(f"""SELECT vec_id, round((b8-b4)/(b8+b4+1e-10), 5) + 0.0 AS ndvi, round((b8-b3)/(b8+b3+1e-10), 5) + 0.0 AS gndvi, round((b3-b8)/(b3+b8+1e-10), 5) + 0.0 AS ndwi, round((2*b8+1-sqrt((2*b8+1)*(2*b8+1)-8*(b8-b4)))/2, 5) + 0.0 AS msavi,
  round(((b11+b4)-(b8+b2))/((b11+b4)+(b8+b2)+1e-10), 5) + 0.0 AS bsi, round((b8-b4)/(b8+b4+0.5+1e-10)*1.5, 5) + 0.0 AS savi, CASE WHEN abs(e) <= 1 THEN round(e, 5) + 0.0 END AS evi
  FROM (SELECT *, 2.5::DOUBLE*(b8-b4)/(b8+6*b4-7.5::DOUBLE*b2+1+1e-10) AS e FROM (SELECT vec_id, unnest([{{'b2': v[1], 'b3': v[2], 'b4': v[3], 'b8': v[4], 'b11': v[5]}}], recursive := true) FROM (SELECT vec_id, [{BANDS}] AS v FROM embeddings)))""")
def spectral_indices(spark, sf):
    b = [F.abs(F.col("embedding")[i].cast("double")) for i in range(5)]
    found = agronomy.spectral_indices(*b)
    out = {k: semantics.in_range(c, -1.0, 1.0) if k == "evi" else c for k, c in found.items()}
    return table(spark, sf, "embeddings").select("vec_id", *[r(c, 5).alias(k) for k, c in out.items()])


@query("""SELECT l_suppkey, week, coalesce(round(avg(10 * log10(q)) FILTER (ok), 5), 0.0) AS vv, coalesce(round(avg(10 * log10(t)) FILTER (ok), 5), 0.0) AS vh,
  coalesce(round(avg(10 * log10(t)) FILTER (ok) - avg(10 * log10(q)) FILTER (ok), 5), 0.0) AS ratio
  FROM (SELECT l_suppkey, (floor(epoch(l_shipdate) / 604800))::BIGINT AS week, CASE WHEN l_quantity > 0 AND l_tax > 0 THEN l_quantity ELSE 1 END AS q, CASE WHEN l_quantity > 0 AND l_tax > 0 THEN l_tax ELSE 1 END AS t, l_quantity > 0 AND l_tax > 0 AS ok FROM lineitem) GROUP BY ALL""")
def radar_db(spark, sf):
    """Mean decibels of the valid samples of a cell and week; 0 where none is valid."""
    ok = (F.col("l_quantity") > 0) & (F.col("l_tax") > 0)
    mean = lambda c: F.avg(F.when(ok, agronomy.decibel(c)))
    vv, vh = mean("l_quantity"), mean("l_tax")
    week = F.floor(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) / 604800).cast("long").alias("week")
    zero = lambda c, name: F.coalesce(r(c, 5), F.lit(0.0)).alias(name)
    return table(spark, sf, "lineitem").groupBy("l_suppkey", week).agg(zero(vv, "vv"), zero(vh, "vh"), zero(vh - vv, "ratio"))


@query("SELECT l_orderkey, coalesce(round(median(l_extendedprice) FILTER (l_linenumber NOT IN (3, 8, 9, 10) AND l_tax > 0.02), 4), 0.0) AS composite FROM lineitem GROUP BY 1")
def cloud_free_median(spark, sf):
    """Median of the cloud-free samples of a cell; 0 where clouds hide them all."""
    clear = agronomy.cloud_free("l_linenumber") & (F.col("l_tax") > 0.02)
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.coalesce(r(F.median(F.when(clear, F.col("l_extendedprice"))), 4), F.lit(0.0)).alias("composite"))


@query("SELECT o_orderkey, (month(o_orderdate) > 6)::INT AS sem, round(cos(pi() * (month(o_orderdate) > 6)::INT), 6) AS sem_cos, round((year(o_orderdate) - 1992) / 6.0::DOUBLE, 6) AS year_norm FROM orders")
def cyclic_semester(spark, sf):
    half, cos = agronomy.cyclic(semantics.half_year("o_orderdate"))
    year = F.substring(semantics.half_year("o_orderdate"), 1, 4).cast("int")
    return table(spark, sf, "orders").select("o_orderkey", half.alias("sem"), r(cos).alias("sem_cos"), r((year - 1992) / 6.0).alias("year_norm"))


@query("SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) < 5 THEN lpad(c_custkey::VARCHAR, 5, '0') ELSE c_custkey::VARCHAR END AS code, CASE WHEN length((c_custkey * 100003)::VARCHAR) < 5 THEN lpad((c_custkey * 100003)::VARCHAR, 5, '0') ELSE (c_custkey * 100003)::VARCHAR END AS long_code FROM customer")
def zpad_codes(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", semantics.zero_padded("c_custkey").alias("code"), semantics.zero_padded(F.col("c_custkey") * 100003).alias("long_code"))


@query("""SELECT p_partkey, upper(trim(p_brand)) AS marca, replace(lower(p_type), ' ', '_') AS tipo, split_part(p_name, ' ', 1) AS primera, regexp_extract(p_brand, '([0-9]+)', 1) AS numero, try_cast(regexp_extract(p_brand, '([0-9]+)', 1) AS DOUBLE) AS valor,
  try_cast(p_name AS DOUBLE) AS nada, regexp_full_match(p_brand, '[0-9]+') AS es_digito, length(p_name || '|' || p_type)::INT AS largo FROM part""")
def string_parse(spark, sf):
    number = F.regexp_extract("p_brand", "([0-9]+)", 1)
    return table(spark, sf, "part").select(
        "p_partkey", F.upper(F.trim("p_brand")).alias("marca"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")).alias("tipo"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("primera"), number.alias("numero"),
        semantics.number(number).alias("valor"), semantics.number("p_name").alias("nada"), names.all_digits("p_brand").alias("es_digito"), F.length(F.concat_ws("|", "p_name", "p_type")).alias("largo"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity + 0.006::DOUBLE * (l_partkey - 2600), 6) AS base, round(l_quantity + 0.006::DOUBLE * (l_partkey - 2600) - 0.006::DOUBLE * (l_suppkey - 2600), 6) AS local FROM lineitem")
def lapse_rate(spark, sf):
    base = agronomy.lapse("l_quantity", "l_partkey", 2600.0)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(base).alias("base"), r(agronomy.lapse(base, "l_suppkey", 2600.0, -0.006)).alias("local"))


@query("""SELECT l_suppkey, round(stddev_pop(l_quantity) / (abs(avg(l_quantity)) + 1e-9), 6) AS cv, round(greatest(least(avg(l_quantity), 26.0::DOUBLE), 24.0::DOUBLE), 6) AS limitado,
  CASE WHEN avg(l_quantity) > 26 THEN 'alta' WHEN avg(l_quantity) > 25 THEN 'media' WHEN avg(l_quantity) > 24 THEN 'baja' ELSE 'ok' END AS severidad, round((1 - greatest(least((avg(l_quantity) - 20) / 10, 1), 0)) * 240, 4) AS matiz FROM lineitem GROUP BY 1""")
def cv_clip_severity(spark, sf):
    mean = F.avg("l_quantity")
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.stddev_pop("l_quantity").alias("s"), mean.alias("m"))
    return g.select("l_suppkey", r(semantics.coefficient_of_variation(F.col("s"), F.col("m"))).alias("cv"), r(semantics.clip("m", 24.0, 26.0)).alias("limitado"), semantics.severity("m", [(26, "alta"), (25, "media"), (24, "baja")], "ok").alias("severidad"), r(agronomy.heat_hue((F.col("m") - 20) / 10), 4).alias("matiz"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN NULL ELSE value END AS limpio, CASE WHEN event_id % 9 IN (0, 1) THEN -9999.0 ELSE value END::DOUBLE AS exportado FROM events")
def nodata_roundtrip(spark, sf):
    dirty = F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).when(F.col("event_id") % 9 == 1, F.lit(-9999.0)).otherwise(F.col("value"))
    e = table(spark, sf, "events").select("event_id", dirty.alias("v"))
    return e.select("event_id", semantics.valid("v").alias("limpio"), semantics.export("v").alias("exportado"))


@query("SELECT p_type, row_number() OVER (ORDER BY min(p_partkey), p_type)::INT AS code FROM part GROUP BY 1")
def factorise_first_seen(spark, sf):
    return statistics.factorised(table(spark, sf, "part"), "p_type", "p_partkey")


@query("SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand)::INT - 1 AS code FROM part")
def reencode_labels(spark, sf):
    return statistics.encoded(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand").select("p_partkey", "code")


@query("SELECT event_id, try_cast(json_extract(props, '$.k') AS BIGINT) AS k, try_cast(json_extract(props, '$.K') AS BIGINT) IS NULL AS sin_mayuscula FROM events")
def json_alias(spark, sf):
    m = F.from_json("props", "map<string,bigint>")
    e = table(spark, sf, "events").select("event_id", m.alias("m"))
    return e.select("event_id", names.first_alias("m", ["clave", "K"]).alias("k"), F.try_element_at("m", F.lit("K")).isNull().alias("sin_mayuscula"))


@query("SELECT id, name FROM (SELECT unnest(range(20)) AS id, unnest([" + ", ".join(f"'{c}'" for c in names.MODEL_CLASSES) + "]) AS name)")
def catalogue_inverted(spark, sf):
    m = F.create_map(*[x for k, v in names.catalogue().items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    return spark.range(1).select(F.explode(names.inverted(m)).alias("id", "name"))


@query("""SELECT user_id, count(*) FILTER (event_type IN ('click', 'view') AND value >= 0)::BIGINT AS validas, count(*) FILTER (NOT (event_type IN ('click', 'view') AND value >= 0))::BIGINT AS rechazadas FROM events GROUP BY 1""")
def request_validation(spark, sf):
    ok = F.array_contains(F.array(F.lit("click"), F.lit("view")), F.col("event_type")) & (F.col("value") >= 0)
    return table(spark, sf, "events").groupBy("user_id").agg(big(F.count_if(ok)).alias("validas"), big(F.count_if(~ok)).alias("rechazadas"))


@query("""SELECT s_suppkey, round((s_nationkey + (s_nationkey + 4) + (s_nationkey + 4) + s_nationkey) / 4.0::DOUBLE, 6) AS cx, round((s_suppkey + s_suppkey + (s_suppkey + 2) + (s_suppkey + 2)) / 4.0::DOUBLE, 6) AS cy, 5::INT AS puntos, true AS plausible, false AS abierto FROM supplier""")
def ring_centroid(spark, sf):
    at = lambda dx, dy: F.array((F.col("s_nationkey") + dx).cast("double"), (F.col("s_suppkey") + dy).cast("double"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.array(at(0, 0), at(4, 0), at(4, 2), at(0, 2)).alias("ring"))
    cx, cy = geometry.vertex_mean("ring")
    return s.select("s_suppkey", r(cx).alias("cx"), r(cy).alias("cy"), F.size(geometry.closed("ring")).alias("puntos"), geometry.plausible(geometry.closed("ring")).alias("plausible"), geometry.plausible("ring").alias("abierto"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS type, (CASE WHEN n_nationkey % 3 = 1 THEN 1 ELSE 2 END)::INT AS partes FROM nation WHERE n_nationkey % 3 <> 0")
def esri_to_geojson(spark, sf):
    ring = F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))])
    rings = F.array_repeat(ring, F.pmod("n_nationkey", F.lit(3)).cast("int"))
    n = table(spark, sf, "nation").select("n_nationkey", geometry.from_esri(rings).alias("g")).where("g is not null")
    return n.select("n_nationkey", "g.type", F.when(F.col("g.type") == "Polygon", F.size(F.col("g.coordinates"))).otherwise(F.size("g.coordinates")).cast("int").alias("partes"))


@query(f"SELECT vec_id, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, (CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END)::INT AS clase, round(-(p0 * ln(greatest(p0, 1e-9)) + p1 * ln(greatest(p1, 1e-9)) + p2 * ln(greatest(p2, 1e-9))), 6) + 0.0 AS entropia FROM {CHANCES_SQL}")
def softmax_entropy(spark, sf):
    c = chances(spark, sf)
    return c.select("vec_id", *[r(F.col("p")[i]).alias(f"p{i}") for i in range(3)], semantics.first_argmax("p").alias("clase"), r(vectors.entropy("p")).alias("entropia"))


@query("""WITH m AS (SELECT label, list(v ORDER BY i) AS proto FROM (SELECT label, i, avg(x) AS v FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)
  SELECT vec_id, label::INT AS prototipo, round(list_cosine_similarity(embedding::DOUBLE[], proto), 5) AS coseno FROM embeddings JOIN m USING (label)""")
def cosine_prototypes(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", vectors.doubles("embedding").alias("v"))
    means = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    proto = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("proto"))
    return e.join(proto, "label").select("vec_id", F.col("label").alias("prototipo"), r(vectors.cosine("v", "proto"), 5).alias("coseno"))


@query("SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS norma, 1.0::DOUBLE AS norma_unitaria FROM embeddings")
def l2_norm(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", vectors.doubles("embedding").alias("v"))
    return e.select("vec_id", r(vectors.norm("v"), 5).alias("norma"), r(vectors.norm(vectors.unit("v")), 5).alias("norma_unitaria"))


@query(f"SELECT vec_id, round(p0 / (p0 + p1), 6) AS a, round(p1 / (p0 + p1), 6) AS b FROM {CHANCES_SQL}")
def row_normalise(spark, sf):
    c = chances(spark, sf).select("vec_id", vectors.row_normalised(F.slice("p", 1, 2)).alias("q"))
    return c.select("vec_id", r(F.col("q")[0]).alias("a"), r(F.col("q")[1]).alias("b"))


@query("SELECT s AS step, round(CASE WHEN s < 10 THEN 0.001::DOUBLE * (s + 1) / 10 ELSE 0.5::DOUBLE * 0.001::DOUBLE * (1 + cos(pi() * least((s - 10) / 90.0::DOUBLE, 1))) END, 9) + 0.0 AS lr FROM range(120) t(s)")
def warmup_schedule(spark, sf):
    from ..operators.learning import warmup_cosine

    return spark.range(120).select(F.col("id").alias("step"), r(warmup_cosine(F.col("id"), 10, 100, 0.001), 9).alias("lr"))

