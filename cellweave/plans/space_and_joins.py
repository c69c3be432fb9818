"""Queries on grids, polygons, joins, ranks, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import projection
from ..operators import grid, information, sampling
from .registry import CELLS_SQL, CHANCES_SQL, COLUMNS, LAST_ROW_SQL, REGISTRY_SQL, big, cell_rows, cells, chances, query, r, registry, table

@query(f"SELECT a.row, a.col, round(a.value * 2 - a.price / 1000, 5) + 0.0 AS algebra FROM {CELLS_SQL} a")
def raster_algebra(spark, sf):
    c = cells(spark, sf)
    first, second = c.select("row", "col", "value"), c.select("row", "col", "price")
    return first.join(second, ["row", "col"]).select("row", "col", r(F.col("value") * 2 - F.col("price") / 1000, 5).alias("algebra"))


@query(f"SELECT s_suppkey, value, price FROM supplier LEFT JOIN {CELLS_SQL} c ON c.row = s_suppkey % 50 AND c.col = s_nationkey")
def sample_extract(spark, sf):
    pixels = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 50).cast("int").alias("row"), F.col("s_nationkey").alias("col"))
    return pixels.join(cells(spark, sf), ["row", "col"], "left").select("s_suppkey", "value", "price")


@query("SELECT c_custkey, count(o_orderkey)::BIGINT AS pedidos FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def left_lookup_counts(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left").select("c_custkey", big(F.coalesce("n", F.lit(0))).alias("pedidos"))


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS monitored FROM customer")
def monitored_any(spark, sf):
    seen = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    return table(spark, sf, "customer").select("c_custkey").join(seen, "c_custkey", "left").select("c_custkey", F.coalesce("hit", F.lit(False)).alias("monitored"))


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def municipality_semi(spark, sf):
    held = table(spark, sf, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"))
    return table(spark, sf, "customer").join(held, "c_nationkey", "left_semi").select("c_custkey")


@query("SELECT a.l_returnflag AS truth, b.l_linestatus AS predicted, (SELECT count(*) FROM lineitem c WHERE c.l_returnflag = a.l_returnflag AND c.l_linestatus = b.l_linestatus)::BIGINT AS n FROM (SELECT DISTINCT l_returnflag FROM lineitem) a, (SELECT DISTINCT l_linestatus FROM lineitem) b")
def cost_matrix(spark, sf):
    li = table(spark, sf, "lineitem")
    counts = li.groupBy(F.col("l_returnflag").alias("truth"), F.col("l_linestatus").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    # two tables of class names
    whole = li.select(F.col("l_returnflag").alias("truth")).distinct().crossJoin(li.select(F.col("l_linestatus").alias("predicted")).distinct())
    return whole.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", big(F.coalesce("n", F.lit(0))).alias("n"))


@query("SELECT x::DOUBLE AS lon, y::DOUBLE AS lat FROM range(-75, -72) a(x), range(3, 7) b(y)")
def point_grid(spark, sf):
    return spark.range(1).select(F.explode(F.sequence(F.lit(-75), F.lit(-73))).alias("x")).select(F.col("x").cast("double").alias("lon"), F.explode(F.sequence(F.lit(3), F.lit(6))).alias("y")).select("lon", F.col("y").cast("double").alias("lat"))


@query(f"""WITH c AS {CELLS_SQL}, n AS (SELECT a.row, a.col, b.value FROM c a, range(-1, 2) dr(i), range(-1, 2) dc(j), c b WHERE b.row = greatest(0, least({LAST_ROW_SQL}, a.row + i)) AND b.col = greatest(0, least(39, a.col + j)))
  SELECT row, col, median(value) AS med, count(*)::BIGINT AS n FROM n GROUP BY ALL""")
def median3x3(spark, sf):
    return grid.medians(cells(spark, sf).select("row", "col", "value"), cell_rows(spark, sf), COLUMNS)


WINDOW_SQL = f"""(WITH c AS {CELLS_SQL}, n AS (SELECT a.row, a.col, i, j, b.value FROM c a, range(-1, 2) dr(i), range(-1, 2) dc(j), c b WHERE b.row = greatest(0, least({LAST_ROW_SQL}, a.row + i)) AND b.col = greatest(0, least(39, a.col + j)))
  SELECT row, col, {", ".join(f"max(value) FILTER (i = {i} AND j = {j}) AS w{i + 1}{j + 1}" for i in (-1, 0, 1) for j in (-1, 0, 1))} FROM n GROUP BY ALL)"""


@query(f"""SELECT row, col, round(sqrt(gx * gx + gy * gy) * 100, 4) AS slope_pct, round(w01 + w10 + w12 + w21 - 4 * w11, 4) + 0.0 AS laplacian, gx = 0 AND gy = 0 AS flat FROM
  (SELECT *, ((w02 + 2 * w12 + w22) - (w00 + 2 * w10 + w20)) / 8.0 AS gx, ((w20 + 2 * w21 + w22) - (w00 + 2 * w01 + w02)) / 8.0 AS gy FROM {WINDOW_SQL}) WHERE gx * gy IS NOT NULL""")
def horn_slope(spark, sf):
    t = grid.terrain(cells(spark, sf).select("row", "col", "value"), cell_rows(spark, sf), COLUMNS, 1.0)
    # a last row that isn't full leaves windows with a hole
    return t.where("slope_pct is not null").select("row", "col", r("slope_pct", 4).alias("slope_pct"), r("laplacian", 4).alias("laplacian"), (F.col("aspect") == -1).alias("flat"))


@query(f"WITH c AS {CELLS_SQL}, m AS (SELECT median(value) AS m FROM c WHERE (row + col) % 7 <> 0), f AS (SELECT row, col, CASE WHEN (row + col) % 7 = 0 THEN m ELSE value END AS v FROM c, m) SELECT a.row, a.col, CASE WHEN (a.row + a.col) % 7 = 0 THEN (SELECT median(b.v) FROM range(-1, 2) dr(i), range(-1, 2) dc(j), f b WHERE b.row = greatest(0, least({LAST_ROW_SQL}, a.row + i)) AND b.col = greatest(0, least(39, a.col + j))) ELSE a.v END AS value FROM f a")
def median_imputed(spark, sf):
    c = cells(spark, sf).select("row", "col", F.when((F.col("row") + F.col("col")) % 7 != 0, F.col("value")).alias("value"))
    return grid.median_filled(c, cell_rows(spark, sf), COLUMNS)


#: Heights of the targets whose cells reach over the whole source: 1.2 t + 0.8 below its rows, 0.7 t + 0.2 up to its last row.
NEAREST_ROWS_SQL, BILINEAR_ROWS_SQL = f"(10 * {LAST_ROW_SQL} + 13) // 12", f"(10 * {LAST_ROW_SQL} - 2) // 7 + 1"
NEAREST_COLUMNS, BILINEAR_COLUMNS = (10 * COLUMNS + 9) // 15, (10 * COLUMNS - 14) // 13 + 1


NEAREST_SQL = f"""SELECT t.row, t.col, c.value FROM (SELECT x::INT AS row, y::INT AS col FROM (SELECT unnest(range({NEAREST_ROWS_SQL})) AS x), range({NEAREST_COLUMNS}) b(y)) t
  LEFT JOIN {CELLS_SQL} c ON c.row = floor(t.row * 1.2::DOUBLE + 0.3::DOUBLE + 0.5::DOUBLE) AND c.col = floor(t.col * 1.5::DOUBLE + 0.5::DOUBLE)"""
BILINEAR_SQL = f"""SELECT t.row, t.col, round(sum(c.value * w) / sum(CASE WHEN c.value IS NOT NULL THEN w END), 5) AS value FROM
  (SELECT a.row, a.col, floor(a.fr) + i AS r, floor(a.fc) + j AS c, (1 - abs(a.fr - floor(a.fr) - i)) * (1 - abs(a.fc - floor(a.fc) - j)) AS w FROM
    (SELECT x::INT AS row, y::INT AS col, x * 0.7::DOUBLE + 0.2::DOUBLE AS fr, y * 1.3::DOUBLE + 0.4::DOUBLE AS fc FROM (SELECT unnest(range({BILINEAR_ROWS_SQL})) AS x), range({BILINEAR_COLUMNS}) b(y)) a, range(2) i(i), range(2) j(j)) t
  LEFT JOIN {CELLS_SQL} c ON c.row = t.r AND c.col = t.c GROUP BY ALL"""


@query(NEAREST_SQL)
def nearest_resample_whole(spark, sf):
    target = grid.grid(spark, (10 * cell_rows(spark, sf) + 3) // 12, NEAREST_COLUMNS)
    return grid.resample_nearest(cells(spark, sf).select("row", "col", "value"), target, F.col("row") * 1.2 + 0.3, F.col("col") * 1.5)


@query(BILINEAR_SQL)
def bilinear_resample_whole(spark, sf):
    target = grid.grid(spark, (10 * cell_rows(spark, sf) - 12) // 7 + 1, BILINEAR_COLUMNS)
    out = grid.resample_kernel(cells(spark, sf).select("row", "col", "value"), target, F.col("row") * 0.7 + 0.2, F.col("col") * 1.3 + 0.4)
    return out.withColumn("value", r("value", 5))


# the names of the queries that took a part of the source before
@query(NEAREST_SQL)
def nearest_resample(spark, sf):
    return nearest_resample_whole(spark, sf)


@query(BILINEAR_SQL)
def bilinear_resample(spark, sf):
    return bilinear_resample_whole(spark, sf)


@query(f"SELECT floor((col + 0.5::DOUBLE) / 5)::BIGINT AS bx, floor((row + 0.5::DOUBLE) / 5)::BIGINT AS by, round(avg(value), 6) AS mean, count(value)::BIGINT AS n FROM {CELLS_SQL} GROUP BY ALL")
def grid_bin_mean(spark, sf):
    points = cells(spark, sf).select((F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"), "value")
    return grid.binned(points, 5.0).withColumn("mean", r("mean"))


POLYGON = [[[3.0, 2.0], [30.0, 5.0], [35.0, 22.0], [18.0, 14.0], [4.0, 24.0], [3.0, 2.0]], [[10.0, 6.0], [14.0, 6.0], [14.0, 10.0], [10.0, 10.0], [10.0, 6.0]]]
EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for ring in POLYGON for a, b in zip(ring, ring[1:], strict=False))


@query(f"""SELECT row, col FROM (SELECT c.row, c.col, count(*) FILTER ((y1 > c.row + 0.25) <> (y2 > c.row + 0.25) AND c.col + 0.25 < x1 + (c.row + 0.25 - y1) * (x2 - x1) / (CASE WHEN y2 = y1 THEN 1 ELSE y2 - y1 END)) AS n
  FROM {CELLS_SQL} c, (VALUES {EDGES}) e(x1, y1, x2, y2) GROUP BY ALL) WHERE n % 2 = 1""")
def pixel_in_polygon(spark, sf):
    points = cells(spark, sf).select("row", "col", (F.col("col") + 0.25).alias("x"), (F.col("row") + 0.25).alias("y"))
    return grid.within(points, POLYGON).select("row", "col")


@query(f"SELECT row, col, CASE WHEN col >= 8 AND col < 20 AND row >= 6 AND row < 12 THEN 2 ELSE 1 END AS value FROM {CELLS_SQL} WHERE (col >= 4 AND col < 14 AND row >= 3 AND row < 9) OR (col >= 8 AND col < 20 AND row >= 6 AND row < 12)")
def burned_polygons(spark, sf):
    box = lambda a, b, c, d: [[[float(x), float(y)] for x, y in ((a, b), (c, b), (c, d), (a, d), (a, b))]]
    north = 100.0
    shapes = spark.createDataFrame([(1, 1, box(4, north - 9, 14, north - 3)), (2, 2, box(8, north - 12, 20, north - 6))], "ord int, value int, rings array<array<array<double>>>")
    return grid.burn(cells(spark, sf), shapes, 1.0, 0.0, north)


@query(None)
def projected_points(spark, sf):
    p = table(spark, sf, "supplier").select("s_suppkey", (F.lit(-74.5) + (F.col("s_suppkey") % 50) / 50.0).alias("lon"), (F.lit(4.0) + (F.col("s_suppkey") % 37) / 37.0).alias("lat"))
    x, y = projection.to_metres("lon", "lat")
    lon, lat = projection.to_degrees("x", "y")
    return p.withColumn("x", x).withColumn("y", y).select("s_suppkey", r("x", 3).alias("x"), r("y", 3).alias("y"), r(F.abs(lon - F.col("lon")) * 111000, 6).alias("miss_x"), r(F.abs(lat - F.col("lat")) * 111000, 6).alias("miss_y"))


@query("SELECT (j * 4 + i)::INT AS tile, -74.5::DOUBLE + i * 0.5::DOUBLE AS west, 3.5::DOUBLE + j * 0.5::DOUBLE AS south, least(-74.5::DOUBLE + (i + 1) * 0.5::DOUBLE, -72.75::DOUBLE) AS east, least(3.5::DOUBLE + (j + 1) * 0.5::DOUBLE, 5.75::DOUBLE) AS north FROM range(4) a(i), range(5) b(j)")
def udtf_tiles(spark, sf):
    from ..functions.registry import register_all

    register_all(spark)
    return spark.sql("SELECT * FROM tiles(-74.5D, 3.5D, -72.75D, 5.75D, 0.5D)")


@query("SELECT p_partkey, strip_accents('Ñame ' || p_name) AS plano, CASE WHEN p_partkey % 2 = 0 THEN 'Tomate_Arbol' ELSE 'Otros_cultivos' END AS cultivo FROM part")
def udf_surface(spark, sf):
    from ..functions.registry import register_all

    register_all(spark)
    table(spark, sf, "part").createOrReplaceTempView("_parts")
    return spark.sql("SELECT p_partkey, strip_accents('Ñame ' || p_name) AS plano, crop_class(CASE WHEN p_partkey % 2 = 0 THEN 'Tomate de árbol' ELSE 'Trigo' END) AS cultivo FROM _parts")


# ranks

@query("SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def topk_rank(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25)


@query(f"SELECT vec_id, k::INT AS clase, n::INT AS rank, round(p, 6) AS p FROM (SELECT vec_id, k, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k DESC) AS n FROM (SELECT vec_id, unnest([0, 1, 2]) AS k, unnest([p0, p1, p2]) AS p FROM {CHANCES_SQL})) WHERE n <= 2")
def topk_per_row(spark, sf):
    from ..functions.vectors import top_k

    c = chances(spark, sf).select("vec_id", "p", F.posexplode(top_k("p", 2)).alias("n", "clase"))
    return c.select("vec_id", F.col("clase").cast("int").alias("clase"), (F.col("n") + 1).cast("int").alias("rank"), r(F.get("p", F.col("clase").cast("int"))).alias("p"))


@query("SELECT l_returnflag AS truth, l_linestatus AS predicted, count(*)::BIGINT AS n FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O') GROUP BY ALL ORDER BY n DESC, truth, predicted LIMIT 8")
def confusers(spark, sf):
    li = table(spark, sf, "lineitem").where("not (l_returnflag = 'N' and l_linestatus = 'O')")
    g = li.groupBy(F.col("l_returnflag").alias("truth"), F.col("l_linestatus").alias("predicted")).agg(big(F.count(F.lit(1))).alias("n"))
    return g.orderBy(F.desc("n"), "truth", "predicted").limit(8)


# samples and splits

@query("""WITH c AS (SELECT l_suppkey, l_returnflag AS kind, count(*) AS n FROM lineitem GROUP BY ALL), d AS (SELECT l_suppkey, arg_max(kind, n * 1000 - ascii(kind)) AS kind, sum(n)::BIGINT AS n FROM c GROUP BY 1),
  k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, l_suppkey) - 1 AS i, dense_rank() OVER (ORDER BY kind) - 1 AS g FROM d)
  SELECT l_suppkey, kind, n, ((CASE WHEN (i // 5) % 2 = 0 THEN i % 5 ELSE 4 - i % 5 END + g) % 5)::INT AS fold FROM k""")
def class_group_folds(spark, sf):
    """Five folds of whole suppliers, balanced within the flag most of their rows have."""
    c = table(spark, sf, "lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    groups = c.groupBy("l_suppkey").agg(F.max_by("kind", F.col("n") * 1000 - F.ascii("kind")).alias("kind"), big(F.sum("n")).alias("n"))
    return sampling.class_folds(groups, "l_suppkey", "kind", "n", 5)


@query(None)
def count_balanced_folds(spark, sf):
    """Five folds of whole suppliers with nearly the same counts of each flag."""
    flags = F.array(*[F.count_if(F.col("l_returnflag") == k) for k in ("A", "N", "R")])
    groups = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(flags.alias("counts"))
    return information.balanced_folds(groups, "l_suppkey", "counts", 5)


QUOTA_SQL = "(SELECT c_nationkey, c_mktsegment, count(*) AS n, least(count(*), greatest(1, floor(400 * count(*) / (SELECT count(*) FROM customer)::DOUBLE)))::BIGINT AS quota FROM customer GROUP BY ALL)"


@query(f"SELECT c_nationkey, c_mktsegment, n::BIGINT AS n, quota FROM {QUOTA_SQL}")
def stratified_quotas(spark, sf):
    return sampling.quotas(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], 400).select("c_nationkey", "c_mktsegment", big("n").alias("n"), big("quota").alias("quota"))


@query(f"SELECT c_custkey FROM (SELECT c_custkey, quota, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY md5('42|' || c_custkey), c_custkey) AS k FROM customer JOIN {QUOTA_SQL} USING (c_nationkey, c_mktsegment)) WHERE k <= quota")
def stratified_sample(spark, sf):
    return sampling.stratified(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", 400).select("c_custkey")


@query("SELECT c_custkey FROM customer ORDER BY md5('42|' || c_custkey), c_custkey LIMIT 100")
def uniform_sample(spark, sf):
    return sampling.first_by_hash(table(spark, sf, "customer"), "c_custkey", 100).select("c_custkey")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY md5('42|' || (l_orderkey * 10 + l_linenumber)), l_orderkey * 10 + l_linenumber) AS k FROM lineitem) WHERE k <= 20")
def bag_sample(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return sampling.bags(li, ["l_suppkey"], "id", 20).select("l_orderkey", "l_linenumber")


@query("SELECT c_nationkey, CASE WHEN k <= ceil(n * 0.15::DOUBLE) THEN 'test' WHEN k <= ceil(n * 0.15::DOUBLE) * 2 THEN 'valid' ELSE 'train' END AS fold FROM (SELECT c_nationkey, row_number() OVER (ORDER BY md5('42|' || c_nationkey), c_nationkey) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT c_nationkey FROM customer))")
def group_split(spark, sf):
    return sampling.group_split(table(spark, sf, "customer"), "c_nationkey")


@query("""WITH g AS (SELECT s_suppkey, s_nationkey, count(*) OVER (PARTITION BY s_nationkey) AS c, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('42|' || s_suppkey), s_suppkey) AS rescue FROM supplier),
  p AS (SELECT *, CASE WHEN c < 4 THEN 'minority' ELSE s_nationkey::VARCHAR END AS pool, rescue = 1 AND c < 4 AS keep FROM g),
  o AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY keep, md5('42|' || s_suppkey), s_suppkey) AS k, count(*) OVER (PARTITION BY pool) AS n FROM p)
  SELECT s_suppkey, s_nationkey, pool, CASE WHEN keep THEN 'train' WHEN k <= floor(n * 0.15::DOUBLE) THEN 'test' WHEN k <= floor(n * 0.15::DOUBLE) * 2 THEN 'valid' ELSE 'train' END AS fold FROM o""")
def class_group_split(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("kind"))
    out = sampling.class_group_split(s, "s_suppkey", "kind")
    return out.select("s_suppkey", F.col("kind").cast("int").alias("s_nationkey"), "pool", "fold")


@query("SELECT l_suppkey, n, (CASE WHEN (k // 5) % 2 = 0 THEN k % 5 ELSE 4 - k % 5 END)::INT AS fold FROM (SELECT l_suppkey, count(*)::BIGINT AS n, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) - 1 AS k FROM lineitem GROUP BY 1)")
def group_folds(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(big(F.count(F.lit(1))).alias("n"))
    return sampling.folds(g, "l_suppkey", "n", 5)


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) <= floor(count(*) OVER (PARTITION BY event_type) * 0.2::DOUBLE) AS is_test FROM events")
def stratified_split(spark, sf):
    return sampling.within_class_split(table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id").select("event_id", "is_test")


@query("SELECT CASE WHEN year(o_orderdate) <= 1996 THEN 'train' ELSE 'test' END AS fold, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def temporal_split(spark, sf):
    return table(spark, sf, "orders").groupBy(F.when(F.year("o_orderdate") <= 1996, "train").otherwise("test").alias("fold")).agg(big(F.count(F.lit(1))).alias("n"))


@query(f"SELECT count(*)::BIGINT AS shared FROM (SELECT DISTINCT mun, semestre FROM {REGISTRY_SQL} WHERE o_custkey % 2 = 0 INTERSECT SELECT DISTINCT mun, semestre FROM {REGISTRY_SQL} WHERE o_custkey % 2 = 1)")
def overlap_check(spark, sf):
    reg = registry(spark, sf)
    half = lambda k: reg.where(F.col("o_custkey") % 2 == k).select("mun", "semestre")
    return half(0).intersect(half(1)).agg(big(F.count(F.lit(1))).alias("shared"))




@query(f"SELECT layer, n, n = (SELECT count(*) FROM part) AS completa, round(lo, 4) AS lo, round(hi, 4) AS hi, lo >= low AND hi <= high AS en_rango FROM (SELECT 'value' AS layer, count(value)::BIGINT AS n, min(value) AS lo, max(value) AS hi, 0.0 AS low, 45.0 AS high FROM {CELLS_SQL} UNION ALL SELECT 'price', count(price), min(price), max(price), 100.0, 1e9 FROM {CELLS_SQL})")
def layer_validation(spark, sf):
    """Each layer against the grid's number of cells and its physical range."""
    c = cells(spark, sf)
    wide = c.agg(F.count(F.lit(1)).alias("all"), *[f(k).alias(f"{m}_{k}") for k in ("value", "price") for m, f in (("n", F.count), ("lo", F.min), ("hi", F.max))])
    limits = {"value": (0.0, 45.0), "price": (100.0, 1e9)}
    rows = F.array(*[F.struct(F.lit(k).alias("layer"), big(f"n_{k}").alias("n"), (F.col(f"n_{k}") == F.col("all")).alias("completa"), r(f"lo_{k}", 4).alias("lo"), r(f"hi_{k}", 4).alias("hi"), ((F.col(f"lo_{k}") >= a) & (F.col(f"hi_{k}") <= b)).alias("en_rango")) for k, (a, b) in limits.items()])
    return wide.select(F.explode(rows).alias("x")).select("x.*")
