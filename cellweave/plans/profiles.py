"""Queries on profiles, distributions, correlation, filters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import agronomy
from ..operators import grid, information, statistics
from .registry import CHANCES_SQL, REGISTRY_SQL, big, chances, query, r, registry, table

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def per_column(expressions: str, source: str = "lineitem", columns=NUMBERS) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS name, {expressions.format(c=c)} FROM {source}" for c in columns)


@query("SELECT event_type AS value, count(*)::BIGINT AS n, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share, round((sum(count(*)) OVER (ORDER BY count(*) DESC, event_type ROWS UNBOUNDED PRECEDING))::DOUBLE / (sum(count(*)) OVER ())::DOUBLE, 6) AS running FROM events GROUP BY 1")
def value_counts_cum(spark, sf):
    return statistics.value_counts(table(spark, sf, "events"), "event_type").select("value", "n", r("share").alias("share"), r("running").alias("running"))


@query("SELECT l_returnflag, l_linestatus, count(l_quantity)::BIGINT AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min, median(l_quantity) AS median, max(l_quantity) AS max FROM lineitem GROUP BY ALL")
def group_stats(spark, sf):
    g = statistics.group_stats(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return g.withColumn("mean", r("mean")).withColumn("std", r("std"))


@query("SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def crosstab_margins(spark, sf):
    return statistics.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query(f"SELECT semestre, count(*) FILTER (cultivo = 'BUILDING')::BIGINT AS BUILDING, count(*) FILTER (cultivo = 'MACHINERY')::BIGINT AS MACHINERY, count(*) FILTER (cultivo = 'NOWHERE')::BIGINT AS NOWHERE FROM {REGISTRY_SQL} GROUP BY 1")
def crosstab_pivot(spark, sf):
    return registry(spark, sf).groupBy("semestre").pivot("cultivo", ["BUILDING", "MACHINERY", "NOWHERE"]).count().na.fill(0)


@query("SELECT l_suppkey, count(*)::BIGINT AS n, round(avg(l_discount), 6) AS media, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1")
def named_agg(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(big(F.count(F.lit(1))).alias("n"), r(F.avg("l_discount")).alias("media"), r(F.sum("l_quantity"), 2).alias("total"))


@query("SELECT name, round(s, 6) AS null_share, n, s > 0.3 AS alta FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, avg(({e} IS NULL)::INT) AS s, count(*)::BIGINT AS n FROM lineitem" for c, e in (("a", "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END"), ("b", "l_tax"), ("c", "CASE WHEN l_linenumber > 2 THEN l_tax END"))) + ")")
def null_profile(spark, sf):
    li = table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") != 1, F.col("l_tax")).alias("a"), F.col("l_tax").alias("b"), F.when(F.col("l_linenumber") > 2, F.col("l_tax")).alias("c"))
    return statistics.null_profile(li, ["a", "b", "c"]).select("name", r("null_share").alias("null_share"), "n", (F.col("null_share") > 0.3).alias("alta"))


@query(per_column("round(avg(({c} = 0)::INT), 6) AS zero_share"))
def zero_profile(spark, sf):
    return statistics.zero_profile(table(spark, sf, "lineitem"), NUMBERS).select("name", r("zero_share").alias("zero_share"))


@query("SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS repeats FROM (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)")
def dup_keys(spark, sf):
    return statistics.repeats(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query(per_column("count({c})::BIGINT AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max"))
def describe_cols(spark, sf):
    d = statistics.describe(table(spark, sf, "lineitem"), NUMBERS)
    return d.select("name", "n", r("mean").alias("mean"), r("std").alias("std"), "min", *[r(q, 4).alias(q) for q in ("q25", "q50", "q75")], "max")


@query(per_column("round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(quantile_cont({c}, 0.05), 4) AS p5, round(quantile_cont({c}, 0.95), 4) AS p95, round(stddev_pop({c}) / (abs(avg({c})) + 1e-9), 6) AS cv, round(avg(({c} = 0)::INT), 6) AS zero_share"))
def stats_basic(spark, sf):
    b = statistics.basic(table(spark, sf, "lineitem"), NUMBERS)
    return b.select("name", *[r(c, 4 if c[0] == "p" else 6).alias(c) for c in b.columns[1:]])


@query("SELECT 'value' AS name, count(*)::BIGINT AS n FROM (SELECT value, avg(value) OVER () AS m, stddev_samp(value) OVER () AS s FROM events) WHERE abs(value - m) > 3 * s")
def extremes(spark, sf):
    return statistics.extremes(table(spark, sf, "events"), ["value"], 3.0)


@query("SELECT max(n)::BIGINT AS mayor, min(n)::BIGINT AS menor, round(max(n) / min(n)::DOUBLE, 6) AS razon FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)")
def imbalance(spark, sf):
    g = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(big(F.max("n")).alias("mayor"), big(F.min("n")).alias("menor"), r(F.max("n") / F.min("n")).alias("razon"))


@query("SELECT round(sum(l_quantity) FILTER (l_returnflag = 'R'), 2) AS positivos, round(sum(l_quantity) FILTER (l_returnflag <> 'R'), 2) AS negativos, round(sum(l_quantity) FILTER (l_returnflag <> 'R') / sum(l_quantity) FILTER (l_returnflag = 'R'), 6) AS peso FROM lineitem")
def class_mass(spark, sf):
    yes = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")))
    no = F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")))
    return table(spark, sf, "lineitem").agg(r(yes, 2).alias("positivos"), r(no, 2).alias("negativos"), r(no / yes).alias("peso"))


@query(f"SELECT 'p0' AS name, round(sum(p0), 5) AS masa FROM {CHANCES_SQL} UNION ALL SELECT 'p1', round(sum(p1), 5) FROM {CHANCES_SQL} UNION ALL SELECT 'p2', round(sum(p2), 5) FROM {CHANCES_SQL}")
def soft_mass(spark, sf):
    wide = chances(spark, sf).agg(*[F.sum(F.col("p")[i]).alias(f"p{i}") for i in range(3)])
    return wide.unpivot([], ["p0", "p1", "p2"], "name", "masa").select("name", r("masa", 5).alias("masa"))


@query(f"SELECT label, round(avg(-(p0 * ln(greatest(p0, 1e-9)) + p1 * ln(greatest(p1, 1e-9)) + p2 * ln(greatest(p2, 1e-9)))), 6) AS entropia FROM {CHANCES_SQL} GROUP BY 1")
def entropy_by_source(spark, sf):
    from ..functions.vectors import entropy

    return chances(spark, sf).groupBy("label").agg(r(F.avg(entropy("p"))).alias("entropia"))


@query("SELECT count(*)::BIGINT AS bags, round(avg(n), 6) AS mean, round(quantile_cont(n::DOUBLE, 0.25), 4) AS q25, round(quantile_cont(n::DOUBLE, 0.5), 4) AS q50, round(quantile_cont(n::DOUBLE, 0.75), 4) AS q75 FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)")
def bag_sizes(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(big(F.count(F.lit(1))).alias("bags"), r(F.avg("n")).alias("mean"), *[r(statistics.quantile("n", q), 4).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)])


@query(f"SELECT label, round(a / (a + b + c), 6) AS w0, round(b / (a + b + c), 6) AS w1, round(c / (a + b + c), 6) AS w2 FROM (SELECT label, avg(p0) AS a, avg(p1) AS b, avg(p2) AS c FROM {CHANCES_SQL} GROUP BY 1)")
def bag_mean(spark, sf):
    from ..functions.vectors import row_normalised

    g = chances(spark, sf).groupBy("label").agg(F.array(*[F.avg(F.col("p")[i]) for i in range(3)]).alias("m")).select("label", row_normalised("m").alias("w"))
    return g.select("label", *[r(F.col("w")[i]).alias(f"w{i}") for i in range(3)])


@query("SELECT lang, n, round((SELECT count(*) FROM documents) / (count(*) OVER () * n)::DOUBLE, 6) AS peso FROM (SELECT lang, count(*)::BIGINT AS n FROM documents GROUP BY 1)")
def balanced_weights(spark, sf):
    g = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy()
    return g.select("lang", "n", r(F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("peso"))


@query("WITH m AS (SELECT l_returnflag AS k, avg(l_quantity) AS q, avg(l_discount) AS d FROM lineitem GROUP BY 1) SELECT k, round((q - avg(q) OVER ()) / greatest(stddev_samp(q) OVER (), 1e-8), 4) + 0.0 AS zq, round((d - avg(d) OVER ()) / greatest(stddev_samp(d) OVER (), 1e-8), 4) + 0.0 AS zd FROM m")
def class_profile_z(spark, sf):
    m = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("k")).agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"))
    w = W.partitionBy()
    z = lambda c: r((F.col(c) - F.avg(c).over(w)) / F.greatest(F.stddev_samp(c).over(w), F.lit(1e-8)), 4)
    return m.select("k", z("q").alias("zq"), z("d").alias("zd"))


@query("SELECT round(quantile_cont(value, 0.99), 4) AS p99, round(min(value), 6) AS minimo, round(max(value), 6) AS maximo, round(max(value) - min(value), 6) AS rango, round(stddev_pop(value), 6) AS std, round(median(value), 5) AS mediana, count(DISTINCT user_id)::BIGINT AS distintos FROM events")
def scalar_stats(spark, sf):
    e, v = table(spark, sf, "events"), "value"
    ranks = statistics.wide_quantiles(e, [v], {"p99_": 0.99, "p50_": 0.5})
    moments = e.agg(r(F.min(v)).alias("minimo"), r(F.max(v)).alias("maximo"), r(F.max(v) - F.min(v)).alias("rango"), r(F.stddev_pop(v)).alias("std"), big(F.count_distinct("user_id")).alias("distintos"))
    return moments.crossJoin(F.broadcast(ranks)).select(r("p99_value", 4).alias("p99"), "minimo", "maximo", "rango", "std", r("p50_value", 5).alias("mediana"), "distintos")  # one row each


@query("SELECT name, distintos, round(d, 6) AS dominancia, (CASE WHEN d > 0.5 THEN 'alta' WHEN d > 0.2 THEN 'media' ELSE 'baja' END) AS nivel FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, count(*)::BIGINT AS distintos, max(n) / sum(n)::DOUBLE AS d FROM (SELECT {c}, count(*) AS n FROM part GROUP BY 1)" for c in ("p_brand", "p_type")) + ")")
def category_dominance(spark, sf):
    from ..functions.semantics import severity

    p = table(spark, sf, "part")
    parts = [p.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(F.lit(c).alias("name"), big(F.count(F.lit(1))).alias("distintos"), (F.max("n") / F.sum("n")).alias("d")) for c in ("p_brand", "p_type")]
    return reduce(lambda a, b: a.unionByName(b), parts).select("name", "distintos", r("d").alias("dominancia"), severity("d", [(0.5, "alta"), (0.2, "media")], "baja").alias("nivel"))


@query("SELECT nivel, count(*)::BIGINT AS n FROM (SELECT CASE WHEN s > 0.5 THEN 'critica' WHEN s > 0.2 THEN 'alta' WHEN s > 0.05 THEN 'media' ELSE 'ok' END AS nivel FROM (SELECT l_suppkey, avg((l_discount < 0.01)::INT) AS s FROM lineitem GROUP BY 1)) GROUP BY 1")
def alert_counts(spark, sf):
    from ..functions.semantics import severity

    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg((F.col("l_discount") < 0.01).cast("int")).alias("s"))
    return g.groupBy(severity("s", [(0.5, "critica"), (0.2, "alta"), (0.05, "media")], "ok").alias("nivel")).agg(big(F.count(F.lit(1))).alias("n"))


PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]]
PAIRS_SQL = "(" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for a, b in PAIRS) + ")"


@query(f"SELECT a, b, round(r, 6) + 0.0 AS r FROM {PAIRS_SQL}")
def corr_pairs(spark, sf):
    return statistics.correlations(table(spark, sf, "lineitem"), NUMBERS).select("a", "b", r("r").alias("r"))


@query(f"SELECT a, b, round(r, 6) + 0.0 AS r, CASE WHEN abs(r) > 0.95 THEN 'alta' WHEN abs(r) > 0.9 THEN 'media' ELSE 'baja' END AS nivel FROM {PAIRS_SQL} WHERE abs(r) > 0.001 ORDER BY abs(r) DESC")
def high_corr(spark, sf):
    from ..functions.semantics import severity

    c = statistics.correlations(table(spark, sf, "lineitem"), NUMBERS).where(F.abs("r") > 0.001)
    return c.orderBy(F.abs("r").desc()).select("a", "b", r("r").alias("r"), severity(F.abs("r"), [(0.95, "alta"), (0.9, "media")], "baja").alias("nivel"))


@query(f"""WITH RECURSIVE p AS MATERIALIZED (SELECT a, b, coalesce(abs(r), 0) AS r FROM {PAIRS_SQL}), m AS (SELECT c, avg(r) AS m FROM (SELECT a AS c, r FROM p UNION ALL SELECT b, r FROM p) GROUP BY 1),
  o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY p.r DESC, a, b) AS i, a, b, p.r, CASE WHEN x.m > y.m OR (x.m = y.m AND a > b) THEN a ELSE b END AS weaker FROM p JOIN m x ON x.c = a JOIN m y ON y.c = b),
  g AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS gone UNION ALL SELECT o.i, CASE WHEN o.r > 0.5 AND NOT list_contains(gone, a) AND NOT list_contains(gone, b) THEN list_append(gone, weaker) ELSE gone END FROM g JOIN o ON o.i = g.i + 1)
  SELECT unnest([{", ".join(f"'{c}'" for c in NUMBERS)}]) AS name, list_contains((SELECT gone FROM g ORDER BY i DESC LIMIT 1), unnest([{", ".join(f"'{c}'" for c in NUMBERS)}])) AS dropped""")
def corr_pruned(spark, sf):
    rows = statistics.correlations(table(spark, sf, "lineitem"), NUMBERS).collect()  # columns squared
    gone = statistics.pruned([(x["a"], x["b"], x["r"] or 0.0) for x in rows], 0.5)
    return spark.createDataFrame([(c, c in gone) for c in NUMBERS], "name string, dropped boolean")


@query("SELECT name, round(max(n) / sum(n)::DOUBLE, 6) AS modal_share, count(*)::BIGINT AS distinct_values, max(n) / sum(n)::DOUBLE > 0.8 AS casi_constante FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c}::DOUBLE AS v, count(*) AS n FROM lineitem GROUP BY {c}" for c in ("l_linenumber", "l_discount", "l_tax")) + ") GROUP BY 1")
def modal_share(spark, sf):
    m = statistics.modal_shares(table(spark, sf, "lineitem"), ["l_linenumber", "l_discount", "l_tax"])
    return m.select("name", r("modal_share").alias("modal_share"), F.col("distinct").alias("distinct_values"), (F.col("modal_share") > 0.8).alias("casi_constante"))


@query(per_column("round(stddev_pop({c}) / (abs(avg({c})) + 1e-10), 6) AS cv"))
def low_cv(spark, sf):
    m = statistics.stacked_aggregates(table(spark, sf, "lineitem"), NUMBERS, {"cv": lambda c: F.stddev_pop(c) / (F.abs(F.avg(c)) + 1e-10)})
    return m.select("name", r("cv").alias("cv"))


@query(per_column("round(corr({c}, (l_returnflag = 'R')::INT::DOUBLE), 6) + 0.0 AS r"))
def target_corr(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("double"))
    return statistics.target_correlations(li, NUMBERS, "y").select("name", r("r").alias("r"))


@query("SELECT round(corr(quality::DOUBLE, n_chars::DOUBLE), 6) + 0.0 AS r, count(*)::BIGINT AS n FROM labels JOIN documents USING (doc_id)")
def point_biserial(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return j.agg(r(F.corr(F.col("quality").cast("double"), F.col("n_chars").cast("double"))).alias("r"), big(F.count(F.lit(1))).alias("n"))


@query("""WITH c AS (SELECT least(9, floor((l_quantity - lo) / (hi - lo) * 10)) AS b, l_returnflag AS t, count(*)::DOUBLE AS n FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) GROUP BY ALL)
  SELECT round(sum(n / s * ln(n * s / (nb * nt))), 6) + 0.0 AS mi FROM (SELECT n, sum(n) OVER () AS s, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY t) AS nt FROM c)""")
def binned_information(spark, sf):
    return statistics.binned_information(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag").select(r("mi").alias("mi"))


def _psi(x: str) -> str:
    """The digamma function, by the same series."""
    y = f"({x} + 6.0::DOUBLE)"
    z = f"(1.0::DOUBLE / ({y} * {y}))"
    series = f"ln({y}) - 0.5::DOUBLE / {y} - {z} * (1 / 12.0::DOUBLE - {z} * (1 / 120.0::DOUBLE - {z} * (1 / 252.0::DOUBLE - {z} / 240.0::DOUBLE)))"
    return "(" + series + "".join(f" - 1.0::DOUBLE / ({x} + {i}.0::DOUBLE)" for i in range(6)) + ")"


@query(f"""WITH s AS MATERIALIZED (SELECT row_number() OVER () AS i, p_retailprice AS v, p_brand AS c, count(*) OVER (PARTITION BY p_brand) AS o FROM part),
  d AS (SELECT a.i, abs(a.v - b.v) AS d, row_number() OVER (PARTITION BY a.i ORDER BY abs(a.v - b.v)) AS nth FROM s a JOIN s b ON a.c = b.c AND a.i <> b.i),
  r AS MATERIALIZED (SELECT s.i, s.v, s.o, d.d * (1 - 1e-9::DOUBLE) AS r, least(3, s.o - 1) AS k FROM s JOIN d ON d.i = s.i AND d.nth = least(3, s.o - 1)),
  m AS (SELECT r.i, r.o, r.k, count(*) AS m FROM r JOIN r x ON x.v >= r.v - r.r AND x.v <= r.v + r.r GROUP BY ALL)
  SELECT round(greatest(0, {_psi("n")} + k - o - m), 6) + 0.0 AS mi FROM (SELECT count(*) AS n, avg({_psi("k")}) AS k, avg({_psi("o")}) AS o, avg({_psi("m")}) AS m FROM m)""")
def neighbour_information(spark, sf):
    """What a part's price tells of its maker, by nearest neighbours."""
    return information.information(table(spark, sf, "part"), "p_retailprice", "p_brand").select(r("information").alias("mi"))


@query("SELECT l_suppkey, round((quantile_cont(l_extendedprice, 0.95) - quantile_cont(l_extendedprice, 0.05)) / abs(median(l_extendedprice)), 6) AS spread FROM lineitem GROUP BY 1")
def robust_spread(spark, sf):
    q = lambda x: statistics.quantile("l_extendedprice", x)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(r((q(0.95) - q(0.05)) / F.abs(F.median("l_extendedprice"))).alias("spread"))


@query("""SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_linenumber > 1 THEN l_tax END, (SELECT median(l_tax) FROM lineitem WHERE l_linenumber > 1)) AS t,
  coalesce(CASE WHEN l_linenumber > 1 THEN l_returnflag END, (SELECT l_returnflag FROM lineitem WHERE l_linenumber > 1 GROUP BY 1 ORDER BY count(*) DESC, l_returnflag LIMIT 1)) AS f FROM lineitem""")
def impute(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("t"), F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("f"))
    return statistics.imputed(li, ["t"], ["f"])


@query("SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) + 0.0 AS l_quantity FROM lineitem")
def scale(spark, sf):
    s = statistics.scaled(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"])
    return s.withColumn("l_quantity", r("l_quantity"))


@query("SELECT event_id, (event_type = 'click')::INT AS event_type_click, (event_type = 'view')::INT AS event_type_view, coalesce((event_type = 'ninguno')::INT, 0) AS event_type_ninguno FROM events")
def one_hot(spark, sf):
    return statistics.one_hot(table(spark, sf, "events").select("event_id", "event_type"), "event_type", ["click", "view", "ninguno"]).drop("event_type")


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.05) AS l, quantile_cont(l_extendedprice, 0.95) AS h FROM lineitem WHERE l_returnflag = 'R')
  SELECT l_orderkey, l_linenumber FROM lineitem, q WHERE l_extendedprice BETWEEN l - 0.1::DOUBLE * abs(l) AND h + 0.1::DOUBLE * abs(h)""")
def envelope_filter(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return statistics.enveloped(li, li.where("l_returnflag = 'R'"), ["l_extendedprice"]).select("l_orderkey", "l_linenumber")


@query("SELECT 'l_quantity' AS name, 0.0::DOUBLE AS low, 40.0::DOUBLE AS high, count(l_quantity)::BIGINT AS n, count(*) FILTER (l_quantity NOT BETWEEN 0 AND 40)::BIGINT AS outside, count(*) FILTER (l_quantity NOT BETWEEN 0 AND 40) = 0 AS ok FROM lineitem UNION ALL SELECT 'l_tax', 0.0, 0.5, count(l_tax), count(*) FILTER (l_tax NOT BETWEEN 0 AND 0.5), count(*) FILTER (l_tax NOT BETWEEN 0 AND 0.5) = 0 FROM lineitem")
def range_checks(spark, sf):
    return statistics.range_checks(table(spark, sf, "lineitem"), {"l_quantity": (0, 40), "l_tax": (0, 0.5)})


@query("SELECT name, CASE WHEN cv < 0.1 THEN 'excluir: poca variacion' WHEN z > 0.05 THEN 'revisar: ceros' ELSE 'conservar' END AS recomendacion FROM (" + per_column("stddev_pop({c}) / (abs(avg({c})) + 1e-9) AS cv, avg(({c} = 0)::INT) AS z") + ")")
def exclusion_alerts(spark, sf):
    b = statistics.basic(table(spark, sf, "lineitem"), NUMBERS)
    return b.select("name", F.when(F.col("cv") < 0.1, "excluir: poca variacion").when(F.col("zero_share") > 0.05, "revisar: ceros").otherwise("conservar").alias("recomendacion"))


# filters

@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus IN ('F', 'O') AND o_custkey IS NOT NULL")
def range_filters(spark, sf):
    o = table(spark, sf, "orders").na.drop(subset=["o_custkey"])
    return o.where("o_orderdate >= timestamp'1995-01-01' and o_orderdate < timestamp'1996-01-01'").where(F.col("o_totalprice").between(1000, 200000) & F.col("o_orderstatus").isin("F", "O")).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_brand = 'Brand#25' OR starts_with(p_type, 'PROMO') OR contains(lower(p_type), 'brass') OR length(p_name) = 0")
def or_predicate(spark, sf):
    ok = (F.col("p_brand") == "Brand#25") | F.startswith("p_type", F.lit("PROMO")) | F.contains(F.lower("p_type"), F.lit("brass")) | (F.length("p_name") == 0)
    return table(spark, sf, "part").where(ok).select("p_partkey")


@query(f"SELECT vec_id FROM {CHANCES_SQL} WHERE p0 + p1 >= 0.6")
def mass_threshold(spark, sf):
    from ..functions.vectors import total

    return chances(spark, sf).where(total(F.slice("p", 1, 2)) >= 0.6).select("vec_id")


@query("SELECT vec_id FROM (SELECT vec_id, avg((label % 3 = 0)::INT) OVER (PARTITION BY vec_id % 40) AS part FROM embeddings) WHERE part >= 0.3")
def bag_mass_filter(spark, sf):
    """Rows of the bags in which at least a share of rows has its label from the region."""
    e = table(spark, sf, "embeddings").select("vec_id", F.pmod("vec_id", F.lit(40)).alias("bag"), (F.col("label") % 3 == 0).cast("int").alias("regional"))
    kept = e.groupBy("bag").agg(F.avg("regional").alias("part")).where("part >= 0.3")
    return e.join(kept, "bag", "left_semi").select("vec_id")


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount * 10 END AS m, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS s FROM lineitem)
  WHERE coalesce(NOT (m < 0.15 OR (m > 0.80 AND coalesce(s, 1) < 0.06) OR (m > 0.55 AND coalesce(s, 1) < 0.04)), true)""")
def agricultural_mask(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 2, F.col("l_discount") * 10).alias("m"), F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("s"))
    return li.where(agronomy.agricultural("m", "s")).select("l_orderkey", "l_linenumber")


@query("SELECT event_id FROM events WHERE event_id % 4 = 0 AND event_type IN (SELECT event_type FROM events WHERE event_id % 4 <> 0)")
def unseen_class_filter(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return e.where("event_id % 4 = 0").join(e.where("event_id % 4 <> 0").select("event_type").distinct(), "event_type", "left_semi").select("event_id")


@query("SELECT l_suppkey, round(stddev_pop(v), 6) AS std FROM (SELECT l_suppkey, CASE WHEN l_suppkey % 5 = 0 THEN 7.0::DOUBLE ELSE l_quantity END AS v FROM lineitem) GROUP BY 1 HAVING stddev_pop(v) < 1e-6 OR stddev_pop(v) / (abs(avg(v)) + 1e-9) < 0.01")
def constant_fields(spark, sf):
    v = F.when(F.col("l_suppkey") % 5 == 0, 7.0).otherwise(F.col("l_quantity"))
    g = table(spark, sf, "lineitem").select("l_suppkey", v.alias("v")).groupBy("l_suppkey").agg(F.stddev_pop("v").alias("s"), F.avg("v").alias("m"))
    return g.where((F.col("s") < 1e-6) | (F.col("s") / (F.abs("m") + 1e-9) < 0.01)).select("l_suppkey", r("s").alias("std"))


@query("""SELECT column_name AS name, CASE WHEN column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR starts_with(column_type, 'DECIMAL') THEN 'numeric' ELSE 'other' END AS kind,
  column_name NOT IN ('l_orderkey', 'l_linenumber') AND NOT starts_with(column_name, 'prob_') AS feature, count(*) OVER (PARTITION BY column_name) > 1 AS repeated FROM (DESCRIBE SELECT *, 1.0::DOUBLE AS prob_a FROM lineitem)""")
def column_groups(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("prob_a", F.lit(1.0))
    kinds = {c: "numeric" for c in statistics.numeric_columns(li)}
    features = statistics.feature_columns(li, ["l_orderkey", "l_linenumber"])
    return spark.createDataFrame([(c, kinds.get(c, "other"), c in features, c in statistics.repeated_columns(li.columns)) for c in li.columns], "name string, kind string, feature boolean, repeated boolean")


# set operations

@query("SELECT cell, arg_min(v, tile) AS value FROM (SELECT l_partkey AS cell, l_linenumber AS tile, min(CASE WHEN l_discount > 0.02 THEN l_quantity END) AS v FROM lineitem GROUP BY ALL) WHERE v IS NOT NULL GROUP BY 1")
def mosaic_first(spark, sf):
    tiles = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("cell"), F.col("l_linenumber").alias("tile")).agg(F.min(F.when(F.col("l_discount") > 0.02, F.col("l_quantity"))).alias("value"))
    return grid.mosaic(tiles, ["cell"]).where("value is not null")


@query("SELECT name FROM (SELECT c_mktsegment AS name FROM customer UNION SELECT o_orderpriority FROM orders) ORDER BY 1")
def feature_union(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name")).union(table(spark, sf, "orders").select("o_orderpriority")).distinct().orderBy("name")


@query("SELECT count(*)::BIGINT AS shared, count(*) = 0 AS disjoint FROM (SELECT c_nationkey FROM customer WHERE c_nationkey % 2 = 0 INTERSECT SELECT c_nationkey FROM customer WHERE c_nationkey % 2 = 1)")
def fold_intersection(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey")
    both = c.where("c_nationkey % 2 = 0").intersect(c.where("c_nationkey % 2 = 1"))
    return both.agg(big(F.count(F.lit(1))).alias("shared"), (F.count(F.lit(1)) == 0).alias("disjoint"))


@query("SELECT o_orderkey, 'A' AS half FROM orders WHERE month(o_orderdate) <= 6 UNION ALL SELECT o_orderkey, 'B' FROM orders WHERE month(o_orderdate) > 6")
def union_halves(spark, sf):
    o = table(spark, sf, "orders")
    return o.where(F.month("o_orderdate") <= 6).select("o_orderkey", F.lit("A").alias("half")).unionByName(o.where(F.month("o_orderdate") > 6).select("o_orderkey", F.lit("B").alias("half")))


@query("SELECT DISTINCT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1")
def set_ops(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()
    return keys.subtract(table(spark, sf, "nation").where("n_regionkey = 1").select("n_nationkey"))
