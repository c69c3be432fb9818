"""Calendars, catalogues, tilings and reports made from what the given tables hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import cuts, search, temporal
from ..sources import readers, sinks
from .registry import REGISTRY_SQL, query, registry, scored, table


@query(f"""SELECT semestre, substr(semestre, 1, 4) || '_' || lpad(m::VARCHAR, 2, '0') AS month_label, day(last_day(make_date(substr(semestre, 1, 4)::INT, m::INT, 1)))::INT AS days
  FROM (SELECT DISTINCT semestre FROM {REGISTRY_SQL}), (SELECT unnest(range(1, 13)) AS m) WHERE (m > 6) = (substr(semestre, 5, 1) = 'B')""")
def registry_months(spark, sf):
    """The months, with their days, of each half-year that the registry has."""
    months = registry(spark, sf).select("semestre").distinct().select("semestre", F.explode(temporal.months_of("semestre")).alias("month_label"))
    return months.withColumn("days", F.dayofmonth(F.last_day(F.to_date("month_label", "yyyy_MM"))).cast("int"))


EXTENT_SQL = "(SELECT c_nationkey AS mun, min(c_custkey % 97)::DOUBLE AS west, min(c_custkey % 61)::DOUBLE AS south, max(c_custkey % 97)::DOUBLE + 1 AS east, max(c_custkey % 61)::DOUBLE + 1 AS north FROM customer GROUP BY 1)"


def extents(spark, sf):
    """The box of each nation's customers on a plane."""
    x, y = F.col("c_custkey") % 97, F.col("c_custkey") % 61
    ends = [f(v).cast("double") + d for f, v, d in ((F.min, x, 0), (F.min, y, 0), (F.max, x, 1), (F.max, y, 1))]
    return table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("mun")).agg(*[e.alias(n) for e, n in zip(ends, ("west", "south", "east", "north"), strict=True)])


@query(f"""SELECT mun, (j * ceil((east - west) / 20) + i)::INT AS tile, west + i * 20 AS west, south + j * 20 AS south, least(west + (i + 1) * 20, east) AS east, least(south + (j + 1) * 20, north) AS north
  FROM {EXTENT_SQL}, range(5) a(i), range(4) b(j) WHERE i < ceil((east - west) / 20) AND j < ceil((north - south) / 20)""")
def extent_tiles(spark, sf):
    """Each nation's box in boxes of at most 20 on a side, by a table function beside each row."""
    from ..functions.registry import register_all

    register_all(spark)
    extents(spark, sf).createOrReplaceTempView("cellweave_extents")
    out = spark.sql("SELECT e.mun, t.* FROM cellweave_extents e, LATERAL tiles(e.west, e.south, e.east, e.north, 20D) t")
    spark.catalog.dropTempView("cellweave_extents")
    return out


@query(f"SELECT mun, west + i * 12 AS lon, south + j * 12 AS lat FROM {EXTENT_SQL}, range(9) a(i), range(6) b(j) WHERE west + i * 12 <= east AND south + j * 12 <= north")
def extent_grid(spark, sf):
    """Points 12 apart over each nation's box: its columns crossed with its rows."""
    along = lambda a, b: F.transform(F.sequence(F.lit(0), F.floor((F.col(b) - F.col(a)) / 12).cast("int")), lambda i: F.col(a) + i * 12)
    return extents(spark, sf).select("mun", F.explode(along("west", "east")).alias("lon"), along("south", "north").alias("_y")).select("mun", "lon", F.explode("_y").alias("lat"))


@query("SELECT (dense_rank() OVER (ORDER BY k) - 1)::BIGINT AS id, k AS name FROM (SELECT DISTINCT p_brand AS k FROM part)")
def catalogue_of_brands(spark, sf):
    """A table's classes numbered, written as a JSON object, read as a catalogue and inverted."""
    kinds = table(spark, sf, "part").agg(F.sort_array(F.collect_set("p_brand")).alias("k")).select(F.posexplode("k").alias("id", "name"))
    path = cuts.fresh_folder(spark, "catalogue")
    sinks.json_object(kinds, "name", "id").coalesce(1).write.text(path)
    held = readers.json_catalogue(spark, path).agg(F.map_from_entries(F.collect_list(F.struct("name", "id"))).alias("m"))
    return held.select(F.explode(names.inverted("m")).alias("id", "name")).select(F.col("id").cast("bigint").alias("id"), "name")


@query("SELECT p_brand, format('{:,}', count(*)) AS n, format('{:.1f} %', count(*) * 100.0 / (SELECT count(*) FROM part)) AS share, format('{:,.2f}', max(p_retailprice)) AS dearest FROM part GROUP BY 1")
def formatted_report(spark, sf):
    """Numbers as reports print them: thousands apart, shares with a decimal."""
    p = table(spark, sf, "part")
    whole = p.agg(F.count(F.lit(1)).alias("_all"))
    g = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.max("p_retailprice").alias("m")).crossJoin(F.broadcast(whole))  # one row
    return g.select("p_brand", F.format_number("n", 0).alias("n"), F.concat(F.format_number(F.col("n") * 100.0 / F.col("_all"), 1), F.lit(" %")).alias("share"), F.format_number("m", 2).alias("dearest"))


@query(None)
def parzen_search(spark, sf):
    """Twelve trials for the weight of one score, its slope and the threshold of largest F1, each trial but the first five drawn where good ones lie."""
    rows = scored(spark, sf).select("y", "p", "w").persist()

    def objective(found: dict, report) -> float:
        hit = F.col("p") + found["slope"] * F.col("w") / 50 >= found["threshold"]
        tp, fp, fn = rows.agg(F.count_if(hit & (F.col("y") == 1)), F.count_if(hit & (F.col("y") == 0)), F.count_if(~hit & (F.col("y") == 1))).first()
        value = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        report(value)
        return value

    space = {"slope": search.Span(-0.5, 0.5), "threshold": search.Span(0.01, 1.0, log=True)}
    out = search.optimized(spark, cuts.fresh_folder(spark, "study"), space, objective, 12)
    rows.unpersist()
    return out.select("trial", "parameters", "value", "state")
