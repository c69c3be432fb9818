"""Named queries over the synthetic tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded, so that the order of a floating sum doesn't show; never negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


#: The tables in the roles of the engine's data: nation = municipality, half of a year = semester, segment = class, price = area.
REGISTRY_SQL = """(SELECT c_nationkey AS mun, year(o_orderdate)::VARCHAR || CASE WHEN month(o_orderdate) <= 6 THEN 'A' ELSE 'B' END AS semestre,
  c_mktsegment AS cultivo, o_totalprice AS area, o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey)"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.semantics import half_year

    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("mun"), half_year("o_orderdate").alias("semestre"), F.col("c_mktsegment").alias("cultivo"), F.col("o_totalprice").alias("area"), "o_orderkey", "o_custkey")


#: Cells 40 to a row from all part keys: row = key div 40, col = key % 40, value = size.
COLUMNS = 40
CELLS_SQL = "(SELECT (p_partkey // 40)::INT AS row, (p_partkey % 40)::INT AS col, p_size::DOUBLE AS value, p_retailprice AS price FROM part)"
LAST_ROW_SQL = "(SELECT max(p_partkey) // 40 FROM part)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.floor(key / COLUMNS).cast("int").alias("row"), F.pmod(key, F.lit(COLUMNS)).cast("int").alias("col"), F.col("p_size").cast("double").alias("value"), F.col("p_retailprice").alias("price"))


def cell_rows(spark: SparkSession, sf_dir: str) -> int:
    """The grid's height, a fact of its profile."""
    return int(cells(spark, sf_dir).agg(F.max("row")).first()[0]) + 1


#: Rows with a chance p, a truth y and a weight: late returns scored by discount.
SCORED_SQL = "(SELECT l_orderkey * 10 + l_linenumber AS id, (l_returnflag = 'R')::INT AS y, l_discount * 5 + l_tax AS p, l_quantity AS w, l_suppkey % 7 AS bag FROM lineitem)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 5 + F.col("l_tax")).alias("p"), F.col("l_quantity").alias("w"), (F.col("l_suppkey") % 7).alias("bag"))


#: Class chances of three classes per embedding: softmax of its first three components; truth from its label.
CHANCES_SQL = """(SELECT vec_id, label, exp(a) / (exp(a) + exp(b) + exp(c)) AS p0, exp(b) / (exp(a) + exp(b) + exp(c)) AS p1, exp(c) / (exp(a) + exp(b) + exp(c)) AS p2
  FROM (SELECT vec_id, label % 3 AS label, embedding[1]::DOUBLE * 10 AS a, embedding[2]::DOUBLE * 10 AS b, embedding[3]::DOUBLE * 10 AS c FROM embeddings))"""


def chances(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import vectors

    e = table(spark, sf_dir, "embeddings")
    scores = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double") * 10)
    return e.select("vec_id", (F.col("label") % 3).alias("label"), vectors.softmax(scores).alias("p"))
