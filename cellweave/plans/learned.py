"""Queries of models that are learned in Spark: classes from bag proportions, boosted trees under one softmax."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import boosting, learning, proportions
from ..operators.cuts import cut
from .registry import big, query, r, table

LETTERS = "aeiouthsndlcygß"
LANGUAGES = ("de", "en", "es", "fr")
BAGS, BAG_SIZE = 24, 512


@F.arrow_udf(T.ArrayType(T.LongType()))
def letter_counts(text: pa.Array) -> pa.Array:
    """How often each of LETTERS occurs, in one pass over a text's bytes; letters of two bytes take one each."""
    short, out = [c for c in LETTERS if c.isascii()], np.zeros((len(text), len(LETTERS)), np.int64)
    places, codes = [LETTERS.index(c) for c in short], [ord(c) for c in short]
    rest = [(i, c.encode()) for i, c in enumerate(LETTERS) if not c.isascii()]
    for row, value in zip(out, text, strict=True):
        data = value.as_buffer()
        row[places] = np.bincount(np.frombuffer(data, np.uint8), minlength=256)[codes]
        for i, c in rest:
            row[i] = data.to_pybytes().count(c)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1) * len(LETTERS), pa.int32()), pa.array(out.ravel()))


def letters(spark, sf) -> DataFrame:
    """(doc_id, kind, x): the place of a document's language in LANGUAGES and the share of each letter in its whole text; written once, as every epoch and fact reads it."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    kind = F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("lang")) - 1
    size = F.greatest(F.length("text"), F.lit(1))
    return cut(docs.where(kind >= 0).select("doc_id", kind.cast("int").alias("kind"), F.transform(letter_counts("text"), lambda n: n / size).alias("x")))


def bagged(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Rows with a bag that leans to some languages, and (bag, w): the languages' shares of each bag, which is all that is learned from."""
    at = F.pmod(F.col("doc_id") * 7919, F.lit(10007)) / 10007.0
    rows = letters(spark, sf).withColumn("bag", F.floor(F.pmod(F.pow(at, 3.0) + F.col("kind") * 0.25, F.lit(1.0)) * BAGS).cast("int"))
    shares = rows.groupBy("bag").agg(F.array(*[F.avg((F.col("kind") == k).cast("double")) for k in range(len(LANGUAGES))]).alias("w"))
    return rows, shares


def from_proportions(spark, sf, epochs: int):
    rows, shares = bagged(spark, sf)
    return rows, proportions.train(rows, shares, "bag", "doc_id", "x", ["otro"] * len(LETTERS), F.col("bag") % 4 == 1, (32, 16), epochs, 2, BAG_SIZE, 2, 0.02, 1e-4, 1e-4, 1.0, 1, 0.2, 0.1, 0.05, 0.0)


KINDS_SQL = "(SELECT doc_id, list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS kind FROM documents WHERE list_contains(['de', 'en', 'es', 'fr'], lang))"


@query(f"""WITH b AS (SELECT kind, floor((pow(((doc_id * 7919) % 10007) / 10007.0::DOUBLE, 3) + kind * 0.25::DOUBLE) % 1.0::DOUBLE * {BAGS})::INT AS bag FROM {KINDS_SQL})
  SELECT bag, ceil(count(*) / {BAG_SIZE}.0::DOUBLE)::INT AS chunks, count(*)::BIGINT AS n, round(avg((kind = 0)::INT), 6) AS de, round(avg((kind = 1)::INT), 6) AS en, round(avg((kind = 2)::INT), 6) AS es, round(avg((kind = 3)::INT), 6) AS fr FROM b GROUP BY 1""")
def bag_chunks(spark, sf):
    """What learning from proportions sees of each bag: its chunks, all its rows, its shares."""
    rows, shares = bagged(spark, sf)
    dealt = proportions.chunks(rows, shares, "bag", "doc_id", "x", F.lit(False), BAG_SIZE)
    found = dealt.groupBy("bag").agg(F.max("chunks").alias("chunks"), big(F.sum(F.size("x"))).alias("n"), F.first("w").alias("w"))
    return found.select("bag", "chunks", "n", *[r(F.col("w")[i]).alias(name) for i, name in enumerate(LANGUAGES)])


@query(None)
def proportion_training(spark, sf):
    """Loss and held-out divergence of each epoch, beside that of the class prior."""
    _, (_, log, prior) = from_proportions(spark, sf, 10)
    return spark.createDataFrame([(*entry, prior) for entry in log], "epoch int, rate double, loss double, held_kl double, prior_kl double")


@query(None)
def proportion_inference(spark, sf):
    """Chances of each document's languages by a network that has seen the shares of bags only."""
    rows, (model, _, _) = from_proportions(spark, sf, 6)
    return learning.infer(rows, "doc_id", "x", model, "kind")


def _boosted(spark, sf, rounds: int = 5):
    rows = letters(spark, sf)
    return rows, boosting.fit(rows, "x", "kind", len(LANGUAGES), "doc_id", held=F.col("doc_id") % 5 == 0, rounds=rounds, depth=3, bins=32, gamma=0.5, alpha=0.1, strength=1.0, rows_share=0.8, columns_share=0.8, patience=3)


@query(None)
def softmax_boosting(spark, sf):
    """Chances of each document's languages by trees that all classes' losses share."""
    rows, (model, _) = _boosted(spark, sf)
    return learning.infer(rows, "doc_id", "x", model, "kind")


@query(None)
def softmax_stages(spark, sf):
    """Training and held-out loss after each round, by which fitting stops, with the features' gains after the best one."""
    _, (model, log) = _boosted(spark, sf)
    gains = sorted(zip(LETTERS, model.gains(), strict=True), key=lambda g: -g[1][0])
    best = min(log, key=lambda e: e[2])[0]
    return spark.createDataFrame([(*e, e[0] == best, {k: float(g) for k, (g, n) in gains if n} if e[0] == best else None) for e in log], "rounds int, loss double, held_loss double, best boolean, gains map<string,double>")
