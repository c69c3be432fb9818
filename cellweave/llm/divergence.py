"""Where a source's words differ from its language's and from those of other sources.

Plain relational steps: terms are exploded from the texts, counted by
(lang, source, term), every group is crossed with its language's kept
vocabulary so that absent terms count 0, groups meet on (lang, term), and
differences of smoothed shares are summed and ranked.

A language keeps the terms of at least `least_docs` of its documents. In each
group, and in the whole language, a kept term has
p = 1 + 1e9 * (count + 5) div (N + 5 * V), N the group's count of kept terms and
V their number, in exact decimals, so no count is too large.

At scale: texts are read once; a document's terms are exploded together with its
distinct terms, so occurrences and documents are counted in one aggregation,
which combines before its shuffle. Very common terms are one row for a task and
group. Groups are joined to vocabularies by broadcast while their number is seen
to be small, and otherwise in a shuffle. The pairs of sources are what is asked
for: their number is the square of a language's sources, whatever the texts.

Defined cases: null text, lang and source are empty strings; texts without a
term still make their group; a group without kept terms has N = 0, and with V = 0
its pairs have the value 0; texts of any length count whole; repeated rows and
ids are documents of their own; ties rank by item in UTF-8 order; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small, store

TERM = "[a-z\\x{80}-\\x{10FFFF}]+"  # in lowered texts the same runs as [^\x00-\x40\x5B-\x60\x7B-\x7F]+, which the engine's matcher takes eight times as long for
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, EXTRA = 1_000_000_000, 5
LEAST_DOCS, TOP_TERMS = 30, 50


def lowered(text: Column) -> Column:
    """A-Z only; where all characters are ASCII that is what lower does, faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def counted(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; a row without a term for each group."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    terms = filled.select("lang", "source", F.regexp_extract_all(lowered(F.col("text")), F.lit(TERM), F.lit(0)).alias("terms"))
    both = terms.select("lang", "source", F.posexplode(F.array("terms", F.array_distinct("terms"))).alias("distinct", "terms"))
    each = both.select("lang", "source", "distinct", F.explode_outer("terms").alias("term"))
    return each.groupBy("lang", "source", "term").agg(F.count_if(F.col("distinct") == 0).alias("n"), F.count_if(F.col("distinct") == 1).alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share, exact at any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", (wide(n) + F.lit(EXTRA)) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + wide(kept) * F.lit(EXTRA))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each group is from each other source of its language, and its most typical terms."""
    counts = store(counted(docs, text, lang, source), "counts")
    groups = store(counts.select("lang", "source").distinct(), "groups")
    kept = store(counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs).drop("docs"), "vocabulary")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    known = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n")
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    facts = small(store(groups.join(totals, ["lang", "source"], "left").join(sizes, "lang").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), "v", "lang_total"), "facts"))
    dense = kept.join(facts, "lang").join(known, ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rated = store(dense.select("lang", "term", "source", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")), "rated")

    mine, other = rated.select("lang", "term", "source", "p"), rated.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p2"))
    half = mine.join(other, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("p2"))).alias("value"))
    sums = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pair = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    term = rated.where("n > 0 and p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [d.withColumn("rank", F.row_number().over(order)) for d in (pair, term)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms))
