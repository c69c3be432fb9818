"""Helpers shared by the operators of this subpackage: a shared scratch folder, written tables, connected components."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave import importable


def scratch_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode and only if none is named."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None and (known := context._jsc.sc().getCheckpointDir()).isDefined():
        root = known.get()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cellweave-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    return qualified(spark, root).rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, the default one if it names none: executors must not take it for a folder of their own."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a cut in the lineage that outlives lost executors."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stored_at = path
    for written in _scopes:
        written.append(path)
    return kept


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes what operators store while it is open; a result is to be written or collected before it closes.

        with scratch(spark):
            near_duplicates(docs).write.parquet(out)

    Taking a path out of the list keeps its table.
    """
    written: list[str] = []
    _scopes.append(written)
    try:
        yield written
    finally:
        _scopes.remove(written)
        for path in written:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(*frames: DataFrame) -> None:
    """Delete what store() wrote, once nothing lazy reads it any more."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            _delete(df.sparkSession, path)


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df marked for broadcast if it is seen to have at most `rows` rows, unmarked otherwise: joins then shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_crc(column) -> F.Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, component) for each node of an edge, component the smallest node reachable.

    Contraction: every label takes its smallest neighbour as parent, parents are
    followed to their roots by doubling, and the edges are rewritten to roots
    until none joins two labels. Rounds are logarithmic, each a few shuffles on
    labels; nothing is collected. No edges give no rows; loops and repeated
    edges do no harm; edges with a null end are ignored.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null")
    links = store(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = store(links.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while not is_empty(links := _crossing(links)):
        parents = links.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        parents = store(parents, "parents")
        while True:
            up = parents.select(F.col("a").alias("p"), F.col("p").alias("_up"))
            jumped = store(parents.join(up, "p").select("a", F.col("_up").alias("p"), (F.col("_up") != F.col("p")).alias("_moved")), "jumped")
            moved = not is_empty(jumped.where("_moved"))
            forget(parents)
            kept = jumped.select("a", "p")
            kept._stored_at = jumped._stored_at
            parents = kept
            if not moved:
                break
        to = parents.select(F.col("a").alias("component"), F.col("p").alias("_to"))
        new_labels = store(labels.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component")), "labels")
        forget(labels)
        labels = new_labels
        ends = [parents.select(F.col("a").alias(x), F.col("p").alias(f"_{x}")) for x in "ab"]
        moved_links = reduce(lambda d, e: d.join(e, e.columns[0], "left"), ends, links)
        new_links = store(moved_links.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b").distinct(), "links")
        forget(links, parents)
        links = new_links
    forget(links)
    return labels


def _crossing(links: DataFrame) -> DataFrame:
    kept = links.where("a <> b")
    if hasattr(links, "_stored_at"):
        kept._stored_at = links._stored_at
    return kept
