"""Exact deduplication as a stateful stream over files of documents.

Native: DataFrame, SQL and Structured Streaming only. Texts are equal when they
are identical after each run of blanks became one space.

1. A stateless stream reads new files and logs, for each row, doc_id, the
   SHA-256 of its normalised text and a content locator (file, row in the file).
2. A stateful stream over the log keeps in RocksDB, for each digest and without
   expiry, the smallest doc_id with its locator and the number of rows. Rows are
   combined before the shuffle, so a text with very many copies is one row a task.
3. Digests with several rows are hits. The texts of all rows that may be hits are
   read again and compared in full: distinct (digest, text), and a digest with
   two texts is no match. A bitmap of `2 ** MAP_BITS` bits, 8 MB at any size,
   tells most other rows apart before their texts are shuffled; a wrong "maybe"
   only costs work. Texts whose digest is shared by another text are grouped by
   the text itself.
4. The log meets the hits by digest, narrow rows on both sides.

`ingest` may be called again when files have come: both streams go on where
their checkpoints stand, so a row is counted once, whatever was lost meanwhile.

Defined cases: null text is empty; empty texts are equal to each other, and
texts of blanks only to " "; texts of any length count whole; among rows of one
text the smallest doc_id stays, null ids last, ties (repeated rows) by locator,
so that exactly one row of each text is kept; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import fresh_path, is_empty, store

BLANKS = "[\\x20\\x09-\\x0D]+"
MAP_BITS = 26
FILES_PER_BATCH = 10_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def key_of(digest: Column, bits: int) -> Column:
    """What the state is kept by: the first bits of the digest."""
    return digest if bits >= 256 else F.substring(digest, 1, bits // 8)


def _fields(spark: SparkSession, path: str, doc_id: str, text: str) -> StructType:
    have = spark.read.parquet(path).schema
    return StructType([StructField(c, have[c].dataType) for c in (doc_id, text)])


def _globbed(path: str) -> str:
    """A pattern that only the path itself fits: streams take a single file by pattern only."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def _located(read: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, file, row, text), the text normalised."""
    place = [F.col(f"_metadata.{c}").alias(name) for c, name in (("file_path", "file"), ("row_index", "row"))]
    return read.select(F.col(doc_id).alias("doc_id"), *place, normalised(F.col(text)).alias("text"))


def first_of() -> Column:
    """The order in which one of equal rows stays."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "file", "row")


def ingest(spark: SparkSession, path: str, at: str, doc_id: str = "doc_id", text: str = "text", bits: int = 256, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take the files under path that are new into the log and the state in the shared folder `at`.

    The streams run in a session of their own, whose settings (the RocksDB
    store) don't reach the caller's. The number of state partitions is that of
    the first call, as the engine keeps it with the state.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else every partition of the state takes some MB of disk ahead
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    read = own.readStream.schema(_fields(spark, path, doc_id, text)).option("maxFilesPerTrigger", files_per_batch).parquet(_globbed(path))
    log = _located(read, doc_id, text).select("doc_id", "file", "row", sha256(F.col("text")).alias("digest"))
    _to_end(log.writeStream.format("parquet").option("path", f"{at}/log"), f"{at}/log-checkpoint")
    logged = own.readStream.schema(log.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{at}/log")
    state = logged.groupBy(key_of(F.col("digest"), bits).alias("key")).agg(F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("n"))
    _to_end(state.writeStream.format("noop").outputMode("update"), f"{at}/state")


def _to_end(writer, checkpoint: str) -> None:
    writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()


def held(spark: SparkSession, at: str) -> DataFrame:
    """(key, first, n): the state, read by the engine's reader of state stores."""
    if is_empty(spark.read.parquet(f"{at}/log")):
        return spark.createDataFrame([], "key binary, first struct<missing:boolean,doc_id:long,file:string,row:long>, n long")
    state = spark.read.format("statestore").load(f"{at}/state")
    first, n = (F.col("value")[f.name] for f in state.schema["value"].dataType)  # the engine names them
    return state.select(F.col("key")[state.schema["key"].dataType[0].name].alias("key"), first.alias("first"), n.alias("n"))


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << MAP_BITS)) + 1


def bitmaps(keys: DataFrame) -> DataFrame:
    """(bucket, bits): a bitmap of all keys, at most 2 ** (MAP_BITS - 15) rows of 4 KB."""
    return keys.select(_bit(F.col("key")).alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))


def maybe_in(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """Rows whose key may be in the bitmaps: all that are, and few others."""
    place = F.bitmap_bit_position(_bit(F.col("key")))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.expr("shiftright(_byte, cast(_place % 8 as int)) & 1") == 1
    wide = rows.withColumn("bucket", F.bitmap_bucket_number(_bit(F.col("key")))).join(F.broadcast(maps), "bucket")  # 8 MB at most
    return wide.withColumn("_place", place).withColumn("_byte", byte).where(found).select(*rows.columns)


def decided(spark: SparkSession, path: str, at: str, doc_id: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row taken in so far; path: all files taken in."""
    hits = store(held(spark, at).where("n > 1"), "hits")
    log = spark.read.parquet(f"{at}/log").withColumn("key", key_of(F.col("digest"), bits))
    read = _located(spark.read.schema(_fields(spark, path, doc_id, text)).parquet(path), doc_id, text)
    texts = read.withColumn("key", key_of(sha256(F.col("text")), bits))
    compared = maybe_in(texts.select("key", "text"), bitmaps(hits)).distinct()
    shared = store(compared.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("key"), "shared")
    groups = hits.join(shared, "key", "left_anti")
    rows = log.join(groups, "key", "left")
    if not is_empty(shared):
        some = maybe_in(texts.select("key", "text", "doc_id", "file", "row"), bitmaps(shared)).join(shared, "key", "left_semi")
        by_text = some.groupBy("key", "text").agg(F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("n"))
        apart = store(some.join(by_text, ["key", "text"]).select("file", "row", "first", "n"), "apart")
        mine = apart.select("file", "row", F.col("first").alias("_first"), F.col("n").alias("_n"))
        rows = rows.join(mine, ["file", "row"], "left").withColumn("first", F.coalesce("_first", "first")).withColumn("n", F.coalesce("_n", "n"))
    stays = F.col("first").isNull() | ((F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row")))
    return rows.select("doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate_files(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """Decisions for all rows of the Parquet files under path, in a folder of their own."""
    at = fresh_path(spark, "exact")
    ingest(spark, path, at, doc_id, text, bits)
    return decided(spark, path, at, doc_id, text, bits)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """Decisions for a DataFrame, which is written to the shared folder first, so that its rows have locators."""
    kept = store(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "documents")
    return deduplicate_files(docs.sparkSession, kept._stored_at, bits=bits)
