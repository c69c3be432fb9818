"""WARC archives: an index of every record first, reads by coalesced byte ranges after.

Writing: payload digests are found in one narrow pass; of records with equal
payloads of at least `least_bytes`, that with the largest page_id becomes the
response and the others are revisits that name it. Then each task writes its
rows as one file of gzip members, one member a record, and returns an index row
for each: file, offset, length, url, digest, type. File names carry the attempt,
and the index is committed by Spark, so a task that is lost and run again leaves
only a file that no index row names. A folder without a file system's name is
one of the cluster's default file system.

Reading: the selected index rows go to tasks by file and are sorted by offset;
ranges closer than `gap` bytes are read as one, up to `most` bytes at a time, and
each record is taken out of its range, unpacked and parsed. What a read costs
follows from the records selected, not from the size of the archive.

Defined cases: null html is an empty payload, and empty payloads are equal ones
when `least_bytes` is 0; null urls are written without a target; repeated rows
of a page_id are records of their own, of which equal ones of one page_id have
one response; a null page_id never outranks another; an empty table gives an
empty index; other columns are ignored. urls with spaces,
control characters or letters beyond ASCII are written percent-encoded and read
back as they were.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh_path, importable, qualified, store
from .text import slices

INDEX = "page_id {kind}, url string, digest string, payload_bytes long, record_type string, refers_to {kind}, file string, offset long, length long"
END = b"\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """A folder by its full uri, as the driver makes it: local, hdfs or object store."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def target(url: str | None) -> list[tuple[str, str]]:
    """The url as it is if it is printable ASCII, else percent-encoded with a field that says so."""
    if url is None:
        return []
    if url and all(33 <= ord(c) <= 126 for c in url):
        return [("WARC-Target-URI", url)]
    return [("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~-._")), ("WARC-Target-URI-Encoding", "percent")]


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One gzip member. A revisit holds no payload: its block is a response head without body."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}|{digest}|{kind}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        *target(url),
        *([("WARC-Page-ID", str(page_id))] if page_id is not None else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        *([("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Page-ID", str(refers_to))] if kind == "revisit" else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    plain = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + END + block + END + END
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a gzip member; refuses a damaged one."""
    unpacker = zlib.decompressobj(31)
    plain = unpacker.decompress(member)
    if not unpacker.eof or unpacker.unused_data:
        raise ValueError("not exactly one gzip member")
    head, _, rest = plain.partition(END + END)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != END + END:
        raise ValueError("a record's length is wrong")
    return fields, rest[:n].partition(END + END)[2]


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, payload_bytes, record_type, refers_to).

    Digests alone decide the roles: a row for each digest holds the largest
    page_id, and a row for each (digest, page_id) keeps repeated rows apart.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sha = F.unhex(F.sha1(payload))
    named = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), sha.alias("_sha"))
    roles = store(named.where(F.col("payload_bytes") >= least_bytes).groupBy("_sha").agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_sha", "_top"), "roles")
    joined = named.join(roles, "_sha", "left")
    many = F.col("_top").isNotNull()
    # of repeated rows of the top page one is the response
    return joined.withColumn("_many", many & (F.col("page_id").isNull() | (F.col("page_id") != F.col("_top"))))


def write(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write the archives and return their index, stored: page_id, url, digest, payload_bytes, record_type, refers_to, file, offset, length."""
    spark = pages.sparkSession
    importable(spark)
    folder = qualified(spark, folder) if folder else fresh_path(spark, "warc")
    kind = dict(pages.dtypes)[page_id]
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    planned = plan_records(named, least_bytes)
    repeats = store(named.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("page_id"), "repeats")
    doubled = repeats.count() > 0
    if doubled:
        nth = F.row_number().over(W.partitionBy("page_id", "_sha").orderBy("url"))
        again = (nth > 1) & F.col("_top").isNotNull()
        planned = planned.withColumn("_many", F.col("_many") | again)
    planned = planned.select("page_id", "url", "html", F.when(F.col("_many"), F.col("_top")).alias("refers_to"), F.col("_many").alias("revisit"))
    top, path = folder, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(top)
        out, name, offset = None, None, 0
        try:
            for batch in (part for whole in batches for part in slices(whole, "html", 1 << 22)):
                rows = []
                for p, u, h, other, again in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit")), strict=True):
                    if out is None:
                        files.create_dir(root, recursive=True)
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (h or "").encode()
                    digest, role = sha1_base32(payload), "revisit" if again else "response"
                    member = record(p, u, payload, digest, role, other)
                    out.write(member)
                    rows.append((p, u, digest, len(payload), role, other if again else None, name, offset, len(member)))
                    offset += len(member)
                id_type = batch.schema.field("page_id").type
                types = [id_type, pa.string(), pa.string(), pa.int64(), pa.string(), id_type, pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["page_id", "url", "digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    index = store(planned.mapInArrow(run, INDEX.format(kind=kind)), "warc-index")
    index._archives = folder
    return index


def ranges(rows: list[tuple[int, int]], gap: int, most: int) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, positions): sorted (offset, length) rows merged where they lie within `gap` of each other, to at most `most` bytes unless one row is longer."""
    start = end = None
    members: list[int] = []
    for i, (offset, length) in enumerate(rows):
        if start is not None and offset - end <= gap and offset + length - start <= most:
            end = max(end, offset + length)
            members.append(i)
        else:
            if start is not None:
                yield start, end, members
            start, end, members = offset, offset + length, [i]
    if start is not None:
        yield start, end, members


def read(index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 8 << 20) -> DataFrame:
    """(page_id, url, digest, record_type, refers_to, payload_bytes, payload) of the index rows given.

    Index rows are dealt by file and stretch of `most` bytes, so that one large
    file is read by many tasks.
    """
    kind = dict(index.dtypes)["page_id"]
    importable(index.sparkSession)
    folder = qualified(index.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            id_type = batch.schema.field("page_id").type
            by_file: dict[str, list] = {}
            for p, f, o, n in zip(*(batch.column(c).to_pylist() for c in ("page_id", "file", "offset", "length")), strict=True):
                by_file.setdefault(f, []).append((o, n, p))
            for name, rows in by_file.items():
                rows.sort(key=lambda r: r[:2])
                with files.open_input_file(f"{root}/{name}") as source:
                    for start, end, members in ranges([r[:2] for r in rows], gap, most):
                        data, out = source.read_at(end - start, start), []
                        for i in members:
                            o, n, p = rows[i]
                            fields, payload = parse(data[o - start : o - start + n])
                            other = fields.get("WARC-Refers-To-Page-ID")
                            uri = fields.get("WARC-Target-URI")
                            if "WARC-Target-URI-Encoding" in fields:
                                uri = unquote(uri)
                            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            role = fields["WARC-Type"]
                            if role == "response" and sha1_base32(payload) != digest:
                                raise ValueError(f"the payload of page {p} doesn't match its digest")
                            named = fields.get("WARC-Page-ID")
                            if (named is None) != (p is None) or named is not None and named != str(p):
                                raise ValueError(f"the index names page {p}, the record {named}")
                            out.append((p, uri, digest, role, None if other in (None, "None") else int(other) if pa.types.is_integer(id_type) else other, int(fields["WARC-Payload-Length"]), payload if role == "response" else None))
                        types = [id_type, pa.string(), pa.string(), pa.string(), id_type, pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["page_id", "url", "digest", "record_type", "refers_to", "payload_bytes", "payload"])

    stretch = F.floor(F.col("offset") / most)
    dealt = index.select("page_id", "file", "offset", "length", stretch.alias("_s")).repartition("file", "_s").sortWithinPartitions("file", "offset").drop("_s")
    return dealt.mapInArrow(run, f"page_id {kind}, url string, digest string, record_type string, refers_to {kind}, payload_bytes long, payload binary")
