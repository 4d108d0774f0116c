"""WARC archives: write pages as records with an index, and read selected
records back by coalesced byte ranges.

Archives are files of gzip members, one per record, in the shared folder of
the session.  A task writes its files under names of its own attempt, and
what other stages know of them is only the index that the attempt returned;
files of lost or repeated attempts are never referred to.  The index (file,
offset, length, URL, digest, page) is a Parquet table, so choosing records is
a query; the chosen ranges are dealt out by file and stretch, sorted, merged
where they lie close together, and each merged range is one read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm.common import SLICE, as_bytes
from webcorpus.session import ensure_checkpoint_dir

#: Fixed values of the format: version line, revisit profile, and an unchanging record date.
VERSION = b"WARC/1.1\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
#: A task starts a new archive beyond this many bytes.
FILE_BYTES = 1 << 30
#: Ranges of one file that are read by one task, in bytes from the stretch's start.
STRETCH = 64 << 20
#: Ranges are merged over gaps up to GAP, into reads of at most READ bytes (a longer record is one read).
GAP, READ = 64 << 10, 8 << 20
#: Copies of a repeated payload's entry, so that its pages meet it in as many tasks.
SALT = 16

INDEX = ("path string, offset long, length long, url string, payload_digest string, payload_bytes long, "
         "page_id long, record_type string, refers_to long")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(fields: list[tuple[bytes, bytes]]) -> bytes:
    return VERSION + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n"


def safe_uri(url: str) -> bytes:
    """A URL as a header value: spaces and control characters percent-encoded."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit if it refers to a page.  A revisit has the
    HTTP header and the digest and length of the payload, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [(b"WARC-Type", b"response" if refers_to is None else b"revisit"),
              (b"WARC-Record-ID", b"<urn:uuid:%s>" % str(uuid.uuid4()).encode()), (b"WARC-Date", DATE)]
    if url is not None:
        fields.append((b"WARC-Target-URI", safe_uri(url)))
    if page_id is not None:
        fields.append((b"WARC-X-Page-ID", b"%d" % page_id))
    if refers_to is not None:
        fields += [(b"WARC-Profile", PROFILE), (b"WARC-X-Refers-To-Page-ID", b"%d" % refers_to),
                   (b"WARC-X-Payload-Length", b"%d" % len(payload))]
    fields += [(b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
               (b"WARC-Block-Digest", b"sha1:" + digest32(block).encode()),
               (b"Content-Type", b"application/http; msgtype=response"), (b"Content-Length", b"%d" % len(block))]
    return header(fields) + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """A record's header fields and its block, with the block digest checked."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    first, *lines = head.split(b"\r\n")
    if first + b"\r\n" != VERSION:
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(x.split(b": ", 1) for x in lines)
    block = rest[:int(fields[b"Content-Length"])]
    if b"WARC-Block-Digest" in fields and fields[b"WARC-Block-Digest"] != b"sha1:" + digest32(block).encode():
        raise ValueError("a record's block does not have its digest")
    return fields, block


def with_record_type(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``pages(id, url, payload)`` with ``refers_to``: of equal payloads of at
    least ``least_bytes`` bytes, the page of the smallest id is a response
    (null) and the others revisit it.

    Digests are counted with partial minima; only payloads that occur more
    than once are joined back, each of them ``SALT``-fold, so a payload of
    many pages spreads over as many tasks."""
    key = F.sha2(F.col(payload_col).cast("binary"), 256)
    rows = pages.withColumn("_key", key)
    first = (rows.where(F.octet_length(payload_col) >= least_bytes).groupBy("_key")
             .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))).drop("_n"))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col, "url"), F.lit(SALT)))
    other = F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return (rows.join(first, ["_key", "_salt"], "left")
            .withColumn("refers_to", F.when(other, F.col("_first"))).drop("_key", "_salt", "_first"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` to archives under ``folder`` and return
    the stored index.

    Payload: the text in UTF-8 (null: empty).  A null URL has no target
    header.  Rows without an id are revisits if a page with an id has the
    same payload, else responses.  Rows that repeat a response's id are
    responses too.  An empty table gives an empty index."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = with_record_type(src, "page_id", "payload", least_bytes).select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        out, path, at = None, "", 0
        try:
            for b in batches:
                for i in range(0, b.num_rows, SLICE):
                    s, index = b.slice(i, SLICE), []
                    for page, url, payload, refers in zip(s.column("page_id").to_pylist(), s.column("url").to_pylist(),
                                                          as_bytes(s.column("payload")), s.column("refers_to").to_pylist()):
                        if out is None or at >= file_bytes:
                            if out is not None:
                                out.close()
                            name = f"{uuid.uuid4().hex}.warc.gz"
                            out, path, at = store.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0
                            info = b"software: webcorpus\r\nformat: WARC File Format 1.1\r\n"
                            raw = header([(b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:uuid:%s>" % str(uuid.uuid4()).encode()),
                                          (b"WARC-Date", DATE), (b"Content-Type", b"application/warc-fields"),
                                          (b"Content-Length", b"%d" % len(info))]) + info + b"\r\n\r\n"
                            member = zlib.compress(raw, 1, 31)
                            out.write(member)
                            at += len(member)
                        digest = digest32(payload)
                        member = zlib.compress(record(page, url, payload, digest, refers), 1, 31)  # 31: a gzip member
                        out.write(member)
                        index.append((path, at, len(member), url, digest, len(payload), page,
                                      "response" if refers is None else "revisit", refers))
                        at += len(member)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*index), (
                            pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                        names=["path", "offset", "length", "url", "payload_digest", "payload_bytes", "page_id", "record_type", "refers_to"])
        finally:
            if out is not None:
                out.close()

    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def merged(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """Sorted (offset, length) → (offset, length, how many) of merged reads."""
    start = end = n = 0
    for offset, length in ranges:
        if n and (offset - end > GAP or offset + length - start > READ):
            yield start, end - start, n
            n = 0
        if not n:
            start = end = offset
        end, n = max(end, offset + length), n + 1
    if n:
        yield start, end - start, n


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Read the records that ``index`` lists (any subset of a stored index):
    ``path, offset, page_id, url, record_type, refers_to, payload_bytes,
    payload_digest`` and ``payload`` (null for revisits), all taken from the
    archives.  A record listed twice is returned twice."""
    # as many tasks as there are stretches of archive to read: rows of the index say little of that
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // STRETCH)
    tasks = max(tasks, index.sparkSession.sparkContext.defaultParallelism)
    wanted = index.select("path", F.floor(F.col("offset") / STRETCH).alias("stretch"), "offset", "length")
    wanted = wanted.repartition(min(tasks, 1 << 17), "path", "stretch").sortWithinPartitions("path", "offset").select("path", "offset", "length")
    names = ["path", "offset", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    schema = "path string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], f"{schema}, payload binary"

    def row(path: str, offset: int, member: bytes) -> tuple:
        fields, block = parse(zlib.decompress(member, 31))
        number = lambda k: int(fields[k]) if k in fields else None
        payload = block.split(b"\r\n\r\n", 1)[1]
        refers = number(b"WARC-X-Refers-To-Page-ID")
        uri = fields.get(b"WARC-Target-URI")
        said = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
        if refers is None and digest32(payload) != said:
            raise ValueError(f"{path} at {offset}: the payload does not have its digest")
        size = len(payload) if refers is None else number(b"WARC-X-Payload-Length")
        out = (path, offset, number(b"WARC-X-Page-ID"), None if uri is None else uri.decode(), fields[b"WARC-Type"].decode(), refers, size, said)
        return (*out, payload if refers is None else None) if with_payload else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = "", None
        for b in batches:
            paths, at = b.column("path").to_pylist(), 0
            ranges = list(zip(b.column("offset").to_pylist(), b.column("length").to_pylist()))
            while at < len(paths):
                end = next((i for i in range(at, len(paths)) if paths[i] != paths[at]), len(paths))
                if paths[at] != opened:
                    if source is not None:
                        source.close()
                    store, inner = pafs.FileSystem.from_uri(paths[at])
                    opened, source = paths[at], store.open_input_file(inner)
                for start, length, n in merged(ranges[at:end]):
                    source.seek(start)
                    data = source.read(length)
                    rows = [row(opened, o, data[o - start:o - start + k]) for o, k in ranges[at:at + n]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    at += n
        if source is not None:
            source.close()

    return wanted.mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder, as a URI: a path without a scheme is one of the session's default
    file system, as Spark itself takes it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/"))
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{re.sub('^file:/+', 'file:///', whole)}/warc-{uuid.uuid4().hex}"
