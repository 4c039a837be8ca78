"""WARC archives compressed record by record with Zstandard and a shared dictionary.

Writing: each partition of records becomes files of at most ``max_bytes`` in a folder that all
executors share; a file starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then one frame per record. File names carry a random part, and readers take the
names from the writer's committed manifest, so the files of a lost or repeated task are never
read. Reading: a task opens the archives that its part of the manifest names, each is decoded frame by
frame with its own dictionary, and headers, lengths and digests are checked; an archive that
breaks a rule raises ``WarcError``.

Of records with equal payloads of at least ``least_bytes`` the one with the largest id is the
response, the others revisit it (``assign_types``; its shuffle carries only ids and digests). The revisits are
joined to the pages on page_id: under Spark's broadcast threshold the html stays where it is, beyond it the pages
are exchanged once, html included.

Defined cases: a null html is the empty payload; a record with a null page_id is always
a response and nothing refers to it; of repeated rows of the largest id each is a response; an empty table writes no
archive and reads back empty; a payload of any length is one record (a file holds at least
one).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm.common import materialize
from costloom.session import own, stage_root

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
                 "payload binary")
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


class WarcError(ValueError):
    """An archive or a record breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(samples: list[bytes], size: int = 16384) -> bytes:
    """A dictionary from the samples' own bytes; empty if there are too few to train one."""
    if len(samples) < 8 or sum(map(len, samples)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def render(page_id: int | None, url: str | None, kind: str, refers_to: int | None, payload: bytes, digest: str, size: int) -> bytes:
    """One record; a revisit has an empty block and the digest and size of what it refers to."""
    block = payload if kind == "response" else b""
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
            "Content-Type: text/html; charset=utf-8"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """The fields of one record, checked."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    first, _, lines = (head + b"\r\n").partition(b"\r\n")
    if not sep or first != VERSION.encode():
        raise WarcError("not a WARC/1.1 record")
    fields, at = {}, 0
    for m in _HEADER.finditer(lines):
        if m.start() != at:
            raise WarcError("a header line is malformed")
        fields[m[1].decode().lower()], at = m[2].decode(), m.end()
    if at != len(lines):
        raise WarcError("a header line is malformed")
    try:
        kind, length = fields["warc-type"], int(fields["content-length"])
        scheme, _, digest = fields["warc-payload-digest"].partition(":")
        size, own = int(fields["x-payload-length"]), fields["warc-record-id"]
    except (KeyError, ValueError) as e:
        raise WarcError(f"a header is missing or no number: {e}") from e
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("the block's length is not its Content-Length")
    block = rest[:length]
    if scheme != "sha1" or (kind == "response" and (digest_of(block) != digest or size != length)):
        raise WarcError("the payload is not that of its digest")
    if kind not in ("response", "revisit") or (kind == "revisit" and (length or "warc-refers-to" not in fields)):
        raise WarcError("neither a response nor a revisit")

    def page(x: str) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d*)>", x)
        if not m:
            raise WarcError("a record's id is malformed")
        return int(m[1]) if m[1] else None

    return {"page_id": page(own), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": page(fields["warc-refers-to"]) if kind == "revisit" else None, "payload_bytes": size,
            "payload_digest": digest, "payload": block if kind == "response" else None}


def compressor(dictionary: bytes, level: int = 3) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=True, write_checksum=True)


def leading_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_archive(content: bytes) -> Iterator[dict]:
    """Records of one archive."""
    if len(content) < 8:
        raise WarcError("no leading frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC or 8 + size > len(content):
        raise WarcError("the leading frame holds no dictionary")
    dictionary = content[8:8 + size]
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # the format allows a compressed dictionary
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    view, at = memoryview(content), 8 + size
    while at < len(content):
        one = d.decompressobj()
        try:
            record = one.decompress(view[at:])
        except zstandard.ZstdError as e:
            raise WarcError(f"a frame cannot be decoded: {e}") from e
        if not one.eof:
            raise WarcError("the last frame is cut off")
        at = len(content) - len(one.unused_data)
        yield parse(record)


def assign_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, size, leader): leader is the page_id that the record refers to or, for
    a response, its own. Digest groups of one row need no join."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    keyed = materialize(pages.select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha1(payload)).alias("sha"),
                                     F.octet_length(payload).cast("long").alias("size")), "warc-digests")
    lead = materialize(keyed.where(F.col("size") >= least_bytes).groupBy("sha", "size")
                       .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-leaders")
    return keyed.join(lead, ["sha", "size"], "left").select("page_id", "sha", "size", F.coalesce("leader", "page_id").alias("leader"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, max_bytes: int = 8 << 20, samples: int = 2000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder`` (a URI that all
    executors reach); the manifest (path, records, bytes) that comes back is already written."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    leaders = materialize(assign_types(pages, least_bytes).where("page_id is not null and leader != page_id")
                          .select("page_id", "sha", "leader").distinct(), "warc-revisits")
    some = rows.limit(samples).select(F.substring("html", F.lit(1), F.lit(4096)).alias("h")).collect()
    dictionary = train_dictionary([r["h"].encode() for r in some])
    lead = leaders.select(F.col("page_id").alias("id"), F.col("sha").alias("digest"), "leader")
    sha = F.unhex(F.sha1(F.encode("html", "UTF-8")))
    # a revisit's payload stays at home: only its digest and length go on
    typed = (rows.withColumn("sha", sha).withColumn("size", F.octet_length("html").cast("long"))
             .join(lead, (F.col("page_id") == F.col("id")) & (F.col("sha") == F.col("digest")), "left")
             .select("page_id", "url", F.col("leader").alias("refers_to"), "sha", "size",
                     F.when(F.col("leader").isNull(), F.col("html")).alias("html"),
                     F.col("leader").isNotNull().alias("revisit")))
    # the folder's scheme decides which file system the tasks write with

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        comp, pending, size = compressor(dictionary), [], 0

        def flush() -> pa.RecordBatch:
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(leading_frame(dictionary))
                f.write(b"".join(pending))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(pending)], pa.int64()), pa.array([size], pa.int64())],
                                              ["path", "records", "bytes"])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "refers_to", "sha", "size", "revisit")]
            for page, url, refers, sha1, n, revisit, html in zip(*cols, b.column("html").cast(pa.binary()).to_pylist()):
                frame = comp.compress(render(page, url, "revisit" if revisit else "response", refers, html or b"",
                                             base64.b32encode(sha1).decode(), n))
                if pending and size + len(frame) > max_bytes:
                    yield flush()
                    pending, size = [], 0
                pending.append(frame)
                size += len(frame)
        if pending:
            yield flush()

    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
    return materialize(typed.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True, task_bytes: int = 64 << 20) -> DataFrame:
    """Records of the archives that ``manifest`` lists. Each task opens the paths of its part of
    the manifest, about ``task_bytes`` of archives, one archive at a time; only their total size
    passes the driver."""
    names = [f for f in RECORD_SCHEMA.split(", ") if with_payload or not f.startswith("payload binary")]
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [tuple(f.split(" ")) for f in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[t]) for n, t in fields], [n for n, _ in fields])

        for path in (p for b in batches for p in b.column("path").to_pylist()):
            fs, place = pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(place, compression=None) as f:
                content = f.read()
            rows, size = [], 0
            for r in read_archive(content):
                rows.append(r)
                size += r["payload_bytes"]
                if size > 16 << 20:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)

    parts = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    return manifest.select("path").repartition(parts, "path").mapInArrow(read, ", ".join(names))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    folder = own(spark, f"{stage_root(spark)}/warc-{uuid.uuid4().hex}")
    folder = folder if "://" in folder else re.sub(r"^(file:)?/+", "file:///", folder)
    manifest = write_archives(pages, folder, least_bytes)
    return read_archives(spark, manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
