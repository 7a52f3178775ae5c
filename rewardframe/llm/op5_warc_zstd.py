"""WARC archives in Zstandard: one frame per record, dictionary in a leading skippable frame.

Writer: records are dealt into archives of about ``archive_bytes``; each starts with a
skippable frame (magic 0x184D2A5D) holding the dictionary, which is trained on a bounded
sample, and compresses each record as a frame of its own.  Of records with equal payloads
of at least ``min_bytes`` bytes the one of smallest id is the response and the others are
revisits without payload.  Archives are files ``*.warc.zst`` in the shared folder (or one given),
written by a Python data source: each task streams frames into files of a hidden temporary
name, and the commit renames the files of the attempts that counted, so a lost or repeated
task leaves no record twice.  Folders are reached through ``pyarrow.fs`` (local or mounted
paths, ``file:``, ``hdfs:``, ``s3:``, ``gs:``).

Reader: loads the dictionary, decodes frame by frame (never a whole archive at once),
and checks the version line, the headers, Content-Length against the record and, for
responses, the payload's digest.  A broken archive raises an error that names the record.

Defined cases: null payloads are empty; null ids are written as an empty header and read
as null (among equal payloads a null id comes last); repeated rows are records of their
own, one of them the response; null urls are kept; an empty table gives no archives;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import common as C

MAGIC = 0x184D2A5D
ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 1 << 15
DICT_SAMPLE_ROWS = 400
DICT_SAMPLE_BYTES = 1 << 15
FEED = 1 << 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def trained_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Dictionary from sample payloads; empty if they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _clean(x: str) -> str:
    """Header values hold no line ends or other controls: those are percent-coded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in x)


def _restored(x: str) -> str:
    parts = x.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit has the full payload's digest and length, no body."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body; raises ValueError on any broken part."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("record without the end of its headers")
    lines = raw[:end].decode("utf-8").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"unknown version line {lines[0]!r}")
    head: dict[str, str] = {}
    for x in lines[1:]:
        name, colon, value = x.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"broken header line {x!r}")
        head[name.strip().lower()] = value.strip()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in head:
            raise ValueError(f"header {need} is missing")
    if not head["content-length"].isdigit():
        raise ValueError(f"broken Content-Length {head['content-length']!r}")
    n = int(head["content-length"])
    if len(raw) != end + 4 + n + 4 or raw[-4:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {n} does not fit a record of {len(raw)} bytes")
    return head, raw[end + 4: end + 4 + n]


def split_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The leading skippable frame's dictionary and where the records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != MAGIC:
        raise ValueError("no leading skippable frame with a dictionary")
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise ValueError("the dictionary frame is cut off")
    return bytes(data[8: 8 + size]), 8 + size


def frames(content: bytes) -> Iterator[bytes]:
    """Decoded records of one archive, frame by frame."""
    data = memoryview(content)
    raw, at = split_dictionary(data)
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
    while at < len(data):
        one = d.decompressobj()
        out = []
        while not one.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut off")
            piece = data[at: at + FEED]
            out.append(one.decompress(piece))
            at += len(piece) - (len(one.unused_data) if one.eof else 0)
        yield b"".join(out)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there."""
    if re.match(r"file:/|/", folder):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", folder).strip("/")
    return fs.FileSystem.from_uri(folder)


class Written(WriterCommitMessage):
    """Names of the archives that one task wrote."""

    def __init__(self, names: list[str]):
        self.names = names


class ArchiveWriter(DataSourceArrowWriter):
    """Records to archives; an archive grows to about ``archive_bytes``, and a record alone
    may pass them.  Only the frame at hand is in memory."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.archive_bytes = options["path"], int(options["archive_bytes"])
        self.dictionary = base64.b64decode(options["dictionary"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = file_system(self.folder)
        files.create_dir(folder, recursive=True)
        shared = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
        press = zstandard.ZstdCompressor(level=6, dict_data=shared) if shared else zstandard.ZstdCompressor(level=6)
        lead = struct.pack("<II", MAGIC, len(self.dictionary)) + self.dictionary
        tag = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        names, out, size = [], None, 0
        for b in iterator:
            cols = [b.column(k) for k in ("page_id", "url", "payload", "record_type", "refers_to")]
            for i in range(b.num_rows):
                frame = press.compress(record_bytes(*(c[i].as_py() for c in cols)))
                if out and size + len(frame) > self.archive_bytes:
                    out.close()
                    out = None
                if not out:
                    names.append(f"{tag}-{len(names):05d}.warc.zst")
                    out, size = files.open_output_stream(posixpath.join(folder, "_" + names[-1]), compression=None), len(lead)
                    out.write(lead)
                out.write(frame)
                size += len(frame)
        if out:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = file_system(self.folder)
        files.create_dir(folder, recursive=True)
        for m in messages:
            for name in m.names if m else ():
                files.move(posixpath.join(folder, "_" + name), posixpath.join(folder, name))

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = file_system(self.folder)
        for m in messages:
            for name in m.names if m else ():
                files.delete_file(posixpath.join(folder, "_" + name))


class Archives(DataSource):
    """``df.write.format("warc_zstd")``."""

    @classmethod
    def name(cls) -> str:
        return "warc_zstd"

    def schema(self) -> str:
        return "page_id long, url string, payload binary, record_type string, refers_to long"

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("archives are only added to a folder")
        return ArchiveWriter(self.options)


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None) -> str:
    """Write the archives and return their folder, by default a new one in the shared folder."""
    spark = pages.sparkSession
    p = F.col(f"`{payload_col}`")
    payload = F.coalesce(p if pages.schema[payload_col].dataType.simpleString() == "binary" else F.encode(p.cast("string"), "UTF-8"), F.lit(b""))
    src = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    # the sample's keys first: only its own payloads then go to the driver, not a sample of each task's
    pick = src.withColumn("pick", F.xxhash64("payload", "page_id"))
    keys = [r.pick for r in pick.select("pick").distinct().orderBy("pick").limit(DICT_SAMPLE_ROWS).collect()]
    few = pick.where(F.col("pick").isin(keys)).select("pick", F.substring("payload", 1, DICT_SAMPLE_BYTES).alias("s")).dropDuplicates(["pick"]) if keys else None
    dictionary = trained_dictionary([bytes(r.s) for r in few.collect()] if keys else [])
    keyed = src.withColumn("sum", F.sha2("payload", 256)).withColumn("rid", F.coalesce("page_id", F.xxhash64("url", "payload")))
    # narrow: which record answers for each payload that occurs twice or more
    first = keyed.where(F.octet_length("payload") >= min_bytes).groupBy("sum").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sum", "first")
    first = C.stored(first, "op5-first")
    rows = keyed.join(first, "sum", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")) \
        .withColumn("refers_to", F.when(revisit, F.col("first"))).select("page_id", "url", "payload", "record_type", "refers_to")
    folder = folder or f"{C.ensure_checkpoint_dir(spark).rstrip('/')}/op5-warc-{uuid.uuid4().hex}"
    spark.dataSource.register(Archives)
    rows.write.format("warc_zstd").mode("append").option("archive_bytes", archive_bytes) \
        .option("dictionary", base64.b64encode(dictionary).decode()).save(folder)
    return folder


def _read_fn(with_payload: bool):
    def number(x: str | None) -> int | None:
        x = (x or "").removeprefix("<urn:page:").removesuffix(">")
        return int(x) if x else None

    def fn(batches):
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                rows, size = [], 0
                for k, raw in enumerate(frames(content.as_py())):
                    try:
                        head, body = parse_record(raw)
                        said = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        if head["warc-type"] == "response" and said and said != digest(body):
                            raise ValueError("the payload does not match its digest")
                    except ValueError as e:
                        raise ValueError(f"{path.as_py()}, record {k}: {e}") from e
                    full = int(head.get("x-payload-length", len(body)))
                    url = head.get("warc-target-uri")
                    rows.append((number(head["warc-record-id"]), None if url is None else _restored(url), full, said or digest(body),
                                 head["warc-type"], number(head.get("warc-refers-to")), body if with_payload else None))
                    size += len(body) if with_payload else 64
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)
    return fn


_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of archives given as rows with ``path`` and ``content``."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return archives.select("path", "content").mapInArrow(_read_fn(with_payload), schema)


def open_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the ``*.warc.zst`` files of a folder, on any file system Spark reads."""
    return read_archives(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder), with_payload)


def op5_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every page written to archives and read back."""
    return open_archives(spark, write_archives(C.read(spark, sf_dir, "pages")), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((('0x' || substr(h, {5 * i + 1}, 5))::INT >> {s}) & 31) + 1 AS INT), 1)"
    for i in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""
