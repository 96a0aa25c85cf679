"""Zstandard-compressed WARC archives: writer and validating reader.

An archive starts with a skippable frame that holds the compression
dictionary, followed by one Zstandard frame per record, so a reader needs
nothing but the file and can stop or start at any frame.  Writer tasks
stream their partition into archives on the shared file system (a temporary
name, then a rename); reader tasks stream archives frame by frame.  Memory
is bounded by one record plus a read buffer.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from mercato.llm.common import arrow_batches, hash_sample, text_of, written

# Fixed values of the WARC 1.1 and Zstandard formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
FORMATTED_DICTIONARY = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

SAMPLE_PAGES = 256         # pages the dictionary is trained on, at most
SAMPLE_CHARS = 1 << 16     # longest page that may be in the sample
DICTIONARY_BYTES = 1 << 15
ARCHIVE_BYTES = 256 << 20  # compressed size after which the writer opens the next archive
READ_BYTES = 1 << 16

RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                 "target_uri string, archive string, offset long, problem string")


class DamagedRecord(ValueError):
    """A frame, header, length or digest that does not hold."""


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 refers_url: str | None, digest: str, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_uri(page_id)),
              ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%~")),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to)),
                   ("WARC-Refers-To-Target-URI", quote(refers_url or "about:blank", safe=":/?#[]@!$&'()*+,;=%~")),
                   ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a record after checking its version line, headers, lengths and digest."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] != "WARC/1.1":
        raise DamagedRecord("no WARC/1.1 header")
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if not colon or k.lower() in fields:
            raise DamagedRecord(f"bad header line {line[:60]!r}")
        fields[k.lower()] = v.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - fields.keys()
    if missing or not fields["content-length"].isdigit():
        raise DamagedRecord(f"headers missing or malformed: {sorted(missing)}")
    size, kind = int(fields["content-length"]), fields["warc-type"]
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise DamagedRecord(f"Content-Length {size} does not match the record")
    http, sep, payload = rest[:size].partition(b"\r\n\r\n")
    stated = dict(x.lower().split(": ", 1) for x in http.decode().split("\r\n")[1:] if ": " in x).get("content-length", "")
    if not sep or not stated.isdigit():
        raise DamagedRecord("no HTTP head with a length")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(stated):
            raise DamagedRecord("HTTP length does not match the payload")
        if bare_digest(payload) != digest:
            raise DamagedRecord("payload digest does not match")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields or fields.get("warc-profile") != REVISIT_PROFILE:
            raise DamagedRecord("not a revisit of an identical payload")
    else:
        raise DamagedRecord(f"unexpected record type {kind!r}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("x-page-id"), "payload_bytes": int(stated), "payload_digest": digest,
            "record_type": kind, "refers_to": number("x-refers-to-page-id"),
            "target_uri": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None}


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def as_dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    if content[:4] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompress(content)
    formatted = content[:4] == FORMATTED_DICTIONARY
    return zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_FULLDICT if formatted else zstandard.DICT_TYPE_RAWCONTENT)


def frames(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame after the dictionary frame."""
    lead = stream.read(8)
    if len(lead) < 8 or struct.unpack("<I", lead[:4])[0] != DICTIONARY_MAGIC:
        raise DamagedRecord("the archive does not start with a dictionary frame")
    size = struct.unpack("<I", lead[4:])[0]
    content = stream.read(size)
    if len(content) != size:
        raise DamagedRecord("truncated dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=as_dictionary(content))
    at, left = 8 + size, stream.read(READ_BYTES)
    while left:
        one, parts, used = reader.decompressobj(), [], 0
        while True:
            try:
                parts.append(one.decompress(left))
            except zstandard.ZstdError as e:
                raise DamagedRecord(f"frame at {at}: {e}") from e
            used += len(left)
            if one.eof:
                break
            left = stream.read(READ_BYTES)
            if not left:
                raise DamagedRecord(f"frame at {at} is truncated")
        left = one.unused_data
        yield at, b"".join(parts)
        at += used - len(left)
        left = left or stream.read(READ_BYTES)


def train_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary from a bounded sample: SAMPLE_PAGES pages of up to SAMPLE_CHARS, by a hash of the row number."""
    body = text_of(html_col)
    short = pages.select(body.alias("body")).filter(F.length("body") <= SAMPLE_CHARS)
    rows = hash_sample(short, SAMPLE_PAGES, F.xxhash64(F.monotonically_increasing_id())).collect()
    samples = [record_bytes(i, f"http://www.example.org/{i}", p := r["body"].encode("utf-8", "replace"), None, None,
                            bare_digest(p), False) for i, r in enumerate(rows)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the sample itself serves as raw content
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_from_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row into archives under ``path``; returns (archive, records, bytes).

    Of rows whose payloads are equal and at least ``revisit_from_bytes``
    long, the one with the smallest id is a response and the others are
    revisits of it; a row without id counts as larger than any other, and
    when no row of a group has an id all are responses, as are repeated
    rows of the smallest id.  Null html is an empty payload, null url is
    about:blank.  The url and html travel in one shuffle, by payload digest;
    a hot payload is one row of the joined side, and AQE splits the other.
    """
    arrow_batches(pages.sparkSession)
    store, root = pafs.FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)
    dictionary = train_dictionary(pages, html_col)
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_of(html_col).alias("html"))
    base = base.withColumn("key", F.sha2("html", 256))
    # written, so that the join reads two plain shuffles and the rows of a hot payload can be split
    groups = written(base.filter(F.octet_length("html") >= revisit_from_bytes).groupBy("key").agg(
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "url"))).alias("first")), "payloads")
    rows = (base.join(groups, "key", "left")
            .select("id", "url", "html", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"))
            .sortWithinPartitions("id", "url", "html"))  # the same archives on every attempt

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, out, name = TaskContext.get(), 0, None, None
        store, root = pafs.FileSystem.from_uri(path)
        packer = zstandard.ZstdCompressor(level=3, dict_data=as_dictionary(dictionary), write_checksum=True)
        done, count, size = [], 0, 0

        def close() -> None:
            out.close()
            store.move(f"{root}/_{name}.{task.taskAttemptId()}", f"{root}/{name}")
            done.append((name, count, size))

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for id_, url, html, first_id, first_url in zip(*cols):
                if out is None:
                    name, count = f"part-{task.partitionId():06d}-{number:04d}.warc.zst", 0
                    out = store.open_output_stream(f"{root}/_{name}.{task.taskAttemptId()}", compression=None)
                    size = out.write(dictionary_frame(dictionary)) or len(dictionary) + 8
                payload = html.encode("utf-8", "surrogatepass")
                revisit = first_id is not None and id_ != first_id
                frame = packer.compress(record_bytes(id_, url, payload, first_id if revisit else None, first_url,
                                                     bare_digest(payload), revisit))
                out.write(frame)
                count, size = count + 1, size + len(frame)
                if size >= archive_bytes:
                    close()
                    out, number = None, number + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], names=["archive", "records", "bytes"])

    return rows.mapInArrow(run, "archive string, records long, bytes long")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, strict: bool = True) -> DataFrame:
    """Every record of the archives under ``path``, headers, lengths and digests checked.

    A damaged record ends its archive (later frame bounds can't be trusted):
    with ``strict`` the job fails naming archive and reason, else the archive
    ends with one row whose ``problem`` says what is wrong.  An archive of
    the dictionary alone has no records; a folder without archives gives an
    empty result.
    """
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    arrow_types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                   pa.string(), pa.binary()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, arrow_types)],
                                          names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column("path").to_pylist():
                rows, held = [], 0
                fs, at = pafs.FileSystem.from_uri(archive)
                with fs.open_input_stream(at, compression=None) as stream:
                    offset = 0
                    try:
                        for offset, raw in frames(stream):
                            rows.append(parse_record(raw) | {"archive": archive, "offset": offset})
                            held += len(raw) * with_payload
                            if len(rows) >= 4096 or held > 16 << 20:
                                yield batch(rows)
                                rows, held = [], 0
                    except (DamagedRecord, UnicodeDecodeError) as e:
                        if strict:
                            raise DamagedRecord(f"{archive}, after offset {offset}: {e}") from e
                        rows.append({"archive": archive, "offset": offset, "problem": str(e)})
                yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).select("path")
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, path: str, **columns: str) -> DataFrame:
    """Write ``pages`` as archives under ``path`` and read them back."""
    expected = write_archives(pages, path, **columns).agg(F.sum("records")).first()[0] or 0
    records = read_archives(pages.sparkSession, path)
    if (found := records.count()) != expected:
        raise DamagedRecord(f"{path} holds {found} records; {expected} were written")
    return records
