"""WARC archives and a normaliser for gzip streams that hold a whole file in one member.

``write_archives`` writes records of an input's rows as one gzip member a file, as some crawlers and tools do;
such a file can only be read from its start. ``normalise`` inflates it once as a stream, rewrites every record
as a gzip member of its own and writes a sidecar index of offsets (one JSON line a record), after which any
record can be read alone. Neither holds more than one record and an inflate window in memory.

Records with equal payloads are written once: the one with the smallest key is a ``response``, the others are
``revisit`` records without a body that refer to it. The HTTP header block, kept in both, has the length.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from base64 import b32encode
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shared_dir, tasks
from .store import delete_file, open_input, write_file

#: Uncompressed bytes after which a writer begins another archive.
ARCHIVE_BYTES = 1 << 26
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = datetime(2024, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def sha1_base32(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """The bytes of one WARC record, its closing blank lines included."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    name = lambda k: f"<urn:row:{'' if k is None else k}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(key)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def inflate(file) -> Iterator[bytes]:
    """The plain bytes of a gzip file, member after member, in bounded pieces; raises if the last one is cut off."""
    d = zlib.decompressobj(31)
    fresh = True  # nothing of this member has been read
    while data := file.read(READ_BYTES):
        while data or d.unconsumed_tail:
            fresh = False
            yield d.decompress(data or d.unconsumed_tail, READ_BYTES)
            data = d.unconsumed_tail
            if d.eof:
                data = d.unused_data
                d, fresh = zlib.decompressobj(31), True
    while not fresh and not d.eof and (rest := d.decompress(b"", READ_BYTES)):
        yield rest
    if not fresh and not d.eof:
        raise ValueError("the archive ends inside a gzip member")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields in lower case, content, whole record) of each record of a plain WARC stream."""
    held = bytearray()

    def fill(n: int) -> bool:
        for piece in pieces:
            held.extend(piece)
            if len(held) >= n:
                return True
        return len(held) >= n

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        lines = held[:end].decode("utf-8").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        size = int(fields["content-length"])
        if not lines[0].startswith("WARC/") or len(held) < end + size + 8 and not fill(end + size + 8):
            raise ValueError("not a whole WARC record")
        yield fields, bytes(held[end + 4 : end + 4 + size]), bytes(held[: end + size + 8])
        del held[: end + size + 8]


def first_of_equals(df: DataFrame, key: str, digest: str, minimum: int, size: str) -> DataFrame:
    """Per digest with more than one row: ``digest, first`` (smallest key). Combined before the shuffle."""
    some = df.where(F.col(size) >= minimum).groupBy(digest).agg(F.min(key).alias("first"), F.count("*").alias("n"))
    return some.where("n > 1").select(digest, "first")


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", minimum: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row; returns ``uri`` of the monolithic archives.

    A null payload counts as empty, a null url leaves the target field out. Of rows with equal payloads of at
    least ``minimum`` bytes those with the smallest key are responses (so repeated rows of that key are too; a
    null key is larger than any), the others revisit it.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    narrow = rows.select("key", "digest", F.octet_length("payload").alias("size"))
    known = first_of_equals(narrow, "key", "digest", minimum, "size")
    rows = rows.join(known, "digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        parts, size = [], 0
        z = zlib.compressobj(6, zlib.DEFLATED, 31)

        def close() -> pa.RecordBatch:
            nonlocal parts, size, seq, z
            parts.append(z.flush())
            uri = write_file(folder, f"{task:06d}-{seq:06d}.warc.gz", parts)
            parts, size, seq, z = [], 0, seq + 1, zlib.compressobj(6, zlib.DEFLATED, 31)
            return pa.RecordBatch.from_pydict({"uri": [uri]})

        for batch in batches:
            for k, u, body, sha, first in zip(*(batch.column(n).to_pylist() for n in ("key", "url", "payload", "digest", "first")), strict=True):
                again = first is not None and k != first
                data = record(k, u, body, b32encode(sha).decode(), first, again)
                parts.append(z.compress(data))
                size += len(data)
                if size >= archive_bytes:
                    yield close()
        if size:
            yield close()

    return materialize(rows.mapInArrow(run, "uri string"), "warc-archives")


def normalise(archives: DataFrame, folder: str, keep_source: bool = False) -> DataFrame:
    """Rewrite archives (column ``uri``) record by record; returns ``uri, index_uri, records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                index: list[str] = []

                def members(source: str = source, index: list = index) -> Iterator[bytes]:
                    at = 0
                    with open_input(source) as f:
                        for fields, _, whole in split_records(inflate(f)):
                            z = zlib.compressobj(6, zlib.DEFLATED, 31)
                            data = z.compress(whole) + z.flush()
                            index.append(json.dumps({"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": at, "length": len(data)}) + "\n")
                            at += len(data)
                            yield data

                uri = write_file(folder, "records.warc.gz", members())
                index_uri = write_file(folder, "records.idx", "".join(index).encode())
                yield pa.RecordBatch.from_pydict({"source": [source], "uri": [uri], "index_uri": [index_uri], "records": [len(index)]})

    spread = archives.repartition(tasks(archives.sparkSession), "uri")  # by number: the rows are few and small, their files are not
    out = materialize(spread.mapInArrow(run, "source string, uri string, index_uri string, records long"), "warc-index")
    if not keep_source:  # only now, when no attempt can need them any more

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for source in batch.column(0).to_pylist():
                    try:
                        delete_file(source)
                    except FileNotFoundError:
                        pass  # an earlier attempt did it
                yield batch

        out.select("source").mapInArrow(drop, "source string").count()
    return out.drop("source")


def read_record(uri: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of a normalised archive, by its place in the index."""
    with open_input(uri) as f:
        f.seek(offset)
        fields, content, _ = next(split_records(iter([zlib.decompress(f.read(length), 31)])))
    return fields, content


def _row_id(name: str | None) -> int | None:
    return int(name[9:-1]) if name and len(name) > 10 else None


def read_archives(archives: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, payload_bytes, payload_digest, record_type, refers_to`` of each record that the indexes list.

    The digest of a response is computed from the payload that was read; a record whose digest differs from
    its header raises. A revisit's length and digest are those of its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["index_uri"]) as f:
                    index = [json.loads(x) for x in f.read().splitlines()]
                out: dict[str, list] = {"key": [], "payload_bytes": [], "payload_digest": [], "record_type": [], "refers_to": []}
                with open_input(row["uri"]) as f:
                    for entry in index:
                        f.seek(entry["offset"])
                        fields, content, _ = next(split_records(iter([zlib.decompress(f.read(entry["length"]), 31)])))
                        head, _, body = content.partition(b"\r\n\r\n")
                        size = int(next(x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if fields["warc-type"] == "response" and (len(body), sha1_base32(body)) != (size, digest):
                            raise ValueError(f"{row['uri']}: {fields['warc-record-id']} is damaged")
                        for name, value in zip(out, (_row_id(fields["warc-record-id"]), size, digest, fields["warc-type"], _row_id(fields.get("warc-refers-to"))), strict=True):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))

    spread = archives.repartition(tasks(archives.sparkSession), "uri")
    return spread.mapInArrow(run, "key long, payload_bytes long, payload_digest string, record_type string, refers_to long").withColumnRenamed("key", key)


def warc_round_trip(df: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", minimum: int = 0) -> DataFrame:
    """Write, normalise and read back a record for each row of ``df``."""
    folder = folder or shared_dir(df.sparkSession, "warc")
    return read_archives(normalise(write_archives(df, folder, key, url, payload, minimum), folder), key)
