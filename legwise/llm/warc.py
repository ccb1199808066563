"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks get byte ranges of the files.  A task looks for the gzip magic
in its range, checks a candidate by decoding the member's headers, and reads every
record that starts inside its range, past the range's end if need be.  No index and
no task over a whole file is needed.

Files are written and read through Arrow's file systems, so the folder may be in
any shared store that Arrow knows; it has to be one that all executors reach.  A
task names its files after itself and an attempt number of its own, and only files
of finished tasks are in the returned manifest, so lost executors leave nothing
that is read twice.

Defined results: null payloads are empty; of rows with equal payloads of at least
``least`` bytes the one with the largest id is the response and the others revisit
it; rows without an id are responses, and of rows that repeat the largest id all are; other input columns
are ignored.  Members that are not gzip are passed over; records whose headers, length or digest (SHA-1, SHA-256,
SHA-512 or MD5, in base 32 or hex; others are not checked) do not fit are left out and listed by ``rejects``.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.staging import shared_folder, stage

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
#: Bytes of a split, and compressed bytes after which a writer opens its next file.
SPLIT_BYTES, FILE_BYTES = 8 << 20, 256 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, record_type string, refers_to string, uri string, payload_digest string,"
    " payload_bytes bigint, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def _name(number: str) -> str:
    return f"<urn:x-record:{number}>"


def record(number: str | None, uri: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record as a gzip member.  A revisit keeps the HTTP header, with the payload's length, only."""
    kind = "response" if refers_to is None else "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += payload if refers_to is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name('' if number is None else number)}", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + quote(uri, safe="%/:=&?~#+!$,;'@()*[]"))
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _write(batches, folder: str):
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    prefix = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"
    out, path, written, number, files = None, "", 0, 0, []
    for batch in batches:
        for key, uri, payload, refers_to in zip(*[column.to_pylist() for column in batch.columns]):
            if out is None:
                path = f"{base}/{prefix}-{number:04d}.warc.gz"
                out, written, number = store.open_output_stream(path, compression=None), 0, number + 1
            member = record(key, uri, (payload or "").encode(), refers_to)
            out.write(member)
            written += len(member)
            if written >= FILE_BYTES:
                out.close()
                files.append((path, written))
                out = None
    if out is not None:
        out.close()
        files.append((path, written))
    paths, sizes = [f[0] for f in files], [f[1] for f in files]
    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])


def write(
    pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0
) -> DataFrame:
    """Write a record per row below ``folder``; the manifest (``path``, ``size``) of the files."""
    rows = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{uri}`").cast("string").alias("uri"),
        F.col(f"`{payload}`").cast("string").alias("payload"),
        F.sha1(F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")).alias("digest"),
        F.coalesce(F.octet_length(F.col(f"`{payload}`").cast("string")), F.lit(0)).alias("size"),
    )
    # written, so that Spark knows how few they are and joins them where the payloads are
    copies = stage(
        rows.where((F.col("size") >= least) & F.col("key").isNotNull())
        .groupBy("digest")
        .agg(F.max("key").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "kept"),
        "equal-payloads",
    )
    revisits = F.when(F.col("kept") != F.col("key"), F.col("kept"))
    linked = rows.join(copies, "digest", "left").select(
        F.col("key").cast("string"), "uri", "payload", F.when(F.col("size") >= least, revisits).cast("string").alias("refers_to")
    )
    return stage(linked.mapInArrow(lambda batches: _write(batches, folder), "path string, size bigint"), "warc-files")


class _Bytes:
    """A file read on in chunks; ``take`` and ``find`` work at a moving place."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        chunk = self.file.read(CHUNK)
        self.held += chunk
        return bool(chunk)

    def skip(self, count: int) -> None:
        self.held, self.at = self.held[count:], self.at + count

    def find(self, end: int) -> bool:
        """Move to the next gzip magic that begins before ``end``."""
        while self.at < end:
            place = self.held.find(MAGIC)
            if place >= 0:
                self.skip(place)
                return self.at < end
            self.skip(max(0, len(self.held) - 2))
            if not self.more():
                return False
        return False

    def member(self) -> bytes | None:
        """The decoded member that begins here, its end being the new place; None if it is none."""
        inflate, parts, used = zlib.decompressobj(31), [], 0
        length = 0
        while True:
            try:
                part = inflate.decompress(self.held[used : used + CHUNK])
            except zlib.error:
                return None
            used = min(len(self.held), used + CHUNK)
            parts.append(part)
            if length < 5 and not b"WARC/".startswith((head := b"".join(parts)[:5])):
                return None
            length += len(part)
            if inflate.eof:
                break
            if used == len(self.held) and not self.more():
                return None
        if length < 5:
            return None
        self.skip(used - len(inflate.unused_data))
        return b"".join(parts)


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def decode(member: bytes) -> tuple | None:
    """The values of ``RECORDS`` for one decoded member; None if its headers are no record's."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    if not re.match(rb"WARC/\d", head) or not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        return None
    stated = fields.get("warc-payload-digest") or None
    kind, http, payload, size = fields["warc-type"], b"", block, len(block)
    if "application/http" in fields.get("content-type", ""):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
    if kind == "revisit":
        payload, size = None, int(_fields(http).get("content-length", 0))
    elif stated is not None and not has_digest(payload, stated):
        raise Damaged(f"payload of {fields.get('warc-record-id')} does not have its digest")
    return (fields.get("warc-record-id"), kind, fields.get("warc-refers-to"), fields.get("warc-target-uri"), bare_digest(stated), size, payload)


class Damaged(ValueError):
    """A member that decodes as a record's would, but is not whole."""


def has_digest(payload: bytes, stated: str) -> bool:
    """Whether ``stated`` (``[algorithm:]digest`` in base 32 or hex, of any case) fits; unknown algorithms fit anything."""
    algorithm, _, digest = stated.rpartition(":")
    algorithm = algorithm.strip().lower().replace("-", "") or "sha1"
    if algorithm not in ("sha1", "sha256", "sha512", "md5"):
        return True
    found = hashlib.new(algorithm, payload).digest()
    return digest.strip().upper().rstrip("=") in (found.hex().upper(), b32encode(found).decode().rstrip("="))


def bare_digest(stated: str | None) -> str | None:
    """A SHA-1 digest in upper-case base 32 without its algorithm's name; any other as it is."""
    if stated is None:
        return None
    algorithm, _, digest = stated.rpartition(":")
    digest = digest.strip().upper()
    if algorithm.strip().lower() not in ("", "sha1", "sha-1"):
        return stated
    return b32encode(bytes.fromhex(digest)).decode() if re.fullmatch("[0-9A-F]{40}", digest) else digest


def records_between(file, begin: int, end: int, rejects: list | None = None) -> Iterator[tuple]:
    """The records that start in [begin, end); places and reasons of members that are none go to ``rejects``."""
    source = _Bytes(file, begin)
    while source.find(end):
        start = source.at
        member = source.member()
        try:
            row = decode(member) if member is not None else None
            reason = None if row is not None or member is None else "headers or length of no record"
        except Damaged as damage:
            row, reason = None, str(damage)
        if reason is not None and rejects is not None:
            rejects.append((start, reason))
        if row is not None:
            yield row
        elif source.at == start:
            source.skip(1)


def _read(batches, folder: str):
    store, _ = fs.FileSystem.from_uri(folder)
    names = [field.split()[0] for field in RECORDS.split(", ")]
    kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]

    def frame(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for path, begin, end in zip(*[column.to_pylist() for column in batch.columns]):
            rows, held = [], 0
            with store.open_input_file(path) as file:
                for row in records_between(file, begin, end):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held >= 8 * CHUNK or len(rows) >= 5000:
                        yield frame(rows)
                        rows, held = [], 0
            if rows:
                yield frame(rows)


def _splits(files: DataFrame, split_bytes: int) -> DataFrame:
    """Ranges of the files, one a task."""
    begins = F.expr(f"sequence(0L, greatest(size - 1, 0L), {split_bytes}L)")
    splits = files.where("size > 0").select("path", F.explode(begins).alias("begin"))
    splits = splits.select("path", "begin", (F.col("begin") + split_bytes).alias("end"))
    # as many tasks as ranges: the rows are small, so their number must not be left to their size
    return splits.repartition(max(1, splits.count()))


def read(files: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the files in a manifest, read in ranges of ``split_bytes``; ``rejects`` lists what is left out."""
    return _splits(files, split_bytes).mapInArrow(lambda batches: _read(batches, folder), RECORDS)


def rejects(files: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path``, ``place`` and ``reason`` of members that are no whole record: headers, length or digest do not fit."""

    def listed(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, begin, end in zip(*[column.to_pylist() for column in batch.columns]):
                found: list = []
                with store.open_input_file(path) as file:
                    for _ in records_between(file, begin, end, found):
                        pass
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())],
                    ["path", "place", "reason"],
                )

    return _splits(files, split_bytes).mapInArrow(listed, "path string, place bigint, reason string")


def record_number(name: str) -> Column:
    """The id that ``write`` put into a record name."""
    return F.nullif(F.regexp_extract(name, "^<urn:x-record:(.*)>$", 1), F.lit(""))


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
