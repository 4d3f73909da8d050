"""WARC records in ZIP packages, written and read back without extracting a package.

A package is a ZIP file with two stored members: `archive/data.warc.gz`, one gzip member per record, and
`indexes/index.jsonl`, which tells offset and length of every record in it. Packages are about `package_bytes` long; each is
a blob that Spark's text writer puts into the target folder, so its last byte, a line feed, is the ZIP comment.

Reading goes by ranges: the end of the file leads to the central directory, through the ZIP64 records where a package has
them; the directory leads to the stored members; the index leads to the records, and each task fetches the ranges of its
own records. File systems are those that pyarrow can open by URI (local, HDFS, S3, GCS).

Of records with equal payloads of at least `revisit_bytes`, the one with the smallest id is the response and the others
are revisits that refer to it and carry no payload. A missing payload is empty. Records without an id never are responses
to others' revisits: they revisit one that has an id, if there is any. Repeated ids with one payload are all responses.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import zipfile
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import slices, write_blobs
from wattline.session import materialize, new_path

REVISIT_BYTES = 100
PACKAGE_BYTES = 8 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"

#: Fixed by the ZIP format.
END = struct.Struct("<4s4H2LH")
END64_PLACE = struct.Struct("<4sLQL")
END64 = struct.Struct("<4sQ2H2L4Q")
ENTRY = struct.Struct("<4s6H3L5H2L")
LOCAL = struct.Struct("<4s5H3L2H")
STORED = 0


class Member(NamedTuple):
    name: str
    method: int
    place: int
    size: int


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI: " + "".join(c for c in url or "" if c not in "\r\n"),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def package(records: list[bytes]) -> bytes:
    """A ZIP package of gzipped records, without its last byte, which is a line feed."""
    lines, at = [], 0
    for r in records:
        lines.append(json.dumps({"offset": at, "length": len(r)}))
        at += len(r)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(zipfile.ZipInfo(DATA), b"".join(records))
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
        z.comment = b"\n"
    return out.getvalue()[:-1]


def _packages(package_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        done = lambda: pa.RecordBatch.from_arrays([pa.array([package(held)], pa.binary())], ["package"])
        for batch in batches:
            for part in slices(batch, "payload", 1 << 20):
                for row in part.to_pylist():
                    block = row["payload"] if row["refers_to"] is None else b""
                    raw = _record(row["page_id"], row["url"], block, row["digest"], row["size"], row["refers_to"])
                    record = gzip.compress(raw, 6, mtime=0)
                    if held and size + len(record) > package_bytes:
                        yield done()
                        held, size = [], 0
                    held.append(record)
                    size += len(record)
        if held:
            yield done()

    return run


def write(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    package_bytes: int = PACKAGE_BYTES,
) -> None:
    """Writes a record for each row of `pages` into packages below `path`."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    same = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
    )
    first = materialize(same.select("digest", "first"), "equal-payloads")
    refers_to = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    records = rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", "size", refers_to.alias("refers_to"))
    write_blobs(records.mapInArrow(_packages(package_bytes), "package binary"), path)


class Ranges:
    """Reads stretches of one file."""

    def __init__(self, uri: str, size: int):
        system, path = fs.FileSystem.from_uri(uri)
        self.file, self.size = system.open_input_file(path), size

    def __call__(self, place: int, length: int) -> bytes:
        data = self.file.read_at(length, place)
        if len(data) != length:
            raise ValueError(f"{length} bytes at {place} are not there")
        return data

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def directory(read: Ranges) -> list[Member]:
    """The members that the central directory lists, wherever ZIP64 fields say they are."""
    tail = read(start := max(0, read.size - END.size - 0xFFFF), read.size - start)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + END.size + END.unpack_from(tail, at)[7] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    *_, count, size, place, _ = END.unpack_from(tail, at)
    if 0xFFFF == count or 0xFFFFFFFF in (size, place):
        mark, _, end64, _ = END64_PLACE.unpack(read(start + at - END64_PLACE.size, END64_PLACE.size))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        *_, count, size, place = END64.unpack(read(end64, END64.size))
    data, members, at = read(place, size), [], 0
    for _ in range(count):
        entry = ENTRY.unpack_from(data, at)
        method, stored, plain, name, extra, comment, local = (entry[k] for k in (4, 8, 9, 10, 11, 12, 16))
        at += ENTRY.size
        text, fields = data[at : at + name], data[at + name : at + name + extra]
        at += name + extra + comment
        while len(fields) >= 4:
            kind, length = struct.unpack_from("<2H", fields)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", fields, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            fields = fields[4 + length :]
        head = LOCAL.unpack(read(local, LOCAL.size))
        members.append(Member(text.decode(), method, local + LOCAL.size + head[-2] + head[-1], stored))
    return members


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, size in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist(), strict=True):
            with Ranges(file, size) as read:
                members = {m.name: m for m in directory(read) if m.method == STORED}
                index, data = members[INDEX], members[DATA]
                entries = [json.loads(x) for x in read(index.place, index.size).splitlines()]
            columns = [
                pa.array([file] * len(entries)),
                pa.array([size] * len(entries), pa.int64()),
                pa.array([data.place + e["offset"] for e in entries], pa.int64()),
                pa.array([e["length"] for e in entries], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["file", "size", "place", "length"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    number = lambda text: int(text.rsplit(":", 1)[1][:-1]) if text and text[-2] != ":" else None
    for batch in batches:
        read, opened = None, None
        for start in range(0, batch.num_rows, 256):
            rows = []
            for r in batch.slice(start, 256).to_pylist():
                if r["file"] != opened:
                    read, opened = Ranges(r["file"], r["size"]), r["file"]
                fields, block = parse_record(gzip.decompress(read(r["place"], r["length"])))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                    raise ValueError(f"damaged record at {r['place']} of {r['file']}")
                rows.append(
                    (
                        number(fields["WARC-Record-ID"]),
                        fields["WARC-Target-URI"],
                        kind,
                        number(fields.get("WARC-Refers-To")),
                        int(fields["WARC-Payload-Length"]),
                        digest,
                        block if kind == "response" else None,
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the packages below `path`.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload); a revisit has no payload of its own.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))
    places = files.mapInArrow(_locate, "file string, size long, place long, length long")
    return places.mapInArrow(
        _fetch,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary",
    )


def save(pages: DataFrame, path: str | None = None, **options) -> str:
    """Writes `pages` and returns the folder."""
    path = path or new_path(pages.sparkSession, "warc-packages")
    write(pages, path, **options)
    return path
