"""WARC records in ZIP packages: written by Spark tasks, read back by ranges.

A package is a ZIP archive with stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member per record, and ``indexes/index.cdxj`` with each record's offset and length in
that member.  ``write_packages`` lets every task write packages of about ``roll_bytes`` to the folder
under names of their own; the returned manifest, written as a table, lists those of successful tasks
only, so a lost executor leaves at most unlisted files.

``read_packages`` parses the ZIP and ZIP64 directories from the archive's tail, locates the members,
reads the index and spreads (package, offset, length) over the cluster; records are
then read by range, never extracting a member.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the largest id is the
response and the others revisit it; smaller ones are responses all.

Defined cases: null html is an empty payload.  A null id is written as such and sorts below all
others, so its record may refer to another; of rows tied on the largest id one is the response.  A null
url becomes the record's own URN; characters that would break a header line are escaped.  Extra
columns are ignored; an empty table gives no packages and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, scratch_path
from strata.llm.exact_dedup import assign_winners

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """(file system, path) of a URI or local path."""
    from pyarrow import fs
    if re.match(r"file:/[^/]", uri):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------- records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to: int | None,
           revisit: bool, date: str) -> bytes:
    urn = f"urn:page:{page_id if page_id is not None else 'null'}"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else urn
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{urn}>",
            f"WARC-Target-URI: {target}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to if refers_to is not None else 'null'}>"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn_id(value: str) -> int | None:
    tail = value.strip("<>").rpartition(":")[2]
    return None if tail == "null" else int(tail)


def parse_record(raw: bytes) -> dict:
    """One record's fields; the payload's digest is taken from its bytes and must agree with the header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit:
        own = hashlib.sha1(payload).hexdigest()
        if own != stated or len(payload) != length:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its header")
    return {"page_id": _urn_id(fields["warc-record-id"]), "url": fields["warc-target-uri"],
            "payload": None if revisit else payload, "payload_bytes": length, "payload_digest": stated,
            "record_type": fields["warc-type"], "refers_to": _urn_id(fields["warc-refers-to"]) if revisit else None}


# ---------------------------------------------------------------- packages

class PackageWriter:
    """One ZIP package: records go to the stored data member, the index follows on close."""

    def __init__(self, uri: str):
        self.uri = uri
        system, path = file_system(uri)
        self.file = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.offset = 0

    def add(self, raw: bytes, key: str, date: str) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.member.write(packed)
        entry = {"offset": self.offset, "length": len(packed), "filename": DATA}
        self.index.append(f"{key} {re.sub('[^0-9]', '', date)} {json.dumps(entry)}")
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index) + "\n")
        self.zip.close()
        self.file.close()
        return self.uri, len(self.index), self.offset


def members(read_at, size: int) -> dict[str, tuple[int, int]]:
    """name -> (data offset, size) of the stored members of a ZIP archive, from its (ZIP64) central directory.
    ``read_at(n, offset)`` reads a range."""
    tail_at = max(0, size - 65_557)
    tail = read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
    if 0xFFFF == entries or 0xFFFFFFFF in (length, start):
        locator = read_at(20, tail_at + at - 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = read_at(56, struct.unpack("<Q", locator[8:16])[0])
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack("<QQQ", end64[32:56])
    directory, out, p = read_at(length, start), {}, 0
    for _ in range(entries):
        if directory[p:p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[p + 10:p + 12])
        packed, plain, n_name, n_extra, n_note = struct.unpack("<IIHHH", directory[p + 20:p + 34])
        header, = struct.unpack("<I", directory[p + 42:p + 46])
        name = directory[p + 46:p + 46 + n_name].decode("utf-8")
        extra, e = directory[p + 46 + n_name:p + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[e:e + 4])
            if kind == 1:  # 64-bit values, present only for fields that are full, in this order
                q = e + 4
                for field in ("plain", "packed", "header"):
                    if {"plain": plain, "packed": packed, "header": header}[field] == 0xFFFFFFFF:
                        value, = struct.unpack("<Q", extra[q:q + 8])
                        q += 8
                        plain, packed, header = (value if field == "plain" else plain, value if field == "packed" else packed,
                                                 value if field == "header" else header)
            e += 4 + n
        if method == 0:
            local = read_at(30, header)
            name_len, extra_len = struct.unpack("<HH", local[26:30])
            out[name] = (header + 30 + name_len + extra_len, packed)
        p += 46 + n_name + n_extra + n_note
    return out


def read_index(read_at, size: int) -> Iterator[tuple[int, int]]:
    """(absolute offset, length) of every indexed record."""
    found = members(read_at, size)
    at, n = found[INDEX]
    for line in read_at(n, at).decode("utf-8").splitlines():
        entry = json.loads(line[line.index("{"):])
        base, whole = found[entry["filename"]]
        if entry["offset"] + entry["length"] > whole:
            raise ValueError("index points beyond its member")
        yield base + entry["offset"], entry["length"]


# ---------------------------------------------------------------- Spark

def package_tasks(folder: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, writer = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if writer is None:
                    writer = PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                writer.add(record(r["page_id"], r["url"], r["payload"] or b"", r["digest"], r["n_bytes"],
                                  r["refers_to"], r["revisit"], date), f"urn:page:{r['page_id']}", date)
                if writer.offset >= roll_bytes:
                    made.append(writer.close())
                    writer = None
        if writer is not None:
            made.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    return run


def write_packages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = 1000, roll_bytes: int = 64 << 20,
                   date: str = "2020-01-01T00:00:00Z", support: float = 1e-3) -> DataFrame:
    """Write the pages; returns the manifest (path, records, bytes) of the packages, as a stored table."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"),
                        F.octet_length(payload).cast("long").alias("n_bytes"))
    plain = rows.where(F.col("n_bytes") < min_revisit).withColumn("refers_to", F.lit(None).cast("long")).withColumn(
        "revisit", F.lit(False))
    shared = assign_winners(rows.where(F.col("n_bytes") >= min_revisit), "digest", "page_id", support)
    shared = shared.select("page_id", "url", F.when(F.col("kept"), F.col("payload")).alias("payload"), "digest", "n_bytes",
                           F.when(~F.col("kept"), F.col("keep_id")).alias("refers_to"), (~F.col("kept")).alias("revisit"))
    return materialize(plain.unionByName(shared).mapInArrow(package_tasks(folder, roll_bytes, date),
                                                            "path string, records long, bytes long"), "warc-manifest")


def _opened(uri: str):
    system, path = file_system(uri)
    return system.open_input_file(path)


def list_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            with _opened(uri) as f:
                found = list(read_index(lambda n, at: f.read_at(n, at), f.size()))
            yield pa.RecordBatch.from_arrays([pa.array([uri] * len(found), pa.string()), pa.array([x[0] for x in found], pa.int64()),
                                              pa.array([x[1] for x in found], pa.int64())], names=["path", "at", "length"])


def record_reader(with_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, f = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(start, 256).to_pylist():
                    if r["path"] != uri:
                        if f is not None:
                            f.close()
                        uri, f = r["path"], _opened(r["path"])
                    fields = parse_record(gzip.decompress(f.read_at(r["length"], r["at"])))
                    out.append(fields if with_payload else fields | {"payload": None})
                yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], k) for n, k in zip(names, kinds)], names=names)
        if f is not None:
            f.close()

    return run


def read_packages(manifest: DataFrame, with_payload: bool = True, range_bytes: int = 8 << 20, max_tasks: int = 100_000) -> DataFrame:
    """One row per record of the packages in ``manifest`` (path, and bytes if known): page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload (null for revisits).

    What a task has to read lies behind its rows, so the numbers of tasks come from the packages and their bytes, not from
    the size of the rows: four packages' indexes a task, then ``range_bytes`` of records (more beyond ``max_tasks`` tasks)."""
    n, size = manifest.agg(F.count("*"), F.sum("bytes") if "bytes" in manifest.columns else F.lit(None).cast("long")).first()
    places = (manifest.select("path").repartition(min(max_tasks, n // 4 + 1), "path")
              .mapInArrow(list_records, "path string, at long, length long"))
    if size is None:
        size = places.agg(F.sum("length")).first()[0] or 0
    range_bytes = max(range_bytes, size // max_tasks)
    spread = (places.repartition(size // range_bytes + 1, "path", F.floor(F.col("at") / range_bytes))
              .sortWithinPartitions("path", "at"))
    return spread.mapInArrow(record_reader(with_payload),
                             "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                             "refers_to long, payload binary")
