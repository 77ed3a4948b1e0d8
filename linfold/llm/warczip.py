"""WARC records in ZIP packages, read in place.

A package is a ZIP file whose members are stored, not compressed: any number of ``archive/*.warc.gz``, in
which each WARC record is a gzip member of its own, and of ``indexes/*.cdxj``, a line for each record with
its file, offset and length. Members elsewhere in the package are not read. Readers find the members
through the ZIP directories and read byte ranges (the indexes of one package must fit a task):

1. the file's end for the end-of-directory record, or its ZIP64 form (sizes and places of 64 bits);
2. the central directory, with the ZIP64 extra fields, for place and method of each member;
3. each member's local header, for where its data starts; then the indexes, by range;
4. runs of records of at most ``SPLIT_BYTES``, which are dealt to tasks and read by range.

Nothing is extracted, and a package of any size is many tasks. An error that names the member is raised
where one is compressed, an index names no archive or two archives could be meant, or bytes of an archive
are in no record of the indexes or in two: no record is left out in silence. A record that several
indexes list is read once.

Files are opened through pyarrow by their full URI (the session's default file system completes a plain
path); a scheme that it does not know is an error, never a local path.

Writing: pages with equal payloads (of ``min_bytes`` or more) are one response, that with the
smallest page_id, and revisits that refer to it (one shuffle by digest; the side with the digests
has one row each, so a hot payload can be split). Each task writes packages of about
``PACKAGE_BYTES`` to the shared folder and returns their paths; only paths that a finished task
returned are read, so a lost or repeated task leaves files that nobody lists. Only the id, URL and
payload columns are read, so others may have any name; a very long payload is a package of its own.

Defined results: null payloads are empty. Null page ids are written, but nothing refers to them:
pages whose payload no page with an id has are responses. Rows that repeat with the smallest id are
responses each. Null URLs are empty; control characters in URLs are percent-coded. An empty table
writes no package and gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm.texts import batch_of, settled

ARCHIVES, INDEXES, FILE = "archive/", "indexes/", "data.warc.gz"
PACKAGE_BYTES = 1 << 24
SPLIT_BYTES = 1 << 22
#: Fixed values of the formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_MANY16, _MANY32 = 0xFFFF, 0xFFFFFFFF


def _files(path: str):
    """File system and path of a URI; a path without a scheme is local."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.\-]*):", path)
    if scheme is None or scheme[1].lower() == "file":
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path, flags=re.IGNORECASE)
    if not path.startswith(scheme[0] + "//"):
        raise ValueError(f"no file system is known for {path}")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))  # Hadoop's names of one scheme


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full URI, so that tasks mean the file system that the session means."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


# --- ZIP -----------------------------------------------------------------------------------------

def zip_bytes(members: list[tuple[str, bytes]], zip64: bool = True) -> bytes:
    """A ZIP file of stored members; with ``zip64`` all sizes and places are in 64-bit fields."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        place, title, crc = len(out), name.encode(), zlib.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if zip64 else b""
        size = _MANY32 if zip64 else len(data)
        out += _LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, 33, crc, size, size, len(title), len(extra))
        out += title + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), place) if zip64 else b""
        directory += _CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 33, crc, size, size, len(title),
                                            len(extra), 0, 0, 0, 0, _MANY32 if zip64 else place) + title + extra
    start, n = len(out), len(members)
    out += directory
    if zip64:
        end = len(out)
        out += _END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(directory), start)
        out += _LOCATOR64 + struct.pack("<IQI", 0, end, 1)
        n, size, start = _MANY16, _MANY32, _MANY32
    else:
        size = len(directory)
    out += _END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0)
    return bytes(out)


def members(file, size: int) -> dict[str, tuple[int, int, int]]:
    """Name -> (method, start of the data, size) from the central directory; ``file`` has ``read_at(n, offset)``."""
    tail_at = max(0, size - 22 - 65535)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if _MANY16 == count or _MANY32 in (length, start):
        locator = file.read_at(20, tail_at + at - 20)
        if locator[:4] != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end = file.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end[:4] != _END64:
            raise ValueError("no ZIP64 end of directory")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    directory, at, found = file.read_at(length, start), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != _CENTRAL:
            raise ValueError("a ZIP directory entry is broken")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        place, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n].decode()
        extra, e = directory[at + 46 + n:at + 46 + n + m], 0
        while e + 4 <= len(extra):
            kind, long = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # 64-bit values of the fields that are full, in this order
                values = iter(struct.unpack_from(f"<{long // 8}Q", extra, e + 4))
                plain = next(values) if plain == _MANY32 else plain
                packed = next(values) if packed == _MANY32 else packed
                place = next(values) if place == _MANY32 else place
            e += 4 + long
        local = file.read_at(30, place)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        a, b = struct.unpack_from("<HH", local, 26)
        found[name] = (method, place + 30 + a + b, packed)
        at += 46 + n + m + k
    return found


# --- WARC ------------------------------------------------------------------------------------------

def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response, or a revisit of ``refers_to`` (then without the payload), as a gzip member."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _uri(page_id)),
              ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and payload of one record."""
    data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}, payload


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ---------------------------------------------------------------------------------------

_PACKAGES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _write(folder: str, package_bytes: int, date: str):
    def run(batches):
        files, base = _files(folder)
        files.create_dir(base, recursive=True)
        context = TaskContext.get()
        data, index, number = bytearray(), [], 0

        def flush():
            nonlocal data, index, number
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.zip"
            body = zip_bytes([(ARCHIVES + FILE, bytes(data)), (INDEXES + "index.cdxj", "".join(json.dumps(x) + "\n" for x in index).encode())])
            with files.open_output_stream(f"{base}/{name}") as out:
                out.write(body)
            told = batch_of(_PACKAGES, [f"{folder}/{name}"], [len(index)], [len(body)])
            data, index, number = bytearray(), [], number + 1
            return told

        for batch in batches:
            rows = zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html", "refers_to")))
            for page_id, url, html, refers in rows:
                payload = (html.as_py() or "").encode()
                digest = sha1_base32(payload)
                made = record(page_id.as_py(), url.as_py(), payload, digest, refers.as_py(), date)
                index.append({"urn": _uri(page_id.as_py()), "digest": digest, "filename": FILE, "offset": len(data), "length": len(made)})
                data += made
                if len(data) >= package_bytes:
                    yield flush()
        if index:
            yield flush()
    return run


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row; (path, records, bytes) of the packages, which are complete when this returns."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html")})
    # Written before it is joined: a join of two plain scans is one whose hot payloads Spark can split.
    first = settled(rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first")), "digests")
    same = rows.join(first, "digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return settled(same.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(
        _write(_qualified(pages.sparkSession, folder), package_bytes, date), "path string, records long, bytes long"), "packages")


# --- reading ---------------------------------------------------------------------------------------

_SPLITS = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))])


def _listed(file, path: str) -> dict[str, tuple[int, list[tuple[int, int]]]]:
    """Archive -> (start of its data, its records' offsets and lengths in order), which cover it without a gap."""
    found = members(file, file.size())
    archives = {n: m for n, m in found.items() if n.startswith(ARCHIVES) and not n.endswith("/")}
    indexes = {n: m for n, m in found.items() if n.startswith(INDEXES) and n.endswith(".cdxj")}
    for name, (method, _, _) in [*archives.items(), *indexes.items()]:
        if method != 0 or name in archives and not name.endswith(".warc.gz"):
            raise ValueError(f"{path}: {name} is not a stored member of gzipped records")
    records: dict[str, set[tuple[int, int]]] = {n: set() for n in archives}
    for name, (_, at, size) in indexes.items():
        for line in file.read_at(size, at).splitlines():
            if not line.strip() or line.startswith(b"!"):  # a header line
                continue
            entry = json.loads(line[line.index(b"{"):])  # after the sort key and time, where they are given
            target = ARCHIVES + entry["filename"] if "filename" in entry else next(iter(archives), None)
            if target not in archives or ("filename" not in entry and len(archives) > 1):
                raise ValueError(f"{path}: {name} lists a record of no known archive")
            records[target].add((int(entry["offset"]), int(entry["length"])))
    out = {}
    for name, (_, at, size) in archives.items():
        end, ordered = 0, sorted(records[name])
        for offset, length in [*ordered, (size, 0)]:
            if offset != end:
                raise ValueError(f"{path}: the indexes do not cover {name} at byte {min(offset, end)}")
            end = offset + length
        out[name] = at, ordered
    return out


def _splits(split_bytes: int):
    """Runs of neighbouring records, from the directories and the indexes of each package."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = _files(path)
                with files.open_input_file(place) as file:
                    listed = _listed(file, path)
                for base, records in listed.values():
                    begin, lengths = 0, []
                    for offset, length in records:
                        if lengths and offset - begin >= split_bytes:
                            yield batch_of(_SPLITS, [path], [base + begin], [lengths])
                            begin, lengths = offset, []
                        lengths.append(length)
                    if lengths:
                        yield batch_of(_SPLITS, [path], [base + begin], [lengths])
    return run


_RECORDS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
                      ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
                      ("payload", pa.binary())])
_RECORDS_DDL = ("record_id string, record_type string, url string, payload_digest string, payload_bytes long, "
                "refers_to string, payload binary")


def _read(batches):
    for batch in batches:
        for path, start, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            files, place = _files(path)
            with files.open_input_file(place) as file:
                data = file.read_at(sum(lengths), start)
            cut = np.concatenate(([0], np.cumsum(lengths))).tolist()
            rows = []
            for a, z in zip(cut, cut[1:]):
                fields, http, payload = parse(data[a:z])
                digest, revisit = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "revisit"
                if not revisit and sha1_base32(payload) != digest:
                    raise ValueError(f"{path}: the payload of {fields['warc-record-id']} is not what its digest says")
                rows.append((fields["warc-record-id"], fields["warc-type"], fields["warc-target-uri"], digest,
                             int(http["content-length"]) if revisit else len(payload), fields.get("warc-refers-to"),
                             None if revisit else payload))
            yield batch_of(_RECORDS, *zip(*rows))


def read(spark: SparkSession, packages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the packages in ``packages`` (path): identity, type, digest, size and payload (null if revisited)."""
    tasks = spark.sparkContext.defaultParallelism
    splits = packages.select("path").repartition(tasks, "path").mapInArrow(
        _splits(split_bytes), "path string, start long, lengths array<long>")
    return splits.repartition(4 * tasks, "path", "start").mapInArrow(_read, _RECORDS_DDL)


def page_of(uri: str):
    """The page id that a record's URI names (null for a record without one)."""
    return F.nullif(F.regexp_extract(uri, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")
