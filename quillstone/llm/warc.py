"""WARC records in ZIP-packaged archives: a writer, and a reader that extracts nothing.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``,
in which each record is a gzip member of its own, ``indexes/index.cdxj``, a line for each
record with its sort key, date and place, and ``datapackage.json``, which names both with
their digests. The reader finds the end-of-central-directory
record, follows the ZIP64 locator where one is, parses the central directory, locates
the stored members, reads the index and then reads each record by its byte range.

A record's id is derived from its page and payload digest, so a revisit names its
response by that record's own id, and archives of equal pages have equal records.

Archives lie in the folder given, by default under ``spark.checkpoint.dir``, and are
opened through ``pyarrow.fs``; their names are unique to a task's attempt, so attempts
that are lost or repeated leave at most unreferenced files.
"""

from __future__ import annotations

import base64
import datetime
import functools
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import join_hot, scratch, stash

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: Bytes of compressed records after which an archive is closed; bounds the writer's memory.
ARCHIVE_BYTES = 32 << 20
_date = "2020-01-01T00:00:00Z"


# --- records ---------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page, digest: str) -> str:
    """The id of a page's record; pages without an id have records of equal ids where their payloads are equal."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def record(kind: str, uri: str, payload: bytes, digest: str, page=None, refers_to=None) -> bytes:
    """One WARC/1.1 record with an HTTP response block; a revisit holds the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id(page, digest), "WARC-Target-URI": "".join(x for x in uri if x >= " "), "WARC-Date": _date, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(refers_to, digest)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode("utf-8", "surrogatepass")
    return b"WARC/1.1\r\n" + lines + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def sort_key(url: str) -> str:
    """The index's key of a URL: host labels from the last on, then the path and query, without white space."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", "".join(url.split()).lower())
    host, slash, path = rest.partition("/")
    host, _, port = host.rpartition("@")[2].partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (slash or "/") + path


def packaged(data: bytes, index: list[tuple[str, dict]]) -> list[tuple[str, bytes]]:
    """The members of an archive: records, their index in the order of its keys, and the list of both."""
    stamp = re.sub(r"\D", "", _date)
    lines = "".join(f"{key} {stamp} {json.dumps(entry)}\n" for key, entry in sorted(index, key=lambda x: (x[0], x[1]["offset"]))).encode()
    named = [{"name": n.rpartition("/")[2], "path": n, "hash": f"sha256:{hashlib.sha256(x).hexdigest()}", "bytes": len(x)} for n, x in ((DATA, data), (INDEX, lines))]
    about = {"profile": "data-package", "wacz_version": "1.1.1", "created": _date, "resources": named}
    return [(DATA, data), (INDEX, lines), (PACKAGE, json.dumps(about).encode())]


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP header, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *fields = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.decode().lower(): v.strip().decode("utf-8", "surrogatepass") for k, _, v in (x.partition(b":") for x in fields)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


# --- ZIP -------------------------------------------------------------------


def zip_archive(members: list[tuple[str, bytes]], zip64: bool = True) -> list[bytes]:
    """The parts of a ZIP file of stored members, with ZIP64 fields and directory unless ``zip64`` is false."""
    parts, central, at = [], [], 0
    day = datetime.date(2020, 1, 1)
    dos = (day.year - 1980) << 9 | day.month << 5 | day.day
    for name, data in members:
        raw, crc, n = name.encode(), zlib.crc32(data), len(data)
        size, extra = (0xFFFFFFFF, struct.pack("<HHQQ", 1, 16, n, n)) if zip64 else (n, b"")
        local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45 if zip64 else 20, 0x800, 0, 0, dos, crc, size, size, len(raw), len(extra)) + raw + extra
        extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if zip64 else b""
        central.append(struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45 if zip64 else 20, 0x800, 0, 0, dos, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF if zip64 else at) + raw + extra)
        parts += [local, data]
        at += len(local) + n
    directory = b"".join(central)
    parts.append(directory)
    if zip64:
        parts.append(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, len(members), len(members), len(directory), at))
        parts.append(struct.pack("<4sIQI", b"PK\6\7", 0, at + len(directory), 1))
        parts.append(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
    else:
        parts.append(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, len(members), len(members), len(directory), at, 0))
    return parts


class Archive:
    """Range reads in a ZIP file: ``read_at(n, offset)`` is all that is asked of the file."""

    def __init__(self, file, size: int):
        self.file, self.members = file, {}
        tail_at = max(0, size - 65_557)
        tail = self.at(tail_at, size - tail_at)
        end = tail.rfind(b"PK\5\6")
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(b"PK\5\6", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            locator = self.at(tail_at + end - 20, 20)
            if locator[:4] != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            wide = self.at(struct.unpack_from("<Q", locator, 8)[0], 56)
            if wide[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 directory")
            count, length, start = struct.unpack_from("<QQQ", wide, 32)
        directory, at = self.at(start, length), 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\1\2":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
            where = struct.unpack_from("<I", directory, at + 42)[0]
            name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, x = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while x + 4 <= len(extra):
                tag, n = struct.unpack_from("<HH", extra, x)
                if tag == 1:
                    y = x + 4
                    if full == 0xFFFFFFFF:
                        full, y = struct.unpack_from("<Q", extra, y)[0], y + 8
                    if packed == 0xFFFFFFFF:
                        packed, y = struct.unpack_from("<Q", extra, y)[0], y + 8
                    if where == 0xFFFFFFFF:
                        where = struct.unpack_from("<Q", extra, y)[0]
                x += 4 + n
            self.members[name] = (method, where, packed)
            at += 46 + n_name + n_extra + n_note

    def at(self, offset: int, n: int) -> bytes:
        got = self.file.read_at(n, offset)
        if len(got) != n:
            raise ValueError("the archive ends early")
        return bytes(got)

    def locate(self, name: str) -> tuple[int, int]:
        """(offset, length) of a stored member's bytes in the archive."""
        method, where, size = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored")
        local = self.at(where, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError("no local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return where + 30 + n_name + n_extra, size

    def index(self) -> list[dict]:
        """The index's entries, in the order of their places."""
        lines = self.at(*self.locate(INDEX)).split(b"\n")
        return sorted((json.loads(x.split(b" ", 2)[2]) for x in lines if x), key=lambda e: e["offset"])

    @functools.cached_property
    def data(self) -> tuple[int, int]:
        return self.locate(DATA)

    def record(self, entry: dict) -> bytes:
        start, size = self.data
        if entry["offset"] + entry["length"] > size:
            raise ValueError("an entry points outside its member")
        return gzip.decompress(self.at(start + entry["offset"], entry["length"]))


# --- tables ----------------------------------------------------------------


def roles(pages: DataFrame, least: int) -> DataFrame:
    """(id, sha, refers_to, rows) of the pages that revisit another: of equal payloads of at least ``least`` bytes the largest id is the response.

    Any share of the pages may have one payload, so payloads with many pages are joined by a broadcast.
    """
    marks = stash(pages.where("id is not null").select("id", F.sha1(F.encode("html", "utf-8")).alias("sha"), F.octet_length("html").alias("n")), "payloads")
    total, marks = marks.count(), marks.where(F.col("n") >= least)
    first = marks.groupBy("sha").agg(F.max("id").alias("refers_to"), F.min("id").alias("lo"), F.count(F.lit(1)).alias("rows")).where("lo < refers_to").drop("lo")
    return join_hot(marks.select("id", "sha"), stash(first, "responses"), ["sha"], "rows", total).where("id < refers_to").groupBy("id", "sha", "refers_to").agg(F.count(F.lit(1)).alias("rows"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Write archives of a record per row into ``folder``; (path, records) for each archive.

    A null payload is empty. Repeated rows with the id of a response are responses as
    well; rows without an id are always responses. No rows write no archive.
    """
    held = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    role = stash(roles(held, least), "revisits")
    marked = join_hot(held.withColumn("_sha", F.sha1(F.encode("html", "utf-8"))), role.withColumnRenamed("sha", "_sha"), ["id", "_sha"], "rows", held.count(), "left").select("id", "url", "html", "refers_to")

    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(folder)
        data, index, n = [], [], 0

        def close():
            path = f"{base}/{uuid.uuid4().hex}.wacz"
            with fs.open_output_stream(path) as f:
                for part in zip_archive(packaged(b"".join(data), index)):
                    f.write(part)
            return pa.RecordBatch.from_arrays([pa.array([path.rpartition("/")[2]]), pa.array([len(index)], pa.int64())], names=["name", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, text, refers = (batch.column(k)[i].as_py() for k in range(4))
                payload = text.encode("utf-8", "surrogatepass")
                digest = payload_digest(payload)
                packed = gzip.compress(record("response" if refers is None else "revisit", url, payload, digest, page, refers), 6, mtime=0)
                index.append((sort_key(url), {"url": url, "mime": "text/html" if refers is None else "warc/revisit", "status": "200", "digest": f"sha1:{digest}", "filename": DATA.rpartition("/")[2], "offset": n, "length": len(packed), "page": page, "refers": refers}))
                data.append(packed)
                n += len(packed)
                if n >= ARCHIVE_BYTES:
                    yield close()
                    data, index, n = [], [], 0
        if index:
            yield close()

    fs, base = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    return stash(marked.mapInArrow(run, "name string, records long"), "archives")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record, by range reads.

    A response's bytes and digest come from the payload read; a revisit's from the
    response that it refers to, whose record id and digest must be those that it names.
    No archives give no rows.
    """

    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                path = f"{base}/{name}"
                with fs.open_input_file(path) as f:
                    archive = Archive(f, f.size())
                    out = []
                    for entry in archive.index():
                        headers, _, payload = parse_record(archive.record(entry))
                        if headers["warc-type"] == "response" and f"sha1:{payload_digest(payload)}" != headers["warc-payload-digest"]:
                            raise ValueError(f"a payload of {path} differs from its digest")
                        digest, of = headers["warc-payload-digest"][5:], entry["refers"]
                        if headers["warc-record-id"] != record_id(entry["page"], digest) or headers.get("warc-refers-to") != (None if of is None else record_id(of, digest)):
                            raise ValueError(f"the index of {path} names other records than it holds")
                        out.append((entry["page"], len(payload) if of is None else None, digest, headers["warc-type"], of))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    n = max(1, archives.count())
    spread = archives.select("name").repartition(min(n, 100_000), "name")
    got = stash(spread.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"), "records")
    whole = got.where("record_type = 'response'")
    revisits = got.where("record_type = 'revisit'").drop("payload_bytes")
    named = revisits.groupBy("refers_to", "payload_digest").agg(F.count(F.lit(1)).alias("rows"))
    responses = whole.where("page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("of_response")).distinct()
    responses = stash(named.join(responses, ["refers_to", "payload_digest"]), "referred")
    revisits = join_hot(revisits, responses, ["refers_to", "payload_digest"], "rows", got.count(), "left")
    revisits = revisits.withColumn("payload_bytes", F.when(F.col("of_response").isNull(), F.raise_error(F.lit("a revisit without its response")).cast("long")).otherwise(F.col("of_response")))
    return whole.unionByName(revisits.select(*whole.columns))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back. Null payloads are empty, a null id is a response, repeated rows are records of their
    own, an empty table gives no rows; other columns, whatever their names, are not read."""
    folder = f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    return read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder)
