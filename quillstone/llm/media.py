"""Media columns: payloads stored as WAV, cut into content-defined chunks that are stored once.

Chunks. A gear hash rolls over the media's bytes: after byte i it is the sum of
G[b[i - k]] << k over the last 32 bytes, modulo 2^32, so a cut depends on 32 bytes only
and equal passages are cut alike. A cut is made after a byte whose hash has its top
bits zero, at least MIN and at most MAX bytes after the last.

Store. Digests are grouped by a Spark aggregation; those that occur once stay in line
in their media's ordered chunk list, and the rest are deduplicated into a chunk table
by digest. Which digests repeat reaches the tasks as a bitmap of fixed size, so no
payload is shuffled to find that out; a digest that the bitmap wrongly marks only goes
the longer way through the chunk table.

Reading. Distinct chunk lists with chunks in the table are joined to it, put in order
and checked against the media's SHA-256; then the payload is parsed out of the stored
form and its features are computed from these bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import stash

UNIT = 192
MIN, TOP_BITS, MAX = 1024, 12, 32_768
#: Bits of the bitmap of repeated digests, as a power of two; 2^26 bits are 8 MB.
BITMAP = 26

_gear = np.frombuffer(hashlib.shake_256(b"gear").digest(1024), "<u4")


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; no chunk for no bytes."""
    n = len(data)
    if not n:
        return []
    h = _gear[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        if n > step:
            nxt = h.copy()
            nxt[step:] += h[:-step] << np.uint32(step)
            h = nxt
    out, last = [], 0
    for end in (np.flatnonzero(h < np.uint32(1 << (32 - TOP_BITS))) + 1).tolist():
        while end - last > MAX:
            last += MAX
            out.append(last)
        if end - last >= MIN:
            out.append(end)
            last = end
    while n - last > MAX:
        last += MAX
        out.append(last)
    if last < n:
        out.append(n)
    return out


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def wav(payload: bytes, rate: int = 8000) -> bytes:
    """A mono WAV file whose 8-bit samples are the payload."""
    pad = len(payload) & 1
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + b"\0" * pad


def samples(media: bytes) -> bytes:
    """The samples of a WAV file, found by walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no samples")


def feature(payload: bytes) -> str:
    """A 16-bin histogram of the samples in thousandths, their mean and their spread."""
    s = np.frombuffer(payload, np.uint8)
    bins = np.bincount(s >> 4, minlength=16) * 1000 // len(s)
    total, square = int(s.sum(dtype=np.int64)), int((s.astype(np.int64) ** 2).sum())
    spread = square / len(s) - (total / len(s)) ** 2
    return "-".join(map(str, bins.tolist())) + f"|{total / len(s):.4f}|{max(0.0, spread) ** 0.5:.4f}"


def digest(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()[:20]


def _slot(d: bytes) -> int:
    return int.from_bytes(d[:8], "little") & ((1 << BITMAP) - 1)


def _read(media: bytes, sha: str) -> tuple:
    if hashlib.sha256(media).hexdigest() != sha:
        raise ValueError(f"the chunks do not restore media {sha}")
    payload = samples(media)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), feature(payload)


_READ = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"


def _read_columns(rows: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    return [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]


def _each_media(batch, at: int = 1):
    for i in range(batch.num_rows):
        n, payload = padded(batch.column(at)[i].as_py())
        yield i, n, wav(payload)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The media table (id, n_bytes, media_sha256, chunks) and the chunk table (digest, data), both written.

    ``chunks`` is the ordered list of (digest, data); data is null where it is in the chunk table.
    """
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, sc = docs.schema[id_col].dataType.simpleString(), docs.sparkSession.sparkContext

    def digests(batches):
        for batch in batches:
            out = []
            for _, _, media in _each_media(batch, 0):
                last = 0
                for end in cuts(media):
                    out.append(digest(media[last:end]))
                    last = end
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["digest"])

    repeated = held.select("text").mapInArrow(digests, "digest binary").groupBy("digest").count().where("count > 1")

    def slots(batches):
        for batch in batches:
            s = np.array([_slot(d) for d in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s >> 5), pa.array(np.int64(1) << (s & 31))], names=["word", "bit"])

    words = repeated.select("digest").mapInArrow(slots, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP - 5), np.uint32)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    sent = sc.broadcast(bitmap)

    def chunked(batches):
        marks = sent.value
        sent_here: set[bytes] = set()
        for batch in batches:
            ids, sizes, shas, lists, keys, loose = [], [], [], [], [], []
            room = 0
            for i, n, media in _each_media(batch):
                last, parts = 0, []
                for end in cuts(media):
                    data = media[last:end]
                    d, last = digest(data), end
                    s = _slot(d)
                    if int(marks[s >> 5]) >> (s & 31) & 1:
                        parts.append({"digest": d, "data": None})
                        if d not in sent_here:
                            if len(sent_here) > 200_000:
                                sent_here.clear()
                            sent_here.add(d)
                            keys.append(d)
                            loose.append(data)
                    else:
                        parts.append({"digest": d, "data": data})
                ids.append(i)
                sizes.append(n)
                shas.append(hashlib.sha256(media).hexdigest())
                lists.append(parts)
                room += len(media)
                if room > 8_000_000:
                    yield from rows(batch, ids, sizes, shas, lists, keys, loose)
                    ids, sizes, shas, lists, keys, loose, room = [], [], [], [], [], [], 0
            yield from rows(batch, ids, sizes, shas, lists, keys, loose)

    part = pa.list_(pa.struct([("digest", pa.binary()), ("data", pa.binary())]))

    def rows(batch, ids, sizes, shas, lists, keys, loose):
        names = ["id", "n_bytes", "media_sha256", "chunks", "digest", "data"]
        if ids:
            empty = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(lists, part), pa.array(empty, pa.binary()), pa.array(empty, pa.binary())], names=names)
        if keys:
            empty = [None] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(empty, batch.column(0).type), pa.array(empty, pa.int64()), pa.array(empty, pa.string()), pa.array(empty, part), pa.array(keys, pa.binary()), pa.array(loose, pa.binary())], names=names)

    both = stash(held.mapInArrow(chunked, f"id {kind}, n_bytes long, media_sha256 string, chunks array<struct<digest:binary,data:binary>>, digest binary, data binary"), "media", compression="zstd")
    chunks = stash(both.where("digest is not null").select("digest", "data").dropDuplicates(["digest"]), "chunks", compression="zstd")
    return both.where("media_sha256 is not null").drop("digest", "data"), chunks


def read(media: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, n_bytes, media_sha256 and what reading the stored bytes gives) for each media row."""
    whole = F.expr("not exists(chunks, c -> c.data is null)")

    def in_line(batches):
        for batch in batches:
            lists, shas = batch.column(3), batch.column(2).to_pylist()
            got = [_read(b"".join(c["data"] for c in lists[i].as_py()), shas[i]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_read_columns(got)], names=[*batch.schema.names[:3], *(x.split()[0] for x in _READ.split(", "))])

    kind = media.schema["id"].dataType.simpleString()
    own = media.where(whole).mapInArrow(in_line, f"id {kind}, n_bytes long, media_sha256 string, {_READ}")

    rest = media.where(~whole)
    lists = stash(rest.groupBy("media_sha256").agg(F.first("chunks").alias("chunks")), "lists")
    refs = lists.select("media_sha256", F.posexplode("chunks").alias("at", "c")).select("media_sha256", "at", "c.digest", F.col("c.data").alias("own"))
    found = refs.where("own is not null").select("media_sha256", "at", F.col("own").alias("data")).unionByName(refs.where("own is null").drop("own").join(chunks, "digest").select("media_sha256", "at", "data"))
    joined = found.groupBy("media_sha256").agg(F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts")).select("media_sha256", F.col("parts.data").alias("parts"))

    def apart(batches):
        for batch in batches:
            shas = batch.column(0).to_pylist()
            got = [_read(b"".join(batch.column(1)[i].as_py()), shas[i]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_read_columns(got)], names=["media_sha256", *(x.split()[0] for x in _READ.split(", "))])

    features = stash(joined.mapInArrow(apart, f"media_sha256 string, {_READ}"), "features")
    return own.unionByName(rest.select("id", "n_bytes", "media_sha256").join(features, "media_sha256"))


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as media, read it back and compute features of what was read.

    A null or empty text is one unit of spaces. Null ids and repeated rows stay; no rows
    give no rows; only the named columns are read. Chunks that do not restore the stored
    bytes raise.
    """
    return read(*store(docs, id_col, text_col))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every document's stored media; nulls, empty texts, repeated rows and an empty table as in ``media_features``."""
    got = media_features(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
