"""Best-fit packing of documents into fixed-length sequences, certified by lower bounds.

Pieces are dealt to partitions of bounded size; each partition runs best-fit decreasing
and a dual-feasible-function lower bound on its bin count. A partition whose count
equals its bound is certified and only gives up its emptiest bin; one with a gap keeps
its full bins and gives up the rest. What is given up is dealt anew, so partitions
exchange documents, and is packed again, until a single partition is left or a round
saves less than one sequence in a thousand. ``certificate`` holds the result against the same bound over all pieces.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import stash

LENGTH = 2048
#: Pieces in a partition; bounds the memory of a packing task.
PARTITION = 65_536
#: A round goes on to another if it saves this share of the sequences that it was given.
SAVES = 0.001
#: Token strings kept by a worker: at most so many, of at most so many characters.
CACHE, CACHED_CHARS = 600_000, 48
_wide = re.compile(r" (?:\s|\Z)")


#: Fixed value: how a byte-level BPE cuts a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    A space followed by a character that is not white space always starts a new
    pre-token of a byte-level BPE, so a text may be cut there and the ids of the parts
    joined; parts and pre-tokens repeat and are cached. All ids come from ``tokenizers``;
    a tokenizer of another kind encodes whole texts.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        # a text that holds a special token's string gets that token's id, as the tokenizer cuts the text there first
        self.special = [t["content"] for t in state.get("added_tokens") or ()]
        before = state.get("pre_tokenizer") or {}
        self.by_parts = not state.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.find, self.letters = regex.compile(PRE_TOKEN).findall, _byte_letters()
        self.first: dict[str, bytes] = {}  # parts at the start of a text, or cut with care
        self.after: dict[str, bytes] = {}  # parts after a space, without it
        self.known: dict[str, bytes] = {}  # pre-tokens

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def part(self, text: str) -> bytes:
        if len(text) > CACHED_CHARS or max(text, default="") >= "\u0250":
            return self.whole([text])[0]
        out = b""
        for p in self.find(text):
            ids = self.known.get(p)
            if ids is None:
                tokens = self.tokenizer.model.tokenize(p.encode().decode("latin-1").translate(self.letters))
                ids = self.known[p] = b"".join(t.id.to_bytes(4, "little") for t in tokens)
            out += ids
        return out

    @staticmethod
    def parts(text: str) -> list[str]:
        first, *rest = text.split(" ")
        out = [first]
        for p in rest:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_parts:
            return self.whole(texts)
        out = []
        if len(self.first) + len(self.after) > CACHE or len(self.known) > CACHE:
            for cache in (self.first, self.after, self.known):
                cache.clear()
        for text in texts:
            if any(x in text for x in self.special):
                out.append(self.whole([text])[0])
                continue
            if _wide.search(text):
                heads, tails = self.parts(text), []
            else:
                head, *tails = text.split(" ")
                heads = [head]
            long = []
            for p in set(heads).difference(self.first):
                self.first[p] = self.part(p)
                if len(p) > CACHED_CHARS:
                    long.append(p)
            for p in set(tails).difference(self.after):
                self.after[p] = self.part(" " + p)
                if len(p) > CACHED_CHARS:
                    long.append(p)
            out.append(b"".join(map(self.first.__getitem__, heads)) + b"".join(map(self.after.__getitem__, tails)))
            for p in long:
                self.first.pop(p, None)
                self.after.pop(p, None)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One encoder per worker process; ``path`` defaults to the public byte-level BPE file on that machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole pieces last, a shorter one first."""
    head = total % length
    starts = ([0] if head else []) + list(range(head, total, length))
    return [(s, (head if s == 0 and head else length)) for s in starts]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each document's ids and the final id 0.

    A null text is empty: one piece of length 1. Null ids and repeated rows give pieces
    like any other; no rows give no rows. Only the named columns are read.
    """

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encode([t or "" for t in part.column(1).to_pylist()])
                out = [[], [], [], [], []]
                for row, raw in enumerate(ids):
                    raw += b"\0\0\0\0"
                    for n, (start, size) in enumerate(cut(len(raw) // 4, length)):
                        for col, x in zip(out, (row, n, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)])), strict=True):
                            col.append(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """Best-fit decreasing: each item's bin, and each bin's free room."""
    where, free = np.empty(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin has r free
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                some &= ~(1 << room)
        else:
            room, b = capacity, len(free)
            free.append(0)
        where[i], free[b] = b, room - size
        if room > size:
            by_room[room - size].append(b)
            some |= 1 << (room - size)
    return where, free


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the largest bound of two families of dual feasible functions, in exact integers."""
    if not len(sizes):
        return 0
    return bound(*np.unique(sizes.astype(np.int64), return_counts=True), capacity)


def bound(value: np.ndarray, times: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of sizes given as distinct values and how often each occurs."""
    best = -(-int((value * times).sum()) // capacity)
    for cut_at in value[value * 2 <= capacity].tolist():
        mass = int((times * np.where(value > capacity - cut_at, capacity, np.where(value < cut_at, 0, value))).sum())
        best = max(best, -(-mass // capacity))
    for k in range(1, 33):
        whole = (k + 1) * value % capacity == 0
        mass = int((times * np.where(whole, value * k, (k + 1) * value // capacity * capacity)).sum())
        best = max(best, -(-mass // (k * capacity)))
    return best


def _packer(length: int, turn: int, last: bool):
    def run(key, rows):
        rows = rows.drop_columns("_part").sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        sizes = rows["length"].to_numpy()
        where, free = best_fit(sizes, length)
        free = np.asarray(free)
        sure = len(free) == lower_bound(sizes, length)
        keep = np.ones(len(free), bool)
        if not last:
            if sure:
                keep[np.argmax(free)] = free.max() == 0
            else:
                keep = free == 0
        order = np.lexsort((np.arange(len(sizes)), where))
        ends = np.cumsum(sizes[order])
        first = np.r_[True, np.diff(where[order]) != 0]
        base = np.maximum.accumulate(np.where(first, ends - sizes[order], 0))
        out = rows.take(pa.array(order))
        out = out.append_column("sequence_id", pa.array((turn << 56) | (key[0].as_py() << 24) | where[order]))
        out = out.append_column("offset", pa.array(ends - sizes[order] - base))
        out = out.append_column("certified", pa.array(np.full(len(order), bool(sure))))
        return out.append_column("done", pa.array(keep[where[order]]))

    return run


def pack(items: DataFrame, length: int = LENGTH, per_partition: int = PARTITION) -> DataFrame:
    """Give each piece (doc_id, piece, start, length, ids_crc32) a sequence_id, an offset and whether its bin was certified.

    Rounds go on while they save sequences; the better of the last two stays. Null ids and repeated rows are packed like any other; no rows give no rows.
    """
    columns = items.columns
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    rest, closed, opened, before = items, [], None, 0
    for turn in itertools.count():
        n = rest.count()
        if not n and turn:
            break
        parts = max(1, -(-n // per_partition))

        # by row and not by content, as any number of rows may be equal
        dealt = rest.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts)))
        packed = stash(dealt.groupBy("_part").applyInArrow(_packer(length, turn, parts == 1), f"{kind}, sequence_id long, offset long, certified boolean, done boolean"), "packed")
        used = _sequences(packed)
        if opened is not None and before - used < max(1, SAVES * before):
            closed.append(opened if used >= before else packed)
            break
        closed.append(packed.where("done"))
        opened = packed.where("not done")
        before, rest = _sequences(opened), opened.select(*columns)
        if parts == 1:
            break
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out.drop("done")


def _sequences(packed: DataFrame) -> int:
    return packed.agg(F.count_distinct("sequence_id").alias("n")).first()["n"]


def certificate(packed: DataFrame, length: int = LENGTH) -> tuple[int, int]:
    """(sequences used, sequences that any packing of these pieces needs); at most ``length`` counts reach the driver."""
    by = packed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    value, n = (np.array([r[k] for r in sorted(by)], np.int64) for k in (0, 1))
    return _sequences(packed), bound(value, n, length)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence. A null or empty text is the final id alone; null ids and repeated rows
    are documents of their own; an empty table gives no rows; other columns are not read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(stash(pieces(docs), "pieces"))
