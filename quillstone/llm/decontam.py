"""Benchmark decontamination: short test items found inside long documents.

Texts become words (lower case, runs other than white space) and five-word shingles;
an item of fewer words is one shingle of all of them. A document leaks an item if it
holds at least ``threshold`` of the item's distinct shingles.

Search. Items are partitioned by size, a partition for each power of two of their number
of shingles n. An item's MinHash signature is its floor((1 - threshold) n) + 1 smallest
shingle values, and a partition's ceiling is the largest value in its signatures: low
for long items, near the top for items of a few shingles. A document has one MinHash
sketch for each partition: its values up to that ceiling, so as many as its own length
and the items' size call for. (A sketch of fixed size would lose short items in long
documents.) A document that holds the threshold's share of an item misses fewer shingles than
the item's signature has values, so its sketch holds one of them, and no leak is lost.
Candidates are verified by containment of the exact shingles.

The benchmark is broadcast in blocks of a fixed number of shingles, so what a task
holds is bounded however large the benchmark grows; each block is one scan of the
documents.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS, THRESHOLD = 5, 0.8
#: Item shingles in a broadcast block.
BLOCK = 2_000_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles_of(words: list[bytes], width: int = WORDS) -> set[bytes]:
    """The distinct shingles; all words as one where there are fewer than ``width``; none without words."""
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


class Hasher:
    """64-bit values of all shingles of a text, from cached word hashes mixed by position."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, words: list[bytes], width: int) -> np.ndarray:
        if len(self.known) > 250_000:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(h) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = (out ^ h[k : k + n]) * _MIX[k % len(_MIX)]
            out ^= out >> np.uint64(29)
        return out


def signature_size(n: int, threshold: float) -> int:
    """Values in the signature of an item with n shingles."""
    return n - math.ceil(round(threshold * n, 9)) + 1


class Partition:
    """The signatures of the items of one size class and shingle width, and the ceiling of the documents' sketches."""

    def __init__(self, signatures: list[tuple[int, int]]):
        owners: dict[int, list[int]] = defaultdict(list)
        for value, at in signatures:
            owners[value].append(at)
        self.values, self.owners = np.array(sorted(owners), np.uint64), dict(owners)
        self.ceiling = self.values[-1]

    def probe(self, own: np.ndarray) -> set[int]:
        """Items whose signature shares a value with the sketch of a document with these shingle values."""
        sketch = own[own <= self.ceiling]
        at = np.searchsorted(self.values, sketch)
        return {i for v in set(sketch[self.values[at] == sketch].tolist()) for i in self.owners[v]}


class Block:
    """Items of one broadcast block, in partitions by size."""

    def __init__(self, items: list[tuple], width: int, threshold: float):
        self.threshold = threshold
        self.items = [(i, shingles_of(words_of(t), width)) for i, t in items]
        hasher = Hasher(width)
        by_size: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for at, (_, shingles) in enumerate(self.items):
            if not shingles:
                continue
            span = min(width, len(next(iter(shingles)).split(b" ")))  # under width only for an item shorter than a shingle
            values = sorted(int(hasher(s.split(b" "), span)[0]) for s in shingles)
            by_size[span, len(shingles).bit_length()] += [(v, at) for v in values[: signature_size(len(shingles), threshold)]]
        self.partitions: dict[int, list[Partition]] = defaultdict(list)
        for (span, _), signatures in sorted(by_size.items()):
            self.partitions[span].append(Partition(signatures))

    def search(self, text: str | None, hasher: Hasher) -> list[tuple]:
        """(item id, item's shingles, shared shingles) of the items that leak into the text."""
        words = words_of(text)
        candidates: set[int] = set()
        for span, parts in self.partitions.items():
            own = hasher(words, span)
            for part in parts if len(own) else ():
                candidates |= part.probe(own)
        if not candidates:
            return []
        out, own_by = [], {}
        for at in sorted(candidates):
            item, shingles = self.items[at]
            span = len(next(iter(shingles)).split(b" "))
            if span not in own_by:
                own_by[span] = shingles_of(words, span)
            shared = len(shingles & own_by[span])
            if shared >= self.threshold * len(shingles) - 1e-9:
                out.append((item, len(shingles), shared))
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int, threshold: float, limit: int = BLOCK):
    """Broadcastable blocks of the benchmark, each of at most about ``limit`` shingles."""
    held = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = held.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / (4 * limit)))  # a shingle for every four characters, at most
    for part in range(parts):
        rows = held.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Block([(r.id, r.text) for r in rows], width, threshold))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment), one row for each document row and item that leaks into it.

    Null and wordless texts, of items or documents, match nothing; null ids and repeated
    rows are treated like any other row. An empty table on either side gives no rows.
    Only the named columns are read.
    """
    ids, kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    item_type, out = to_arrow_type(kinds), None
    for sent in blocks(benchmark, item_id, item_text, width, threshold, block):

        def run(batches, sent=sent):
            hasher = Hasher(width)
            for batch in batches:
                found = [(row, *hit) for row, text in enumerate(batch.column(1).to_pylist()) for hit in sent.value.search(text, hasher)]
                if found:
                    row, item, n, shared = zip(*found, strict=True)
                    n, shared = np.array(n, np.int64), np.array(shared, np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, item_type), pa.array(n), pa.array(shared), pa.array(shared / n)], names=["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"])

        part = held.mapInArrow(_bound(run), f"doc_id {ids}, item_id {kinds.simpleString()}, item_shingles long, shared_shingles long, containment double")
        out = part if out is None else out.unionByName(part)
    return out


def _bound(run):
    return lambda batches: run(batches)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, into which no item leaks.

    Null and wordless texts stay, as do null ids and repeated rows; an item without words
    removes nothing, and without items all rows stay. Columns of docs may have any names,
    those of the benchmark too.
    """
    kept = docs
    at = docs.columns.index(text_col)
    for sent in blocks(benchmark, item_id, item_text, width, threshold, block):

        def run(batches, sent=sent):
            hasher = Hasher(width)
            for batch in batches:
                yield batch.filter(pa.array([not sent.value.search(t, hasher) for t in batch.column(at).to_pylist()], pa.bool_()))

        kept = kept.mapInArrow(_bound(run), docs.schema)
    return kept


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``leaks`` of the benchmark into all documents; nulls, empty texts, repeated rows and empty tables as there."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP4_SQL = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t-\r ]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t-\r ]+'), lambda x: x <> '') FROM benchmark
), widths AS (
  SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE side = 'b' AND len(w) > 0
), grams AS (
  SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
  FROM words JOIN widths ON CASE side WHEN 'b' THEN k = least(5, len(w)) ELSE k <= len(w) END
), sizes AS (SELECT id, count(*) AS n FROM grams WHERE side = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, s.n AS item_shingles, count(*) AS shared_shingles, count(*) / s.n::DOUBLE AS containment
FROM grams b JOIN grams d ON d.g = b.g AND d.side = 'd' JOIN sizes s ON s.id = b.id
WHERE b.side = 'b' GROUP BY d.id, b.id, s.n HAVING count(*) >= 0.8 * s.n - 1e-9
"""
