"""SimHash near-duplicates, found exactly by vantage-point trees over the fingerprints.

A fingerprint takes the words of a text, its w-word shingles and their XXH64 values;
bit i is 1 if it is set in over half of them. Two fingerprints link if they differ in
at most ``radius`` bits; classes are the connected components.

Search. Two fingerprints within r bits are within r // 2 bits on one 32-bit half, so
there is one vantage-point tree for each half. A level of a tree holds a vantage point
for one block of the half's bits and branches by Hamming distance to it. By the
triangle inequality the distances of a pair to the same vantage points differ by at
most as much as the pair itself differs on that block, and these differences add up
over the disjoint blocks: a pair within r // 2 on the half reaches leaves (shards)
whose distance vectors are at most r // 2 apart. A fingerprint so lives in one shard
and queries those shards whose boundary its ball overlaps, one side only, as the other
side queries back. In a shard, a vantage point on the other half prunes once more
before the exact distance. Finer levels (narrower blocks) are taken as the number of
distinct fingerprints grows; the result is the same for any width.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import components, in_cells, last_group, stash

#: Vantage points of the two halves; any 32-bit values give the same result.
VANTAGE = (0x9E3779B9, 0x7F4A7C15)
#: Rows and columns of fingerprints that are compared at a time.
TILE = (512, 8192)
#: Rows of a shard that a task holds, about; a larger shard is searched in cells.
CELL = 1 << 18


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one text; 0 for null or no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), grams), np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65280):
        part = hashes[at : at + 65280]
        rows = -(-len(part) // 255)
        full = np.zeros(rows * 255, np.uint64)
        full[: len(part)] = part
        bits = np.unpackbits(full.view(np.uint8), bitorder="little").reshape(rows, 255, 64)
        total += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp) for each row; fp is the fingerprint's bits as a signed long."""

    def run(batches):
        for batch in batches:
            bits = np.fromiter((fingerprint(t, width, seed) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def block_bits(distinct: int) -> int:
    """Bits of a block, by the number of distinct fingerprints."""
    return 8 if distinct < 1_000_000 else 4 if distinct < 64_000_000 else 2 if distinct < 2_000_000_000 else 1


def shards(nodes: DataFrame, radius: int, bits: int) -> DataFrame:
    """Rows (shard, visit, fp, rep): each fingerprint at home and where its ball overlaps other shards."""
    blocks, base, reach = 32 // bits, bits + 1, radius // 2
    steps = [s for s in product(range(-reach, reach + 1), repeat=blocks) if 0 < sum(map(abs, s)) <= reach and next(x for x in s if x) > 0] if reach > 1 else [tuple(int(i == j) for j in range(blocks)) for i in range(blocks)] * reach
    out = None
    for half in (0, 1):
        at = [F.bit_count(F.expr(f"(shiftrightunsigned(fp, {32 * half + bits * k}) ^ {(VANTAGE[half] >> (bits * k)) & ((1 << bits) - 1)}L) & {(1 << bits) - 1}L")).cast("long") for k in range(blocks)]
        held = nodes.select("fp", "rep", F.array(*at).alias("d"))
        home = sum((F.col("d")[k] * base**k for k in range(blocks)), F.lit(half << 60))
        places = [F.struct(F.lit(0).alias("visit"), home.alias("shard"))]
        for s in steps:
            inside = F.lit(True)
            for k, x in enumerate(s):
                if x:
                    inside = inside & ((F.col("d")[k] + x).between(0, bits))
            places.append(F.when(inside, F.struct(F.lit(1).alias("visit"), (home + sum(x * base**k for k, x in enumerate(s))).alias("shard"))))
        rows = held.select("fp", "rep", F.explode(F.array_compact(F.array(*places))).alias("p")).select("p.shard", "p.visit", "fp", "rep")
        out = rows if out is None else out.unionByName(rows)
    return out


def _forest(fp: np.ndarray, visit: np.ndarray, half: int, radius: int) -> np.ndarray:
    """Parents (positions) of a spanning forest of the shard's links."""
    other = (fp >> np.uint64(0 if half else 32)) & np.uint64(0xFFFFFFFF)
    far = np.bitwise_count(other ^ np.uint64(VANTAGE[1 - half])).astype(np.int16)
    order = np.argsort(far, kind="stable")
    far, all_fp = far[order], fp[order]
    home = np.flatnonzero(visit[order] == 0)
    parent = np.arange(len(fp))
    for i in range(0, len(home), TILE[0]):
        rows = home[i : i + TILE[0]]
        lo = np.searchsorted(far, far[rows[0]] - radius, "left")
        hi = np.searchsorted(far, far[rows[-1]] + radius, "right")
        for j in range(lo, hi, TILE[1]):
            cols = all_fp[j : min(hi, j + TILE[1])]
            r, c = np.nonzero(np.bitwise_count(all_fp[rows][:, None] ^ cols[None, :]) <= radius)
            r, c = rows[r], c + j
            apart = r != c
            r, c = r[apart], c[apart]
            while len(r):
                p, q = parent[r], parent[c]
                apart = p != q
                if not apart.any():
                    break
                r, c, p, q = r[apart], c[apart], p[apart], q[apart]
                np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
                while (parent[parent] != parent).any():
                    parent = parent[parent]
    out = np.empty(len(fp), np.int64)
    out[order] = order[parent]
    return out


def links(nodes: DataFrame, radius: int = 3, bits: int | None = None, limit: int = CELL) -> DataFrame:
    """(a, b): links between representatives that keep the same connected components as all pairs within ``radius``.

    Shards of more than ``limit`` rows are searched in cells that hold every two of their rows.
    """
    bits = bits or block_bits(nodes.count())

    def run(batches):
        rest = None

        def search(shard, cell, visit, fp, rep):
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(cell) != 0)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(shard)]
            homes = np.add.reduceat((visit == 0).astype(np.int64), starts)
            a, b = [], []
            for s, e in zip(starts[(homes > 0) & (ends - starts > 1)], ends[(homes > 0) & (ends - starts > 1)], strict=True):
                parent = _forest(fp[s:e].view(np.uint64), visit[s:e], int(shard[s] >> 60), radius)
                moved = np.flatnonzero(parent != np.arange(e - s))
                a.append(rep[s:e][moved])
                b.append(rep[s:e][parent[moved]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if rest is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(rest, cols, strict=True)]
            last = last_group(cols[0], cols[1])
            if last:
                yield from search(*(x[:last] for x in cols))
            rest = [x[last:] for x in cols]
        if rest is not None:
            yield from search(*rest)

    placed = shards(nodes, radius, bits)
    placed = in_cells(placed, placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "shard", "rep", limit)
    placed = placed.select("shard", "cell", "visit", "fp", "rep").repartition("shard", "cell").sortWithinPartitions("shard", "cell")
    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, seed: int = 42, bits: int | None = None, limit: int = CELL) -> DataFrame:
    """(id, fp, component): each row's class under links of at most ``radius`` bits.

    Null and wordless texts have fingerprint 0 and link like any other. A null id gets
    its class's component, null if no row of the fingerprint has an id. Repeated rows
    stay. An empty table gives no rows. ``id_col`` must be integer; other columns,
    whatever their names, are not read.
    """
    marks = stash(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    nodes = stash(marks.groupBy("fp").agg(F.min("id").cast("long").alias("rep")), "nodes")
    found = stash(links(nodes.where("rep is not null"), radius, bits, limit), "links")
    classes = components(found, "a", "b")
    by_fp = nodes.join(classes, nodes.rep == classes.node, "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return marks.join(by_fp, "fp").select("id", "fp", "component")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document; nulls, empty texts, repeated rows and an empty table as in ``near_duplicates``."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
