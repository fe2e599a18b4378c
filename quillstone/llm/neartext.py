"""Near-duplicate texts by SimHash sketches, vantage-point trees and exact Jaccard similarity.

The fingerprint search of ``simhash`` for a similarity instead of a number of bits: two
texts link if the sets of their five-word shingles have a Jaccard similarity of at least
0.8. Such a pair differs in about 15 of 100 bits, more than one tree over 64 bits can
prune, so a text has a wider SimHash sketch, cut into blocks with a vantage-point tree
for each. In a tree a shard is a vector of Hamming distances to vantage points; a block
within one bit of another lies in the same shard or, by the triangle inequality, in one
whose vector is one step away, and each block lives in one shard and visits those its
ball overlaps on the upper side. A pair meets if any of its blocks is within one bit:
at a similarity of 0.8 that has a probability of 99.5 %, and far more above.

Pairs that meet and whose sketches agree roughly become a forest of the shard, closest
pairs first, so a group of copies gives as many edges as it has texts and not all its
pairs. Each component then tries its closest edges and exact shingles decide; what is
left between different components is all verified in the end.

The trees may miss a pair and a forest may hold edges that fail, so they only make the
classes that are cheap to find. A prefix filter then completes them: shingles have a
fixed order, common ones last, and two texts at the threshold share one of the first
n - ceil(threshold n) + 1 of their n shingles. Of two texts that do, the first shingles
of the one whose first shingles end earlier are then all accounted for: what is shared
among them is known, and only what stands behind them can still be shared. A text's
first shingles also carry the parities of all its shingles, dealt by their values to 128
bits: one shingle that only one of two texts has changes one bit, so two texts have at
least as many of these as their parities have differing bits, and a pair with too many is
none. All pairs of texts of different classes for which that can add up to the threshold
are verified. The result is that of all pairs, whatever the trees, sketches and bands.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import components, discard, in_cells, last_group, parted, stash
from quillstone.llm.decontam import THRESHOLD, WORDS, Hasher, shingles_of, signature_size, words_of

#: Trees, bits of a block and bits of a level of a tree, by the number of distinct texts.
SHAPES = ((2_000_000, 16, 16, 8), (16_000_000, 16, 16, 2), (None, 32, 24, 1))
#: Rows of a shard that a task holds, about; a larger shard is searched in cells.
CELL = 1 << 19
#: Shares of differing bits: edges up to the first are taken first, and so on; up to the last a pair is verified.
BANDS = (0.11, 0.15, 0.205)
#: Pairs that are compared at a time.
PAIRS = 1 << 17
#: Rounds in which a component tries its closest edges before all the rest is verified.
ROUNDS = 3
#: Counters of shingles in a task; those over HEAVY times the mean and LEAST are sent, so at most COUNTERS / HEAVY of a task.
COUNTERS, HEAVY, LEAST = 1 << 20, 8, 16
#: Groups of shingles whose rows are counted before single shingles are.
GROUPS = 1 << 14


def sketch(values: np.ndarray, lanes: int) -> bytes:
    """SimHash of ``lanes`` times 64 bits of distinct shingle values."""
    out = np.zeros(lanes, np.uint64)
    for lane in range(lanes):
        total = np.zeros(64, np.int64)
        for at in range(0, len(values), 65280):
            x = values[at : at + 65280] + np.uint64((lane + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x ^= x >> np.uint64(30)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
            rows = -(-len(x) // 255)
            full = np.zeros(rows * 255, np.uint64)
            full[: len(x)] = x
            total += np.unpackbits(full.view(np.uint8), bitorder="little").reshape(rows, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        out[lane] = np.packbits(total * 2 > len(values), bitorder="little").view(np.uint64)[0]
    return out.tobytes()


def shape(texts: int) -> tuple[int, int, int]:
    """(trees, bits of a block, bits of a level) for a number of texts."""
    return next(rest for limit, *rest in SHAPES if limit is None or texts < limit)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, lanes: int) -> DataFrame:
    """(id, lo, hi, sketch, at, n) for each row, at and n null; lo and hi are a digest of the set of shingles, 0 without words.

    Each task adds rows (at, n) with its counts of groups of shingle values, where they
    are often: see ``common_shingles``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "lo", "hi", "sketch", "at", "n"]

    def run(batches):
        hasher, total, id_type = Hasher(width), np.zeros(COUNTERS, np.int64), None
        for batch in batches:
            lo, hi, out, id_type = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64), [], batch.column(0).type
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                values = np.unique(hasher(words, min(width, len(words)))) if words else np.empty(0, np.uint64)
                lo[i], hi[i] = np.bitwise_xor.reduce(values), values.sum(dtype=np.uint64)
                np.add.at(total, (values % np.uint64(COUNTERS)).astype(np.int64), 1)
                out.append(sketch(values, lanes))
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)), pa.array(out, pa.binary()), none, none], names=names)
        often = np.flatnonzero(total > max(LEAST, HEAVY * total.mean()))
        if len(often):
            n = len(often)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(often), pa.array(total[often])], names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, lo long, hi long, sketch binary, at long, n long")


def _rows(column: pa.Array, size: int) -> np.ndarray:
    """A binary column of equal lengths as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), size)


def _block(bits: np.ndarray, tree: int, width: int) -> np.ndarray:
    """The tree's block of each sketch as an integer."""
    return bits[:, tree * width // 8 : (tree + 1) * width // 8].astype(np.int64) @ (256 ** np.arange(width // 8, dtype=np.int64))


def _places(bits: np.ndarray, trees: int, width: int, level: int):
    """(shard, visit, positions): at home in every tree, and where a block's ball overlaps other shards."""
    levels = width // level
    for tree in range(trees):
        block = _block(bits, tree, width)
        mark = np.int64((tree + 1) * 0x9E3779B1 & (1 << width) - 1)
        far = [np.bitwise_count((block ^ mark) >> (level * k) & ((1 << level) - 1)).astype(np.int64) for k in range(levels)]
        home = sum((d * (level + 1) ** k for k, d in enumerate(far)), np.full(len(block), tree << 32, np.int64))
        yield home, 0, np.arange(len(block))
        for k in range(levels):
            at = np.flatnonzero(far[k] < level)
            yield home[at] + (level + 1) ** k, 1, at


def placed(nodes: DataFrame, trees: int, width: int, level: int) -> DataFrame:
    """(shard, visit, rep, sketch) for each sketch and shard that it lives in or visits."""
    size = trees * width // 8

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rep, held = batch.column(0), batch.column(1)
            for shard, visit, at in _places(_rows(held, size), trees, width, level):
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.full(len(at), visit, np.int32)), rep.take(take), held.take(take)], names=["shard", "visit", "rep", "sketch"])

    return nodes.select("rep", "sketch").mapInArrow(run, "shard long, visit int, rep long, sketch binary")


def shard_sizes(nodes: DataFrame, trees: int, width: int, level: int) -> DataFrame:
    """(shard, n): the rows that ``placed`` puts into each shard, counted batch by batch before the shuffle."""
    size = trees * width // 8

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                shard, n = np.unique(np.concatenate([x for x, _, _ in _places(_rows(batch.column(0), size), trees, width, level)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(n.astype(np.int64))], names=["shard", "n"])

    return nodes.select("sketch").mapInArrow(run, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))


def _meeting(block: np.ndarray, visit: np.ndarray, width: int):
    """Positions (i, j), a bounded number at a time, of the shard's pairs whose blocks are within one bit."""
    order = np.argsort(block, kind="stable")
    ranked, home = block[order], np.flatnonzero(visit == 0)
    for mask in [0, *(1 << k for k in range(width))]:
        lo = np.searchsorted(ranked, block[home] ^ mask, "left")
        n = np.searchsorted(ranked, block[home] ^ mask, "right") - lo
        some = np.flatnonzero(n)
        ends = np.cumsum(n[some])
        at = 0
        while at < len(some):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            rows, sizes = some[at:to], n[some[at:to]]
            i = np.repeat(home[rows], sizes)
            j = order[np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo[rows], sizes)]
            keep = (visit[j] == 1) | (i < j)
            yield i[keep], j[keep]
            at = to


def _forest(block: np.ndarray, visit: np.ndarray, bits: np.ndarray, width: int):
    """(i, j, differing bits): edges of a spanning forest of the shard, by bands from the closest on."""
    words, parent, found = bits.view(np.uint64), np.arange(len(block)), []
    low = -1
    for high in (int(b * 8 * bits.shape[1]) for b in BANDS):
        for i, j in _meeting(block, visit, width):
            apart = parent[i] != parent[j]
            i, j = i[apart], j[apart]
            h = np.zeros(len(i), np.int32)
            for k in range(words.shape[1]):
                h += np.bitwise_count(words[i, k] ^ words[j, k])
            near = (h > low) & (h <= high)
            i, j, h = i[near], j[near], h[near]
            while len(i):
                # every root takes its closest edge to another root of smaller number
                p, q = np.maximum(parent[i], parent[j]), np.minimum(parent[i], parent[j])
                best = np.lexsort((h, p))
                best = best[np.r_[True, np.diff(p[best]) > 0]]
                found.append((i[best], j[best], h[best]))
                parent[p[best]] = q[best]
                while (parent[parent] != parent).any():
                    parent = parent[parent]
                apart = parent[i] != parent[j]
                i, j, h = i[apart], j[apart], h[apart]
        low = high
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else None


def candidates(nodes: DataFrame, trees: int, width: int, level: int, limit: int = CELL) -> DataFrame:
    """(a, b, h): distinct edges of the shards' forests, with the number of differing bits.

    Shards of more than ``limit`` rows give the forests of their cells, which together
    hold a forest of the shard.
    """
    size = trees * width // 8

    def run(batches):
        rest = None

        def search(shard, cell, visit, rep, held):
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(cell) != 0)) + 1
            for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(shard)], strict=True):
                if e - s < 2 or visit[s:e].all():
                    continue
                bits = np.ascontiguousarray(held[s:e])
                edges = _forest(_block(bits, int(shard[s] >> 32), width), visit[s:e], bits, width)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array(rep[s:e][edges[0]]), pa.array(rep[s:e][edges[1]]), pa.array(edges[2])], names=["a", "b", "h"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)] + [_rows(batch.column(4), size)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            last = last_group(cols[0], cols[1])
            if last:
                yield from search(*(x[:last] for x in cols))
            rest = [x[last:] for x in cols]
        if rest is not None:
            yield from search(*rest)

    rows = in_cells(placed(nodes, trees, width, level), shard_sizes(nodes, trees, width, level), "shard", "rep", limit)
    rows = rows.select("shard", "cell", "visit", "rep", "sketch").repartition("shard", "cell").sortWithinPartitions("shard", "cell")
    found = rows.mapInArrow(run, "a long, b long, h int")
    return found.where("a != b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("h").alias("h"))


def verified(edges: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The edges (a, b) whose texts' shingles have a Jaccard similarity of at least ``threshold``."""

    def run(batches):
        last, held = None, set()
        for batch in batches:
            good = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                one = one.as_py()
                if one != last:  # the edges of a text mostly come together
                    last, held = one, shingles_of(words_of(one), width)
                y = shingles_of(words_of(two.as_py()), width)
                shared = len(held & y)
                good.append(shared >= threshold * (len(held) + len(y) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("two"))
    return edges.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "one", "two").mapInArrow(run, "a long, b long").distinct()


def common_shingles(marks: DataFrame) -> np.ndarray:
    """A count for each of COUNTERS groups of shingle values, 0 unless a task has the group often. It only orders shingles."""
    rows = marks.where("at is not null").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    count_of = np.zeros(COUNTERS, np.int64)
    count_of[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return count_of


def parities(values: np.ndarray) -> np.ndarray:
    """For each of 128 groups of distinct shingle values whether their number is odd, as two integers."""
    group = (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)).astype(np.int64)
    return np.packbits((np.bincount(group, minlength=128) & 1).astype(np.uint8)).view(np.int64)


def prefixes(texts: DataFrame, common: np.ndarray, width: int, threshold: float) -> DataFrame:
    """(shingle, c, id, n, end, odd, odd2): the first shingles of each text (id, text, c), rare ones first, of which a near duplicate holds one.

    ``n`` is the number of all its shingles, ``end`` where the first ones end in the order
    of all shingles: a count and the leading bits of a value; ``odd`` and ``odd2`` are its parities.
    """
    sent = texts.sparkSession.sparkContext.broadcast(np.minimum(common, (1 << 20) - 1).astype(np.uint64) << np.uint64(43))
    names = ["shingle", "c", "id", "n", "end", "odd", "odd2"]

    def run(batches):
        hasher = Hasher(width)
        for batch in batches:
            held, rows, sizes, ends, odd = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                if not words:
                    continue
                values = np.unique(hasher(words, min(width, len(words))))
                place = sent.value[(values % np.uint64(COUNTERS)).astype(np.int64)] | values >> np.uint64(21)
                first = np.argsort(place, kind="stable")[: signature_size(len(values), threshold)]
                held.append(values[first])
                rows.append(i)
                sizes.append(len(values))
                ends.append(place[first[-1]])
                odd.append(parities(values))
            if held:
                times = np.array([len(x) for x in held])
                each = pa.array(np.repeat(rows, times))
                last = np.repeat(np.array(ends, np.uint64), times).view(np.int64)
                odd = np.repeat(np.array(odd), times, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64)), batch.column(2).take(each), batch.column(0).take(each), pa.array(np.repeat(np.array(sizes, np.int32), times)), pa.array(last), pa.array(odd[:, 0].copy()), pa.array(odd[:, 1].copy())], names=names)

    return texts.select("id", "text", "c").mapInArrow(run, "shingle long, c long, id long, n int, end long, odd long, odd2 long")


def _across(shingle: np.ndarray, cell: np.ndarray, klass: np.ndarray):
    """Positions (i, j), a bounded number at a time, of all pairs of a shingle and cell with different classes; rows are sorted by the three."""
    new = np.r_[True, (np.diff(shingle) != 0) | (np.diff(cell) != 0)]
    other = new | np.r_[True, np.diff(klass) != 0]

    def end(starts):
        at = np.r_[np.flatnonzero(starts), len(starts)]
        return np.repeat(at[1:], np.diff(at))

    lo = end(other)
    n = end(new) - lo
    some = np.flatnonzero(n)
    ends = np.cumsum(n[some])
    at = 0
    while at < len(some):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        rows, sizes = some[at:to], n[some[at:to]]
        i = np.repeat(rows, sizes)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo[rows], sizes)
        at = to


def sharing(texts: DataFrame, common: np.ndarray, width: int, threshold: float, limit: int = CELL) -> DataFrame:
    """(a, b, ca, cb, na, nb, rest) for each first shingle that two texts (id, text, c) of different classes c share, unless their sizes or parities rule the pair out."""
    rows = stash(prefixes(texts, common, width, threshold), "prefixes")
    group = F.pmod("shingle", F.lit(GROUPS)).alias("g")
    crowded = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("g")
    sizes = rows.select("shingle", group).join(F.broadcast(crowded), "g", "left_semi").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rows = in_cells(rows, sizes, "shingle", "id", limit)
    rows = rows.select("shingle", "cell", "c", "id", "n", "end", "odd", "odd2").repartition("shingle", "cell").sortWithinPartitions("shingle", "cell", "c")
    names = ["a", "b", "ca", "cb", "na", "nb", "rest"]

    def search(shingle, cell, c, rep, n, end, odd, odd2):
        behind = (np.ceil(np.round(threshold * n, 9)) - 1).astype(np.int32)  # shingles that aren't among the first
        for i, j in _across(shingle, cell, c):
            near = (n[i] >= threshold * n[j] - 1e-9) & (n[j] >= threshold * n[i] - 1e-9)
            i, j = i[near], j[near]
            differ = np.bitwise_count((odd[i] ^ odd[j]).view(np.uint64)).astype(np.int32) + np.bitwise_count((odd2[i] ^ odd2[j]).view(np.uint64))
            near = differ <= (1 - threshold) / (1 + threshold) * (n[i] + n[j]) + 1e-6
            i, j = i[near], j[near]
            i, j = np.where(rep[i] < rep[j], i, j), np.where(rep[i] < rep[j], j, i)
            if len(i):
                # ends alike may be those of two shingles, of which either may come first
                rest = np.where(end[i] == end[j], np.maximum(behind[i], behind[j]), np.where(end[i] < end[j], behind[i], behind[j]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rep[i], rep[j], c[i], c[j], n[i], n[j], rest)], names=names)

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            last = last_group(cols[0], cols[1])
            if last:
                yield from search(*(x[:last] for x in cols))
            rest = [x[last:] for x in cols]
        if rest is not None:
            yield from search(*rest)

    return rows.mapInArrow(run, "a long, b long, ca long, cb long, na int, nb int, rest int")


def missing(texts: DataFrame, common: np.ndarray, width: int, threshold: float, limit: int = CELL) -> DataFrame:
    """(a, b, h, ca, cb): all pairs of texts (id, text, c) of different classes c that the prefix filter can't rule out; the lower h, the more first shingles are shared."""
    pairs = sharing(texts, common, width, threshold, limit).groupBy("a", "b", "ca", "cb", "na", "nb", "rest").agg(F.count(F.lit(1)).cast("int").alias("shared"))
    pairs = pairs.where(F.col("shared") + F.col("rest") >= threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-6)
    return pairs.select("a", "b", (-F.col("shared")).alias("h"), "ca", "cb")


def grown(linked: DataFrame | None, edges: DataFrame, docs: DataFrame, width: int, threshold: float, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(links, classes) after all edges (a, b, h, ca, cb) between different classes have been verified, or joined by others."""
    ends = stash(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    texts = stash(parted(docs, ends, "id")[1].join(ends, "id", "left_semi").dropDuplicates(["id", "text"]), "ends")
    for turn in count():
        each = edges.select("ca", "cb", "h", "a", "b")
        sides = each.select(F.col("ca").alias("c"), "h", "a", "b").unionByName(each.select(F.col("cb").alias("c"), "h", "a", "b"))
        todo = stash(sides.groupBy("c").agg(F.min(F.struct("h", "a", "b")).alias("e")).select("e.a", "e.b").distinct() if turn < rounds else each.select("a", "b"), "tried")
        good = stash(verified(todo, texts, width, threshold), "verified")
        linked = good if linked is None else stash(linked.unionByName(good), "linked")
        classes = components(linked, "a", "b")
        if turn == rounds:
            break
        left = each.select("a", "b", "h").join(todo, ["a", "b"], "left_anti")
        left = left.join(classes.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(classes.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        left = left.select("a", "b", "h", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).where("ca != cb")
        spent, edges = edges, stash(left, "candidates")
        discard(spent, todo)
        if edges.isEmpty():
            break
    return linked, classes


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, threshold: float = THRESHOLD, limit: int = CELL) -> DataFrame:
    """(id, component): each row's class under links of a Jaccard similarity of at least ``threshold``.

    Texts without words, null or empty, are one class; of fewer than ``width`` words all
    are one shingle. Rows with the same shingles are one class whatever their number.
    A null id gets its class's component, null if no row of the class has an id. Repeated
    rows stay. An empty table gives no rows. ``id_col`` must be integer; other columns,
    whatever their names, are not read.
    """
    trees, bits, level = shape(docs.count())
    marks = stash(sketches(docs, id_col, text_col, width, trees * bits // 64), "sketches")
    common, marks = common_shingles(marks), marks.where("at is null").drop("at", "n")
    nodes = stash(marks.groupBy("lo", "hi").agg(F.min("id").cast("long").alias("rep"), F.first("sketch").alias("sketch")), "texts")
    some = stash(nodes.where("rep is not null and (lo != 0 or hi != 0)").select("rep", "sketch"), "reps")
    held = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    edges = stash(candidates(some, trees, bits, level, limit).select("a", "b", "h", F.col("a").alias("ca"), F.col("b").alias("cb")), "candidates")
    linked, classes = grown(None, edges, held, width, threshold)
    reps = some.select(F.col("rep").alias("id")).join(classes.select(F.col("node").alias("id"), "component"), "id", "left")
    # most texts are their set's first row and in no link, so they need no join
    others = marks.select(F.col("id").cast("long").alias("id")).where("id is not null").join(some.select(F.col("rep").alias("id")), "id", "left_anti")
    alone, rest = parted(held, others.unionByName(classes.select(F.col("node").alias("id"))), "id")
    own = alone.where("id is not null").select("id", "text", F.col("id").alias("c")).unionByName(rest.join(reps, "id").select("id", "text", F.coalesce("component", "id").alias("c")))
    edges = stash(missing(own, common, width, threshold, limit), "missing")
    if not edges.isEmpty():
        # few of these hold, so rounds would save little
        classes = grown(linked, edges, held, width, threshold, rounds=0)[1]
    by_text = nodes.join(classes, nodes.rep == classes.node, "left").select("lo", "hi", F.coalesce("component", "rep").alias("component"))
    return marks.select("id", "lo", "hi").join(by_text, ["lo", "hi"]).select("id", "component")
