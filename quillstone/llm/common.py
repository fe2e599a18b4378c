"""What the operators share: the scratch folder, cut lineage, gapless numbering, bounded groups, components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_scratch: dict[str, str] = {}
#: Keys with more than this share of the rows, one in so many, are joined by a broadcast of at most so many rows.
HOT_SHARE = 4096
#: Bits of a map of keys.
MARKS = 1 << 24
#: Edges of a written part, about.
EDGES = 1 << 15


def scratch(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder in local mode, in which driver and executors
    are one process; on a cluster that is an error, as executors don't see each other's disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _own_scratch:
        _own_scratch["dir"] = tempfile.mkdtemp(prefix="quillstone-")
        atexit.register(shutil.rmtree, _own_scratch["dir"], ignore_errors=True)
    return "file://" + _own_scratch["dir"]


def stash(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors. ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stash_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete stashed tables that nothing lazy refers to any more."""
    for df in frames:
        path = getattr(df, "_stash_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def gapless(df: DataFrame, keys: list[str], order: list[str], out: str, name: str = "numbered") -> DataFrame:
    """Number the rows of each key 0.. in ``order`` without bringing a key into one task.

    Rows are range-partitioned by (keys, order) and sorted; a row's place in its
    partition is native (``monotonically_increasing_id``), and a small table of
    (partition, key) counts, at most partitions + keys rows, turns it into a place
    within the key.
    """
    sort = [*keys, *order]
    laid = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in sort]).sortWithinPartitions(*sort)
    laid = stash(laid.withColumn("_at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    key = F.struct(*[F.col(c) for c in keys]) if keys else F.lit(0)
    laid = laid.withColumn("_key", F.xxhash64(F.to_json(key)) if keys else F.lit(0).cast("long"))
    heads = laid.groupBy("_key", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("_key", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        laid.join(F.broadcast(heads), ["_key", "_part"])
        .withColumn(out, (F.col("_at") - F.col("_first") + F.col("_before")).cast("long"))
        .drop("_key", "_part", "_at", "_first", "_before")
    )


def join_hot(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``groups``, one for each key, where a key may have any share of the rows.

    ``weight`` is a column of groups: the rows of the key. Keys with more than
    1 / HOT_SHARE of ``total`` rows are fewer than HOT_SHARE, so they are broadcast and
    their rows stay where they are; the others are joined by a shuffle. The weight is
    dropped. ``how``: inner or left.
    """
    most = max(1, total // HOT_SHARE)
    hot, cold = groups.where(F.col(weight) > most).drop(weight), groups.where(F.col(weight) <= most).drop(weight)
    mark = "_is_hot"
    at = rows.join(F.broadcast(hot.withColumn(mark, F.lit(True))), keys, "left")
    found = at.where(F.col(mark).isNotNull()).drop(mark)
    rest = at.where(F.col(mark).isNull()).select(*rows.columns).join(cold, keys, how)
    return found.unionByName(rest)


def parted(rows: DataFrame, ids: DataFrame, key: str, bits: int = MARKS) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose integer ``key`` is surely not one of ``ids`` (a column ``key``), or null, and the rest: all whose key is, and by chance others.

    So an exact join has only the rest to shuffle. The ids are marked in a bitmap of
    ``bits`` bits, of which words that have any are broadcast: bits / 64 rows at most,
    whatever the number of ids. Columns of any name stay.
    """
    at = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits))
    word, mark = F.shiftright(at, 6).alias("_word"), F.expr("shiftleft(1L, _bit)")
    words = stash(ids.select(word, at.bitwiseAND(63).cast("int").alias("_bit")).groupBy("_word").agg(F.bit_or(mark).alias("_marks")).coalesce(1), "marks")
    laid = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"), F.col(key).isNull().alias("_null"), word, at.bitwiseAND(63).cast("int").alias("_bit"))
    held = laid.join(F.broadcast(words), "_word", "left")
    found = ~F.col("_null") & (F.coalesce("_marks", F.lit(0).cast("long")).bitwiseAND(mark) != 0)
    return held.where(~found).select("_row.*"), held.where(found).select("_row.*")


def in_cells(rows: DataFrame, sizes: DataFrame, key: str, spread: str, limit: int) -> DataFrame:
    """``rows`` with a column ``cell``, such that any two rows of a key share a cell and none has more than about ``limit`` rows.

    ``sizes`` has (``key``, n). A key of at most ``limit`` rows is one cell. The rows of a
    larger one are dealt by the hash of ``spread`` into parts of half the limit, and each
    two parts are a cell, so a row goes to as many cells as there are other parts. The
    table of larger keys is broadcast: rows / limit of 16 bytes at most.
    """
    large = stash(sizes.where(F.col("n") > limit).select(key, F.ceil(F.col("n") * 2 / limit).cast("int").alias("_parts")), "large")
    if large.isEmpty():
        return rows.withColumn("cell", F.lit(0).cast("long"))
    own = F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: j != F.col("_own"))
    pairs = F.transform(others, lambda j: F.least(j, F.col("_own")) * F.col("_parts").cast("long") + F.greatest(j, F.col("_own")))
    held = rows.join(F.broadcast(large), key, "left").withColumn("_own", own)
    return held.withColumn("cell", F.explode(F.when(F.col("_parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs))).drop("_parts", "_own")


def last_group(key: np.ndarray, cell: np.ndarray) -> int:
    """Where the last group of equal (key, cell) begins, in sorted rows."""
    start = int(np.searchsorted(key, key[-1], "left"))
    return start + int(np.searchsorted(cell[start:], cell[-1], "left"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    Returns (node, component) for each node in an edge, component the smallest
    node reachable. Each round is a written table; only counts reach the driver. A
    table has no more parts than EDGES edges each make, as every file costs the
    executors' processes, on a local file system one to set its permissions.
    """

    def digest(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("h"), F.expr("bit_xor(xxhash64(v, u, 7))").alias("g")).first()
        return row["n"], row["h"], row["g"]

    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = stash(now, "edges")
    seen = digest(now)
    while seen[0]:
        parts = -(-seen[0] // EDGES)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # what a large star leaves at its own centre: (u, m) for u itself
        star = star.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        star = stash(star.coalesce(parts), "large-star")
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        nxt = star.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        nxt = stash(nxt.coalesce(parts), "small-star")
        then = digest(nxt)
        discard(now, star)
        now, done, seen = nxt, then == seen, then
        if done:
            break
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
