"""Sharding by balanced label propagation over documents linked by equal texts.

Rows are numbered in hash order and dealt round, so that shard counts differ by one at
most. A group of equal texts, or a block of it if it is larger than a shard,
then votes: its label is the shard that holds most of it. Members elsewhere ask to move
there. A shard's quota of arrivals is what leaves it plus the unlinked rows that can
make room; members are let in by group, largest groups first, and for each shard as
many unlinked rows move from shards that gained to shards that lost. Counts so stay as
they were dealt while edges between shards go. Rounds end when a round lets nobody move,
or would spread the groups over as many shards as before.

What reaches the driver is a table of shards by shards; votes, ranks and moves are
joins and aggregations, and numbering is done across partitions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import discard, gapless, join_hot, stash

SHARDS = 40


def quotas(asks: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves let through, of linked and of unlinked rows, from shard to shard.

    ``asks[i, j]``: linked rows of shard i that ask for j; ``free[i]``: unlinked rows of i.
    Each shard gets as many rows as it gives.
    """
    k = len(free)
    allowed = asks.copy()
    np.fill_diagonal(allowed, 0)
    while True:  # a shard cannot give more than it has to make room
        gain = allowed.sum(0) - allowed.sum(1)
        over = gain - free
        if (over <= 0).all():
            break
        j = int(over.argmax())
        cut = int(over[j])
        for i in np.argsort(allowed[:, j], kind="stable"):
            take = min(cut, int(allowed[i, j]))
            allowed[i, j] -= take
            cut -= take
            if not cut:
                break
    room = np.zeros((k, k), np.int64)
    give, take = np.maximum(gain, 0), np.maximum(-gain, 0)
    i = j = 0
    while i < k and j < k:
        n = min(give[i], take[j])
        room[i, j] += n
        give[i] -= n
        take[j] -= n
        if not give[i]:
            i += 1
        elif not take[j]:
            j += 1
    return allowed, room


def _limits(spark: SparkSession, linked: np.ndarray, room: np.ndarray) -> DataFrame:
    """(now, to, linked, lo, hi): places in a rank up to which rows move; shards squared rows at most."""
    rows = []
    ends = room.cumsum(1)
    for i in range(len(room)):
        for j in range(len(room)):
            if linked[i, j] or room[i, j]:
                rows.append((i, j, int(linked[i, j]), int(ends[i, j] - room[i, j]), int(ends[i, j])))
    return spark.createDataFrame(rows, "now int, to int, linked long, lo long, hi long")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for each row; counts of shards differ by one at most.

    A null text has no bytes and is linked to other null texts; null ids and repeated
    rows are dealt like others. No rows give no rows. Only the named columns are read.
    """
    spark = docs.sparkSession
    text = F.encode(F.col(text_col).cast("string"), "utf-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("h1"), F.md5(F.coalesce(text, F.lit(b""))).alias("digest"), text.isNull().alias("none"))
    # rows of equal ids and texts, of which there may be any number, are told apart by their place
    rows = rows.withColumns({"_order": F.xxhash64("doc_id", F.lit(11)), "_place": F.monotonically_increasing_id()})
    now = gapless(rows, [], ["_order", "doc_id", "digest", "_place"], "_n", "dealt").withColumn("shard", (F.col("_n") % shards).cast("int"))
    now = stash(now.drop("_order", "_place"), "dealt")
    total = now.count()
    block = max(2, total // shards)
    keys = ["digest", "none"]
    groups = now.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    groups = stash(groups.withColumns({"blocks": F.ceil(F.col("members") / block).cast("int"), "weight": F.col("members")}), "groups")
    linked = join_hot(now, groups, keys, "weight", total)
    linked = linked.withColumn("block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("_n"), F.col("blocks")).cast("int")).otherwise(0))
    linked = stash(linked.select("_n", "shard", F.xxhash64("digest", "none", "block").alias("block"), F.when(F.col("blocks") > 1, F.col("members") / F.col("blocks")).otherwise(F.col("members")).cast("long").alias("members")), "linked")
    loose = stash(now.select("_n", "shard").join(linked.select("_n"), "_n", "left_anti"), "loose")

    before = None
    while True:
        votes = stash(linked.groupBy("block", "shard").agg(F.count(F.lit(1)).alias("n")), "votes")
        spread = votes.count()
        if before is not None and spread >= before[0]:
            linked, loose = before[1:]
            break
        before = spread, linked, loose
        label = votes.groupBy("block").agg(F.max_by("shard", F.struct("n", F.xxhash64("block", "shard"))).alias("to"), F.sum("n").alias("weight"))
        asks = join_hot(linked, label, ["block"], "weight", total).withColumn("to", F.when(F.col("to") != F.col("shard"), F.col("to")))
        asks = stash(asks, "asks")
        want, free = np.zeros((shards, shards), np.int64), np.zeros(shards, np.int64)
        for r in asks.where("to is not null").groupBy("shard", "to").count().collect():
            want[r["shard"], r["to"]] = r["count"]
        for r in loose.groupBy("shard").count().collect():
            free[r["shard"]] = r["count"]
        allowed, room = quotas(want, free)
        if not allowed.any():
            break
        limits = F.broadcast(_limits(spark, allowed, room))
        movers = gapless(asks.where("to is not null").withColumn("_by", -F.col("members")), ["shard", "to"], ["_by", "block", "_n"], "_rank", "movers")
        movers = movers.join(limits.select(F.col("now").alias("shard"), "to", F.col("linked").alias("_quota")), ["shard", "to"]).where("_rank < _quota")
        linked_next = asks.drop("to").join(movers.select("_n", "to"), "_n", "left").select("_n", F.coalesce("to", "shard").alias("shard"), "block", "members")
        ranked = gapless(loose, ["shard"], ["_n"], "_rank", "makers")
        span = limits.where("hi > lo").select(F.col("now").alias("shard"), "to", "lo", "hi")
        steps = span.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "to"))).alias("spans"))
        chosen = F.element_at(F.filter("spans", lambda s: (F.col("_rank") >= s["lo"]) & (F.col("_rank") < s["hi"])), 1)["to"]
        loose_next = ranked.join(F.broadcast(steps), "shard", "left").select("_n", F.coalesce(F.when(F.exists("spans", lambda s: (F.col("_rank") >= s["lo"]) & (F.col("_rank") < s["hi"])), chosen), F.col("shard")).alias("shard"))
        linked, loose = stash(linked_next, "linked"), stash(loose_next, "loose")
        discard(asks, votes)

    placed = now.drop("shard").join(linked.select("_n", "shard").unionByName(loose), "_n")
    return gapless(placed, ["shard"], ["_n"], "slot", "placed").drop("h1", "none")


def cut_links(placed: DataFrame) -> DataFrame:
    """(groups, rows, spread): groups of equal texts, their rows, and the shards that they lie in beyond one each."""
    each = placed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("shard").alias("s")).where("n > 1")
    return each.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"), F.sum(F.col("s") - 1).alias("spread"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards under the law ``rows``; nulls, empty texts, repeated rows and an empty table as in ``assign``."""
    placed = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

