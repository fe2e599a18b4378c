"""Incremental ingestion: per-id watermarks, gaps of the outbox, idempotent merges into versioned tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.relational import latest_per_key, merge_on_key


def watermarks(loaded: DataFrame, key: str = "id", sequence: str = "sequence") -> DataFrame:
    """The last loaded sequence of each id."""
    return loaded.groupBy(key).agg(F.max(sequence).alias("_max"))


def newer_than(events: DataFrame, marks: DataFrame, key: str = "id", sequence: str = "sequence", again: DataFrame | None = None, until=None, recorded_at: str = "recorded_at") -> DataFrame:
    """Events above their id's watermark; a new id has none.

    ``again``: ids to load whole, as an erasure changed them. ``until``: only events recorded by then.
    """
    if until is not None:
        events = events.where(F.col(recorded_at) <= F.lit(until).cast("timestamp_ntz"))
    out = events.join(marks, key, "left")
    fresh = F.col(sequence) > F.coalesce("_max", F.lit(0))
    if again is not None:
        out = out.join(again.select(key).distinct().withColumn("_again", F.lit(True)), key, "left")
        return out.where(fresh | F.col("_again").isNotNull()).drop("_max", "_again")
    return out.where(fresh).drop("_max")


def gaps(outbox: DataFrame, sequence: str, above: int = 0) -> DataFrame:
    """(first_missing, last_missing) ranges between the watermark and the highest sequence seen.

    Neighbours are found within ranges of the sequence, whose borders are joined, so no
    task sorts the whole outbox.
    """
    rows = outbox.where(F.col(sequence) > above).select(F.col(sequence).alias("s")).distinct()
    width = 1 << 20
    rows = rows.withColumn("bucket", F.floor(F.col("s") / width))
    inside = rows.withColumn("before", F.lag("s").over(Window.partitionBy("bucket").orderBy("s")))
    ends = rows.groupBy("bucket").agg(F.min("s").alias("s"), F.max("s").alias("last"))
    # one row for each 2^20 sequence numbers
    ends = ends.withColumn("before", F.coalesce(F.lag("last").over(Window.orderBy("bucket")), F.lit(above))).select("s", "before")
    pairs = inside.where("before is not null").select("s", "before").unionByName(ends)
    return pairs.where("s - before > 1").select((F.col("before") + 1).alias("first_missing"), (F.col("s") - 1).alias("last_missing"))


@dataclass
class Advance:
    watermark: int
    stalled_at: int | None = None
    abandoned: list[tuple[int, int]] = field(default_factory=list)


def resolve_watermark(start: int, highest: int, missing: Iterable[tuple[int, int]], passed: Callable[[], bool], present: Callable[[int, int], list[tuple[int, int]]]) -> Advance:
    """How far the contiguous watermark may go.

    ``missing``: ranges of holes, ascending. ``passed``: whether every writer that was
    open when the holes were seen has ended. ``present``: the sub-ranges of a range that
    have appeared since. A hole is abandoned only if it is still one after all such
    writers have ended; the watermark stalls before one that isn't proven, and stops
    before one that a late commit has filled, so the next run reads it.
    """
    out = Advance(start)
    for lo, hi in missing:
        if not passed():
            return Advance(lo - 1, lo, out.abandoned)
        late = sorted(present(lo, hi))
        if late:
            first = late[0][0]
            if first > lo:
                out.abandoned.append((lo, first - 1))
            return Advance(first - 1, first, out.abandoned)
        out.abandoned.append((lo, hi))
    return Advance(max(start, highest), None, out.abandoned)


class Conflict(RuntimeError):
    """Another writer has made the version that this one was to be."""


class VersionedTable:
    """A Parquet table whose versions are folders, each made current by a marker that is created last.

    A run that dies leaves the old version in place; readers of it are not disturbed. A
    marker is created only if there is none of its number, so of two writers that began
    from the same version one fails and loses nothing of the other's.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _marks(self) -> list[str]:
        marks = self._path(f"{self.path}/_versions")
        return sorted((m.getPath().getName() for m in self._fs.listStatus(marks)), reverse=True) if self._fs.exists(marks) else []

    def _at(self) -> tuple[int, str | None]:
        """The number of the last version and the folder of the current one; a marker that was never filled is passed over."""
        marks = self._marks()
        for name in marks:
            path = self._path(f"{self.path}/_versions/{name}")
            if self._fs.getFileStatus(path).getLen():
                mark = self._fs.open(path)
                try:
                    return int(marks[0]), mark.readUTF()
                finally:
                    mark.close()
        return int(marks[0]) if marks else 0, None

    def _current(self) -> str | None:
        return self._at()[1]

    def exists(self) -> bool:
        return self._current() is not None

    def read(self) -> DataFrame:
        now = self._current()
        if now is None:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(f"{self.path}/{now}")

    def replace(self, df: DataFrame, after: int | None = None) -> None:
        """Make ``df`` the table. ``after``: the version that it was made from, by default the current one."""
        after = self._at()[0] if after is None else after
        name = f"{after + 1:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        self._fs.mkdirs(self._path(f"{self.path}/_versions"))
        try:
            mark = self._fs.create(self._path(f"{self.path}/_versions/{after + 1:012d}"), False)
        except Exception as e:
            self._fs.delete(self._path(f"{self.path}/{name}"), True)
            raise Conflict(f"{self.path} has a version {after + 1} by another writer") from e
        mark.writeUTF(name)
        mark.close()

    def merge(self, new: DataFrame, keys: list[str], load_id: str | None = None) -> None:
        """Rows of ``new`` replace those of equal key; tables without our load column are refused."""
        new = new.withColumn("_load_id", F.lit(load_id or uuid.uuid4().hex))
        after = self._at()[0]
        if self.exists():
            old = self.read()
            if "_load_id" not in old.columns:
                raise ValueError(f"{self.path} was not written by this loader; refresh it whole to load over it")
            new = merge_on_key(old, new, keys)
        self.replace(new, after)

    def drop(self) -> None:
        self._fs.delete(self._path(self.path), True)


def stream_into(target: VersionedTable, source: DataFrame, keys: list[str], checkpoint: str, order: list[str] | None = None) -> None:
    """Load everything that a streaming ``source`` has now, once, by idempotent merges.

    Batches that are repeated after a failure merge to the same table. Of a batch's rows
    of equal keys the last in ``order`` stays; of those that it can't tell apart, always the same.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        if not df.isEmpty():
            target.merge(latest_per_key(df, keys, [*(order or []), F.xxhash64(*df.columns)]), keys, f"batch-{epoch}")

    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
