"""Chat formatting: cumulative snapshots collapse into the longest conversation, which is rendered.

Services log a conversation anew after each turn, so a logged conversation may be a
prefix of a longer one. Turns are laid out by (conversation, turn) over all partitions;
a rolling hash of the turns so far runs along each conversation and is carried over
partition borders by a table of one row per partition, so a conversation with most of
the rows is still spread. A conversation whose last hash is a hash before the end of
another is dropped by an anti-join; of equal conversations the smallest id stays.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import stash

#: Modulus and base of the rolling hash: a Mersenne prime and any value below it.
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1B54A32D192ED03A5F1C9B7 % ((1 << 127) - 1)
#: Turns in a rendered row; a longer conversation has more rows.
CHUNK = 512
START, END = "<|im_start|>", "<|im_end|>"
#: In what is rendered: a backslash is put in front of the sign, so no text can hold a marker.
ESCAPES = (("<\\", "<\\\\"), ("<|", "<\\|"))


def turn_hash(role: str | None, text: str | None) -> int:
    """A turn's value; null differs from empty."""
    d = hashlib.blake2b(digest_size=16)
    for x in (role, text):
        raw = b"" if x is None else x.encode("utf-8", "surrogatepass")
        d.update(b"%d:" % (-1 if x is None else len(raw)) + raw)
    return int.from_bytes(d.digest(), "little") % PRIME


def extend(prefix: int, turn: int) -> int:
    return (prefix * BASE + turn + 1) % PRIME


def escaped(text: Column) -> Column:
    """The text without markers of its own; ``ESCAPES`` backwards gives it back."""
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, pos, prefix, role, text): each turn's place from 1 on and the hash of the turns up to it.

    Turns are taken in the order (turn, role, text); repeated rows are turns of their own.
    """
    order = ["conv", "turn", "role", "text"]
    laid = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())

    def local(batches):
        last, pos, h, part, started = None, 0, 0, 0, False
        for batch in batches:
            out_pos, out_h = [], []
            convs, roles, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "role", "text"))
            if batch.num_rows:
                part = batch.column(batch.schema.get_field_index("_at"))[0].as_py() >> 33
            for conv, role, text in zip(convs, roles, texts, strict=True):
                if not started or conv != last:
                    last, pos, h, started = conv, 0, 0, True
                pos, h = pos + 1, extend(h, turn_hash(role, text))
                out_pos.append(pos)
                out_h.append(h.to_bytes(16, "big"))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("conv", "role", "text")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([part] * batch.num_rows, pa.int64()), pa.array(out_pos, pa.int64()), pa.array(out_h, pa.binary())], names=["conv", "role", "text", "part", "pos", "prefix"])

    kind = turns.schema["conv"].dataType.simpleString()
    rows = stash(laid.mapInArrow(local, f"conv {kind}, role string, text string, part long, pos long, prefix binary"), "turns")

    # the first and the last conversation of each partition: one row per partition reaches the driver
    ends = rows.groupBy("part").agg(
        F.min(F.struct(F.col("conv").isNotNull().alias("k"), "conv")).alias("first"),
        F.max(F.struct(F.col("conv").isNotNull().alias("k"), "conv", "pos", "prefix")).alias("last"),
    )
    carry, open_conv, open_pos, open_h, known = {}, None, 0, 0, False
    for r in ends.orderBy("part").select("part", F.col("first.conv").alias("first"), F.col("last.conv").alias("last"), F.col("last.pos").alias("pos"), F.col("last.prefix").alias("prefix")).collect():
        goes_on = known and r["first"] == open_conv
        if goes_on:
            carry[r["part"]] = (open_conv, open_pos, open_h)
        h = int.from_bytes(r["prefix"], "big")
        if goes_on and r["last"] == open_conv:
            open_pos, open_h = open_pos + r["pos"], (open_h * pow(BASE, r["pos"], PRIME) + h) % PRIME
        else:
            open_conv, open_pos, open_h = r["last"], r["pos"], h
        known = True
    if not carry:
        return rows.drop("part")
    sent = turns.sparkSession.sparkContext.broadcast(carry)

    def whole(batches):
        got = sent.value
        for batch in batches:
            pos, prefix = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for i, (conv, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                at = got.get(part)
                if at is not None and at[0] == conv:
                    prefix[i] = ((at[2] * pow(BASE, pos[i], PRIME) + int.from_bytes(prefix[i], "big")) % PRIME).to_bytes(16, "big")
                    pos[i] += at[1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pos, pa.int64()), pa.array(prefix, pa.binary())], names=["conv", "role", "text", "pos", "prefix"])

    return stash(rows.mapInArrow(whole, f"conv {kind}, role string, text string, pos long, prefix binary"), "turns")


def maximal(rows: DataFrame) -> DataFrame:
    """(conv, turns, collapsed): conversations that no longer one starts with, and how many equal ones each stands for besides itself."""
    lasts = rows.groupBy("conv").agg(F.max(F.struct("pos", "prefix")).alias("end")).select("conv", "end.pos", "end.prefix")
    lasts = stash(lasts, "lasts")
    finals = lasts.groupBy("pos", "prefix").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("equal"))
    inner = rows.select("pos", "prefix").groupBy("pos", "prefix").agg(F.count(F.lit(1)).alias("seen"))
    # more turns than whole conversations have this hash: some conversation goes on after it
    longer = inner.join(finals.select("pos", "prefix", "equal"), ["pos", "prefix"]).where("seen > equal").select("pos", "prefix")
    whole = finals.join(longer, ["pos", "prefix"], "left_anti")
    return whole.select("conv", F.col("pos").alias("turns"), (F.col("equal") - 1).alias("collapsed"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(conv, turns, collapsed, chunk, text): each maximal conversation rendered, ``chunk`` turns a row.

    A null role is rendered as ``user``, a null text as empty, though either differs
    from the other when conversations are compared; the turns without a conversation id
    are one conversation. Markers within a text or role are escaped, and a role's line
    feeds become spaces, so no turn can pose as another. Repeated rows are turns of their
    own. No rows give no rows. Only the named columns are read.
    """
    held = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = prefixes(held)
    kept = stash(maximal(rows), "maximal")
    role = escaped(F.translate(F.coalesce("role", F.lit("user")), "\r\n", "  "))
    shown = F.concat(F.lit(START), role, F.lit("\n"), escaped(F.coalesce("text", F.lit(""))), F.lit(END + "\n"))
    chunks = kept.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("turns") - 1) / chunk).cast("int"))))
    # the join is by conversation and chunk, so a long conversation is not one task's
    parts = rows.select(F.col("conv").alias("_conv"), F.floor((F.col("pos") - 1) / chunk).cast("int").alias("_chunk"), "pos", shown.alias("shown"))
    parts = parts.join(chunks, F.col("_conv").eqNullSafe(F.col("conv")) & (F.col("_chunk") == F.col("chunk")))
    told = parts.groupBy("conv", "turns", "collapsed", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "shown"))).alias("p"))
    return told.select("conv", "turns", "collapsed", "chunk", F.array_join("p.shown", "").alias("text"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations by ``format_chats``; nulls, repeated rows, long conversations and an empty table as there."""
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet")).withColumnRenamed("conv", "conv_id")


OP2_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos, role, text FROM conversations),
p AS (SELECT conv_id, pos, md5(string_agg(md5(coalesce(role, '\\N')) || md5(coalesce(text, '\\N')), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos)) AS h FROM t),
f AS (SELECT conv_id, max(pos) AS pos, arg_max(h, pos) AS h FROM p GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, pos AS turns, count(*) - 1 AS collapsed FROM f
      WHERE NOT EXISTS (SELECT 1 FROM p JOIN f g ON g.conv_id = p.conv_id WHERE p.h = f.h AND p.pos = f.pos AND g.pos > p.pos) GROUP BY f.h, pos)
SELECT k.conv_id, k.turns, k.collapsed, ((t.pos - 1) // 512)::INTEGER AS chunk,
       string_agg('<|im_start|>' || replace(replace(translate(coalesce(role, 'user'), chr(13) || chr(10), '  '), '<\', '<\\'), '<|', '<\|') || chr(10) || replace(replace(coalesce(text, ''), '<\', '<\\'), '<|', '<\|') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS text
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY ALL
"""
