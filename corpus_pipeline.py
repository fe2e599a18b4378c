"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; it is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import decontam, neartext, packing, toxicity
from quillstone.llm.common import gapless, parted, stash

#: Scores from here on are rejected.
TOXIC = 0.7


def unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of docs has it."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below TOXIC, by a model fitted on the labels that may be learned from.

    Null and empty texts have no evidence and stay; repeated rows and null ids are scored
    like any other, and columns of any name stay. No rows give no rows.
    """
    scorer = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "_toxic_score")
    scored = toxicity.with_score(docs, scorer, out=score)
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of smallest id.

    Where ids are null or repeat, rows are numbered by id, nulls first, and a hash of all
    their columns, and the first of a class stays. Texts without words are one class.
    Columns of any name stay. No rows give no rows.
    """
    key = "doc_id"
    if docs.where("doc_id is null").limit(1).count() or docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        key, row = unused(docs, "_key"), F.struct(*[docs[c] for c in docs.columns])
        docs = gapless(docs.select(row.alias("row"), docs["doc_id"].alias("id"), F.xxhash64(F.to_json(row)).alias("hash")), [], ["id", "hash"], "n", "keyed").select("row.*", F.col("n").alias(key))
    gone = stash(neartext.near_texts(docs, id_col=key).where("not id <=> component").select(F.col("id").alias(key)), "gone")
    stay, rest = parted(docs, gone, key)
    return stay.unionByName(rest.join(gone, key, "left_anti").select(*docs.columns)).select(*(c for c in docs.columns if c != key or key == "doc_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows into which no benchmark item leaks; nulls, empty texts and repeated rows as in ``decontam.without_leaks``."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence; nulls, empty texts and repeated rows as in ``packing.pieces`` and ``packing.pack``."""
    return packing.pack(stash(packing.pieces(docs), "pieces"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("benchmark_decontamination", drop_leaks), ("best_fit_packing", pack)]

#: A fitted model, fingerprints and a tokenizer are beyond SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
