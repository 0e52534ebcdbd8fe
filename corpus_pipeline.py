"""Corpus pipeline: quality, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on every row of ``docs``, what the
stage before it kept; all but the last return the columns of ``documents``.  Labels
are read from ``sf_dir``; models are fitted anew on the stage's own documents.

Defined cases: rows with null ids, null or empty texts and repeated rows go through
every stage; of a group of near-duplicates (repeated rows included) exactly one row
stays; an empty table gives an empty result of the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import packing, quality_pu, secret_scan, shared, simhash, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the fitted stages; tests hold the pipeline against a plain one instead.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` only: further ones could clash with a stage's own."""
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    docs = _documents(docs)
    model = quality_pu.train(docs, shared.read_table(spark, sf_dir, "labels"))
    return quality_pu.judge(docs, model, "_score").where(F.col("_score") >= quality_pu.ACCEPT).drop("_score")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity classifier marks."""
    docs = _documents(docs)
    model = toxicity.train(docs, shared.read_table(spark, sf_dir, "labels"))
    return toxicity.judge(docs, model, "_score").where(F.col("_score") < toxicity.REJECT).drop("_score")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash component: the one of smallest id (then digest of its columns)."""
    docs = _documents(docs)
    # Equal rows share this key; it names the id, so that only digests of rows of one id could collide.
    rows = docs.withColumn("_row", F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64(*docs.columns))))
    found = simhash.near_duplicates(rows, keep=("doc_id", "_row")).select(
        F.col("component_fingerprint").alias("_group"), F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("_order"))
    slim = shared.cut(found.groupBy("_group", "_order").agg(F.count("*").alias("_copies")))
    first = shared.cut(slim.groupBy("_group").agg(F.min("_order").alias("_first"), F.sum("_copies").alias("_n"),
                                                  F.count("*").alias("_rows")).where("_n > 1").drop("_n"))
    # Rows of groups only: those that go, and those that stay but are there several times.
    grouped = shared.cut(shared.join_hot(slim, first, "_group", "_rows", slim.count()).select(F.col("_order._row").alias("_row"), "_copies",
                                                           (F.col("_order") == F.col("_first")).alias("_stays")))
    named = shared.sized(grouped.where("not _stays or _copies > 1").select("_row"))
    kept = rows.join(named, "_row", "left_anti")
    again = grouped.where("_stays and _copies > 1").select("_row")
    if not again.isEmpty():
        kept = kept.unionByName(rows.join(shared.sized(again), "_row", "left_semi").dropDuplicates(["_row"]))
    return kept.drop("_row")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found in the texts."""
    return secret_scan.redact(_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, shared.vocabulary("word_bpe_49k.json"), capacity=2048)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("dedup", dedup_stage), ("secrets", secrets_stage),
          ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    docs = shared.read_table(spark, sf_dir, "documents").select(*COLUMNS)
    root = f"{shared.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
