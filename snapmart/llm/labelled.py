"""Bounded samples of labelled documents, for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def learn_labels(labels: DataFrame, column: str, docs: DataFrame | None = None) -> DataFrame:
    """``doc_id`` and ``y`` (0 or 1) of the rows that may be learnt from: not held out, one per id (1 if any says so).

    With ``docs`` only labels of ids that these hold: a bounded sample is then drawn from what it is joined with.
    """
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("y"))
    found = (rows.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~shared.held_out("doc_id"))
             .groupBy("doc_id").agg(F.max((F.col("y") > 0).cast("int")).alias("y")))
    return found if docs is None else found.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")


def sample(learn: DataFrame, ones: int, zeros: int) -> DataFrame:
    """At most ``ones`` and ``zeros`` rows of either label: those whose ids hash lowest, at every run the same.

    ``half`` (0 or 1) splits them for fitting and calibrating.
    """
    ranked = learn.withColumn("h", F.xxhash64("doc_id"))
    picked = [ranked.where(F.col("y") == y).orderBy("h", "doc_id").limit(n) for y, n in ((1, ones), (0, zeros))]
    return picked[0].unionByName(picked[1]).select("doc_id", "y", F.pmod(F.xxhash64("h"), F.lit(2)).alias("half"))


def with_text(docs: DataFrame, picked: DataFrame, most: int) -> DataFrame:
    """The sample's rows with their whole texts (one of repeated ids); ``most`` bounds the sample, so it is broadcast."""
    if most > 50_000:
        raise ValueError("the sample must stay small enough to broadcast")
    return (shared.doc_text(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y", "half")
            .agg(F.min("text").alias("text")))
