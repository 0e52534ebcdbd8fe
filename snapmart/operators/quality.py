"""Q1–Q4 — column checks, source freshness and the check report.

Each check is one distributed aggregate over the model; the report is a small
union of per-check rows (model, column_name, test, failures, status).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.timefmt import seconds_between

REPORT_COLUMNS = ["model", "column_name", "test", "failures", "status"]


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Q1: NULL count of every listed column, in one pass over the model."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    long = wide.unpivot([], columns, "column_name", "failures")
    return _finish(long, model, "not_null")


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q2: number of non-NULL values seen more than once."""
    dups = (df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1))
    agg = dups.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
    return _finish(agg.withColumn("column_name", F.lit(column)), model, "unique")


def column_tests(df: DataFrame, model: str, not_null: list[str], unique: list[str]) -> DataFrame:
    """Q1 and Q2 of a model from one scan: NULLs are counted while the (one) unique column is grouped."""
    if not unique:
        return globals()["not_null"](df, model, not_null)
    if len(unique) > 1:
        raise ValueError("one unique column a model; further ones need a pass of their own")
    key = unique[0]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, c in enumerate(not_null)]
    groups = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"), *nulls)
    twice = F.count_if(F.col("_key").isNotNull() & (F.col("n") > 1)).cast("bigint")
    found = groups.agg(twice.alias("u"), *[F.coalesce(F.sum(f"n{k}"), F.lit(0)).cast("bigint").alias(f"n{k}")
                                           for k in range(len(not_null))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test"), F.col(f"n{k}").alias("failures"))
                     for k, c in enumerate(not_null)],
                   F.struct(F.lit(key).alias("column_name"), F.lit("unique").alias("test"), F.col("u").alias("failures")))
    long = found.select(F.explode(rows).alias("r")).select("r.*")
    return long.select(F.lit(model).alias("model"), "column_name", "test", "failures",
                       F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))


def counted_tests(spark: SparkSession, model: str, found: list[tuple[str, str, int]]) -> DataFrame:
    """Q1 and Q2 from counts taken while the model was written: a row a (column, test, failures), no scan."""
    long = spark.createDataFrame(found, "column_name string, test string, failures bigint")
    return long.select(F.lit(model).alias("model"), "column_name", "test", "failures",
                       F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))


class ChecksFailed(Exception):
    """A run's column tests failed; the stored report names them."""


def _finish(df: DataFrame, model: str, test: str) -> DataFrame:
    return df.select(F.lit(model).alias("model"), "column_name", F.lit(test).alias("test"), "failures",
                     F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))


def freshness(raw: DataFrame, source_name: str, now, ts_col: str = "extracted_at",
              warn_after_days: int = 2, error_after_days: int = 7) -> DataFrame:
    """Q3: age of ``max(ts)`` at ``now``; ``warn``/``error`` when strictly older."""
    now_c = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    latest = raw.agg(F.max(ts_col).alias("max_loaded_at"))
    age = seconds_between(F.col("max_loaded_at"), now_c)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("age_seconds") > error_after_days * 86400, F.lit("error"))
              .when(F.col("age_seconds") > warn_after_days * 86400, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return (latest.withColumn("age_seconds", age.cast("double"))
            .select(F.lit(source_name).alias("source"), "max_loaded_at", "age_seconds", status.alias("status")))


def report(*checks: DataFrame) -> DataFrame:
    """Q4: all check rows together; the run fails when any row is ``fail``."""
    return reduce(lambda a, b: a.unionByName(b), [c.select(*REPORT_COLUMNS) for c in checks])


def failed(report_df: DataFrame) -> bool:
    """Gate for a run: true when any check failed (reads one row at most)."""
    return not report_df.where(F.col("status") == "fail").isEmpty()
