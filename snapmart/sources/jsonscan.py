"""S6–S11 — scan landed JSON into the raw tables.

The JSON reader's ``singleVariantColumn`` keeps each document whole as one
VARIANT (an outer array stays one row, keys are never inferred), Hive-style
directories become ``source``/``extract_date`` columns, and the file path comes
from ``_metadata``.  A corrupt document aborts the scan (``FAILFAST``), like
``on_error = ABORT_STATEMENT``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.variant import as_string
from snapmart.session import fresh_dir

RAW_COLUMNS = ["source", "s3_key", "extracted_at", "payload", "loaded_at"]


def scan_landing(spark: SparkSession, root, multi_line: bool = True, source: str | None = None,
                 extract_date: str | None = None, fail_fast: bool = True, base: str | None = None) -> DataFrame:
    """Returns (source, extract_date, file_path, payload), and ``file`` where that is a partition.

    ``root`` is the landing root, or a list of its files or folders with the root as ``base``.
    ``multi_line``: one document a file, pretty-printed or not; else one document a line.
    ``source``/``extract_date`` filters hit partition columns and prune
    directories before any file is opened (S8).
    """
    reader = (spark.read.option("multiLine", multi_line).option("singleVariantColumn", "payload")
              .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
              .option("basePath", base or root))
    df = reader.json(root if base else _partition_path(spark, root, source, extract_date))
    df = df.select(F.col("source").cast("string").alias("source"), F.col("extract_date").cast("string").alias("extract_date"),
                   *[F.col(c).cast("string").alias(c) for c in ("file",) if c in df.columns], F.col("_metadata.file_path").alias("file_path"), "payload")
    if source is not None:
        df = df.where(F.col("source") == source)
    if extract_date is not None:
        df = df.where(F.col("extract_date") == extract_date)
    return df


def _partition_path(spark: SparkSession, root: str, source: str | None, extract_date: str | None):
    """The folders of one day (or source), so that not the whole landing tree is listed; the root if there are none."""
    from snapmart.sources.catalog import _fs

    pattern = f"{root.rstrip('/')}/source={source or '*'}/extract_date={extract_date or '*'}"
    fs, p, _ = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [st.getPath().toString() for st in found] if found and (source or extract_date) else root


def list_files(spark: SparkSession, root: str, extract_date: str | None) -> DataFrame:
    """(source, s3_key, file_path) of a day's landed files (all days' without one), from a listing: no file is opened."""
    path = _partition_path(spark, root, "*", extract_date)
    if path == root:
        return spark.createDataFrame([], "source string, s3_key string, file_path string")
    files = spark.read.format("binaryFile").option("basePath", root).load(path)
    if "source" not in files.columns:  # the folders are empty
        return spark.createDataFrame([], "source string, s3_key string, file_path string")
    return files.select(F.col("source").cast("string").alias("source"), relative_file_key("path").alias("s3_key"),
                        F.col("path").alias("file_path"))


def plain_files(spark: SparkSession, root: str, extract_date: str | None, keys: DataFrame | None) -> DataFrame:
    """``list_files`` without files whose own key is among the landed ``keys`` (what is landed by key lies elsewhere)."""
    files = list_files(spark, root, extract_date)
    return files if keys is None else files.join(keys.select(relative_file_key("s3_key").alias("s3_key")), "s3_key", "left_anti")


def relative_file_key(path) -> Column:
    """The key of a file below its landing root: from ``source=`` on."""
    return F.regexp_replace(path, "^.*?/(source=)", "$1")


#: Files (and keys of files that are read in part) sent to every task; beyond that their joins shuffle.
MANY_FILES = 200_000


def scan_keys(spark: SparkSession, root: str, keys: DataFrame, extract_date: str | None = None, source: str | None = None) -> DataFrame:
    """The envelopes of exactly the listed landed keys: (source, extract_date, s3_key, payload).

    ``keys`` are rows of ``landing.landed_keys``.  Files all of whose keys are asked for are
    taken as they are; lines are compared with keys only in the others (an older write that
    was replaced in part).  Files of unfinished writes hold no listed key.
    """
    from snapmart.sources.landing import DATA

    at = ["source", "extract_date", "file"]
    if source is not None:
        keys = keys.where(F.col("source") == source)
    if extract_date is not None:
        keys = keys.withColumn("extract_date", F.lit(extract_date))
    path = fresh_dir(spark, "scan-files")
    keys.groupBy(*at).agg((F.count(F.lit(1)) == F.max("in_file")).alias("_whole")).write.parquet(path)
    files = spark.read.schema("source string, extract_date string, file string, _whole boolean").parquet(path)
    n, n_part = files.agg(F.count(F.lit(1)), F.count_if(~F.col("_whole"))).first()
    if not n:
        return spark.createDataFrame([], "source string, extract_date string, s3_key string, payload variant")
    scan = scan_landing(spark, f"{root.rstrip('/')}/{DATA}", multi_line=False, extract_date=extract_date, source=source)
    # asked for, so that the reader never goes without the document (Spark 4.1 fails then)
    scan = scan.where(F.col("payload").isNotNull()).withColumn("s3_key", as_string("payload", "$.landing_key"))
    named = scan.join(F.broadcast(files) if n <= MANY_FILES else files, at)
    if n_part:
        some = keys.join(files.where(~F.col("_whole")).select(*at), at).select(*at, "s3_key", F.lit(True).alias("_asked"))
        some = F.broadcast(some) if some.count() <= MANY_FILES else some
        named = named.join(some, [*at, "s3_key"], "left").where(F.col("_whole") | F.col("_asked"))
    return named.select("source", "extract_date", "s3_key", "payload")


def load_key(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The envelopes of one key, out of the one file that the key list names; no rows if it was not landed."""
    from snapmart.sources.landing import DATA, landed_keys

    day = re.search(r"source=([^/]+)/extract_date=([^/]+)/", key)
    keys = landed_keys(spark, root, day[2] if day else None)
    found = keys.where(F.col("s3_key") == key).first() if keys is not None else None
    if found is None:
        return spark.createDataFrame([], "source string, extract_date string, s3_key string, payload variant")
    base = f"{root.rstrip('/')}/{DATA}"
    scan = scan_landing(spark, [f"{base}/source={found['source']}/extract_date={found['extract_date']}/file={found['file']}"], multi_line=False, base=base)
    return scan.withColumn("s3_key", as_string("payload", "$.landing_key")).where(F.col("s3_key") == key).select(
        "source", "extract_date", "s3_key", "payload")


def to_raw(scan: DataFrame, source: str | None = None, loaded_at=None, key_col: str = "file_path",
           root: str | None = None) -> DataFrame:
    """The raw-table projection of scanned documents.

    ``extracted_at`` is the envelope's own ``extracted_at_utc`` (a ``…Z`` string
    read as UTC wall time), never the partition date (trap T12).
    """
    src = F.lit(source) if source is not None else F.col("source")
    key = F.col(key_col)
    if root is not None:
        key = F.regexp_replace(key, "^" + _re_escape(root.rstrip("/")) + "/", "")
    ts = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ts, str):
        ts = F.lit(ts).cast("timestamp_ntz")
    return scan.select(src.alias("source"), key.alias("s3_key"),
                       F.to_timestamp_ntz(as_string("payload", "$.extracted_at_utc")).alias("extracted_at"),
                       "payload", ts.alias("loaded_at"))


def _re_escape(s: str) -> str:
    return re.escape(s)
