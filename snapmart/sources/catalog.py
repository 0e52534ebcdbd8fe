"""S12/S14 — namespaces, raw tables and versioned table writes.

A mart is never overwritten in place: each build writes a new
``version=<n>`` directory, and readers take the newest version whose write
committed (``_SUCCESS``).  A failed or partial write is therefore invisible, and
a plan that reads the current version can safely produce the next (trap T19).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RAW_TABLE_DDL = {
    "rawg_games_raw": "source string, s3_key string, extracted_at timestamp_ntz, payload variant, loaded_at timestamp_ntz",
    "steam_games_raw": "source string, s3_key string, extracted_at timestamp_ntz, payload variant, loaded_at timestamp_ntz",
    "raw_load_audit": "source string, s3_key string, target_table string, rows_loaded bigint, status string, loaded_at timestamp_ntz",
}
#: Payloads repeat their field names and most values: about half the bytes of the default codec.
COMPRESSION = "zstd"
#: Options of a write of envelopes.  The reader takes up to 4,096 rows at once, and as many of them as fit a
#: compressed row group may be large, so a file holds some tens of MB of payloads.
RAW_OPTIONS = {"compression": COMPRESSION, "maxRecordsPerFile": 512}
NAMESPACES = ["raw", "staging", "mart"]


def raw_path(root: str, table: str) -> str:
    """Where a raw table lives: what ``create_objects`` declares is what a run writes and reads."""
    return f"{root.rstrip('/')}/raw/{table}"


def create_objects(spark: SparkSession, root: str) -> None:
    """Create-if-missing namespaces and raw tables (Parquet, under ``root``), one partition a committed load.

    A table that the session knows from another root is declared anew; its files stay.
    """
    for ns in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{root}/{ns}.db'")
    for name, cols in RAW_TABLE_DDL.items():
        path = raw_path(root, name)
        if spark.catalog.tableExists(f"raw.{name}"):
            where = spark.sql(f"DESCRIBE TABLE EXTENDED raw.{name}").where("col_name = 'Location'").first()
            if where is not None and where["data_type"].split(":")[-1].lstrip("/") != path.split(":")[-1].lstrip("/"):
                spark.sql(f"DROP TABLE raw.{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS raw.{name} ({cols}, batch string) USING parquet PARTITIONED BY (batch) LOCATION '{path}'")


def add_batches(spark: SparkSession, root: str, batches: list[str]) -> None:
    """Make committed batches part of the declared raw tables: SQL readers see what the ledger lists."""
    for name in RAW_TABLE_DDL:
        known = {r[0].removeprefix("batch=") for r in spark.sql(f"SHOW PARTITIONS raw.{name}").collect()}
        for batch in batches:
            path = f"{raw_path(root, name)}/batch={batch}"
            fs, p, _ = _fs(spark, path)
            if batch not in known and fs.exists(p):
                spark.sql(f"ALTER TABLE raw.{name} ADD PARTITION (batch='{batch}') LOCATION '{path}'")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def expire_versions(spark: SparkSession, table_root: str, keep: int) -> list[str]:
    """Remove all but the newest ``keep`` committed versions (and uncommitted ones older than those); returns their names.

    A reader opens the newest version, so ``keep`` must cover the time a read can take.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    fs, p, jvm = _fs(spark, table_root)
    if not fs.exists(p):
        return []
    names = sorted(st.getPath().getName() for st in fs.listStatus(p)
                   if st.isDirectory() and st.getPath().getName().startswith("version="))
    done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, f"{n}/_SUCCESS"))]
    old = [n for n in names if len(done) > keep and n < done[-keep]]
    for n in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(p, n), True)
    return old


def new_version(table_root: str) -> str:
    return f"{table_root.rstrip('/')}/version={int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, table_root: str) -> str:
    """Write ``df`` as a new version of the table; returns its path."""
    version = new_version(table_root)
    df.write.mode("errorifexists").parquet(version)
    return version


def write_counted(df: DataFrame, path: str, watch: list[str]) -> dict[str, int]:
    """Write ``df`` to a new ``path`` and return the NULLs of each watched column, counted by the tasks that write."""
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{k}") for k, c in enumerate(watch)]
    df.observe(seen, F.count("*").alias("rows"), *counts).write.mode("errorifexists").parquet(path)
    found = seen.get
    return {c: found[f"null_{k}"] for k, c in enumerate(watch)}


def current_version(spark: SparkSession, table_root: str) -> str | None:
    fs, p, jvm = _fs(spark, table_root)
    if not fs.exists(p):
        return None
    best = None
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version=") and \
                fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            if best is None or name > best[0]:
                best = (name, st.getPath().toString())
    return best[1] if best else None


def read_current(spark: SparkSession, table_root: str) -> DataFrame | None:
    path = current_version(spark, table_root)
    return spark.read.parquet(path) if path else None
