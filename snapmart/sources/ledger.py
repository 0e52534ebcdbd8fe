"""One commit for a load: raw rows and audit rows count once the ledger lists their batch.

A load writes its raw rows, its audit rows and the snapshots it brought, each as a folder
``batch=<id>`` of its table, and then publishes ``_ledger/<id>`` (one small file, one
step).  Readers take the folders of listed batches.  A load that dies in between leaves
folders that no reader opens, so running it again loads each key once; ``sweep`` removes
such folders.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.growth import STATE_SCHEMA
from snapmart.operators.snapshot import latest_by_catalogue
from snapmart.sources.catalog import RAW_TABLE_DDL, _fs, raw_path
from snapmart.sources.manifest import publish, published

LEDGER = "_ledger"
#: Which snapshot times a batch brought, with their rows: the newest one is found here, without reading raw rows.
SNAPSHOTS = "snapshots"
SNAPSHOT_SCHEMA = "source string, extracted_at timestamp_ntz, n_rows bigint"

#: The game ids of every snapshot that a batch brought (``operators.growth``).
GROWTH, GROWTH_SCHEMA = "catalog_growth_state", STATE_SCHEMA


def new_batch() -> str:
    return f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"


def batches(spark: SparkSession, root: str) -> list[str]:
    """Committed batches below ``root``, oldest first."""
    return published(spark, raw_path(root, LEDGER))


def batch_path(root: str, table: str, batch: str) -> str:
    return f"{raw_path(root, table)}/batch={batch}"


def commit(spark: SparkSession, root: str, batch: str) -> None:
    publish(spark, f"{raw_path(root, LEDGER)}/{batch}", "")


def read(spark: SparkSession, root: str, table: str, schema: str | None = None, only: list[str] | None = None) -> DataFrame:
    """Rows of the committed batches of a table (``only``: of these); the batch is a partition, so others are not opened."""
    schema = schema or RAW_TABLE_DDL[table]
    path = raw_path(root, table)
    fs, p, _ = _fs(spark, path)
    some = batches(spark, root) if only is None else only
    if not some or not fs.exists(p):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch string").parquet(path)
    return rows.where(F.col("batch").isin(some)).drop("batch")


def latest_raw(spark: SparkSession, root: str, table: str, source: str) -> DataFrame:
    """J1/A1 from the snapshot catalogue: rows of the source's newest snapshot, out of the batches that brought some of it.

    NULL times are no snapshot.  Which batches are needed and the time itself are known
    before the raw table is touched: a partition filter and a pushed equality.
    """
    path = raw_path(root, SNAPSHOTS)
    fs, p, _ = _fs(spark, path)
    some = batches(spark, root)
    if not some or not fs.exists(p) or not fs.exists(_fs(spark, raw_path(root, table))[1]):
        return read(spark, root, table, only=[])
    known = (spark.read.schema(f"{SNAPSHOT_SCHEMA}, batch string").parquet(path)
             .where(F.col("batch").isin(some) & (F.col("source") == source)))
    raw = spark.read.schema(f"{RAW_TABLE_DDL[table]}, batch string").parquet(raw_path(root, table))
    return latest_by_catalogue(raw, known, part_col="batch").drop("batch")


def sweep(spark: SparkSession, root: str, tables: tuple[str, ...] = (*RAW_TABLE_DDL, SNAPSHOTS, GROWTH)) -> list[str]:
    """Remove folders of batches that were never committed (call it while no load runs); returns them."""
    known, gone = set(batches(spark, root)), []
    for table in tables:
        fs, p, _ = _fs(spark, raw_path(root, table))
        for st in fs.listStatus(p) if fs.exists(p) else []:
            name = st.getPath().getName()
            if name.startswith("batch=") and name[6:] not in known:
                fs.delete(st.getPath(), True)
                gone.append(f"{table}/{name}")
    return gone
