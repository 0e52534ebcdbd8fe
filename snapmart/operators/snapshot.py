"""J1/A1 — keep the rows of the latest snapshot.

The cut is a filter on a scalar subquery (``max`` over the table), so the
predicate reaches the Parquet scan as a runtime filter and is applied before the
payload is exploded.  Rows with a NULL time never equal the max and drop out;
*every* row at the max survives (a snapshot may span many envelopes).

Where a catalogue says which partitions hold which snapshot, ``latest_by_catalogue``
asks it instead: the raw table's other folders are neither listed nor opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(raw: DataFrame, ts_col: str = "extracted_at") -> DataFrame:
    latest = raw.select(F.max(ts_col).alias("_latest_ts")).scalar()
    return raw.where(F.col(ts_col) == latest)


def latest_by_catalogue(raw: DataFrame, catalogue: DataFrame, part_col: str = "extract_date", ts_col: str = "extracted_at") -> DataFrame:
    """The latest snapshot's rows of ``raw``, whose partition column ``part_col`` the catalogue names for every snapshot.

    The catalogue is read first (a row a snapshot and folder); the newest one's folders, a
    handful, become partition filters.  NULL times are no snapshot.
    """
    known = catalogue.where(F.col(ts_col).isNotNull())
    newest = known.agg(F.max(ts_col).cast("string")).first()[0]
    if newest is None:
        return raw.limit(0)
    at = F.lit(newest).cast("timestamp_ntz")
    parts = [r[0] for r in known.where(F.col(ts_col) == at).select(part_col).distinct().collect()]
    return raw.where(F.col(part_col).isin(parts) & (F.col(ts_col) == at))
