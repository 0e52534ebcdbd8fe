"""M1/M2 — keyed upsert into an accumulating table.

Parquet has no row-level MERGE, so the merge is a rewrite: the new rows, plus
the target rows whose key is absent from them.  Rows are never deleted; a NULL
key never matches and so is inserted again on each run (trap T10).  The result
is written beside the old one (versions in ``sources.catalog``, touched key buckets and
a manifest in ``sources.manifest``), because overwriting a path the same plan reads
would destroy it (trap T19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.dedup import keep_first


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """M1: replace whole rows on key match, insert the rest, keep untouched rows."""
    untouched = target.join(updates.select(key), on=key, how="left_anti")
    return updates.unionByName(untouched.select(*updates.columns))


def fold_latest(history: DataFrame, key: str, order: list[Column], null_key_by: list[str] | None = None) -> DataFrame:
    """M2: folding ``upsert`` over snapshots in time order in one pass.

    Upserting snapshot after snapshot leaves, for every key, the row of the last
    snapshot that carried it — i.e. the first row per key by time descending.
    A NULL key never matches, so such rows survive once per snapshot: they are
    grouped by ``null_key_by`` (the snapshot columns) instead of by the key.
    One window, one pass — no branch recomputes the history.
    """
    k = F.col(key)
    by = null_key_by or [c for c in history.columns if c != key]
    extra = F.when(k.isNull(), F.struct(*[F.col(c) for c in by]))
    return keep_first(history, [k, extra], order)


BUCKET_COL = "key_bucket"


def key_bucket(key: str, buckets: int):
    """Stable bucket of a key (NULL keys share bucket ``-1``)."""
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))).cast("int")
